"""A sink for fixed-width genotype lines: chunks of a line are written one after the other, so no line is held as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

NAME = "herdframe_fixed_width"


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str


class FixedWidthWriter(DataSourceWriter):
    """Each task writes a hidden file of its own attempt; the job's end gives the files of the attempts that count their names."""

    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def _open(self) -> tuple[fs.FileSystem, str]:
        store, folder = fs.FileSystem.from_uri(self.path)
        return store, folder.rstrip("/")

    def write(self, iterator: Iterator) -> Written:
        """Rows are (id, chunk, text), all of an id together and in the order of the chunks."""
        store, folder = self._open()
        store.create_dir(folder, recursive=True)
        name, last = f".{uuid.uuid4().hex}.txt", None
        with store.open_output_stream(f"{folder}/{name}") as out:
            for key, _, text in iterator:
                if key != last:
                    out.write(("" if last is None else "\n").encode() + str(key).ljust(self.width).encode() + b" ")
                    last = key
                out.write(text.encode())
            if last is not None:
                out.write(b"\n")
        return Written(TaskContext.get().partitionId(), name)

    def commit(self, messages: list) -> None:
        store, folder = self._open()
        store.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None:
                store.move(f"{folder}/{m.name}", f"{folder}/part-{m.part:05d}.txt")
        with store.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list) -> None:
        store, folder = self._open()
        for m in messages:
            if m is not None:
                store.delete_file(f"{folder}/{m.name}")


class FixedWidth(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> FixedWidthWriter:
        return FixedWidthWriter(self.options["path"], int(self.options.get("width", 20)))


def write_chunks(chunks: DataFrame, key: str, chunk: str, text: str, path: str, width: int) -> None:
    """One line per key: the key padded to a width, a blank, and the chunks in order. ``path`` must not exist and be of a store that Arrow can open."""
    chunks.sparkSession.dataSource.register(FixedWidth)
    rows = chunks.select(key, chunk, text).repartition(key).sortWithinPartitions(key, chunk)
    rows.write.format(NAME).option("path", path).option("width", width).mode("append").save()
