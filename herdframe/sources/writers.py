"""Sinks: delimited text, fixed-width genotypes, stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.operators.shape import dosage_chunks
from herdframe.sources.fixed_width import write_chunks


def write_delim(df: DataFrame, path: str, sep: str = " ", header: bool = False, na: str = "NA", partition_by=()) -> None:
    """Delimited text, one file per task. Empty text is written as such, null as ``na``."""
    df.write.partitionBy(*partition_by).option("sep", sep).option("header", header).option("nullValue", na).option(
        "emptyValue", ""
    ).csv(path)


def write_fixed_width(df: DataFrame, path: str, width: int = 20) -> None:
    """Text lines: id padded to a width, a blank, one digit per marker. A longer id is never cut. A line is written in chunks of markers."""
    write_chunks(dosage_chunks(df), "animal", "chunk", "genotype", path, width)


def write_state(df: DataFrame, path: str, partition_by=()) -> None:
    df.write.partitionBy(*partition_by).parquet(path)


def marker_info(markers: DataFrame) -> DataFrame:
    """(snp_id, chr, pos) plus the ``chr:pos`` name."""
    return markers.select("snp_id", "chr", "pos", F.concat_ws(":", F.col("chr").cast("string"), F.col("pos").cast("string")).alias("chrpos"))
