"""Session helpers: a local session for tests and benches, and the shared folder rules."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "herdframe") -> SparkSession:
    """A single-JVM session for tests and benches. Clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a fresh temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="herdframe-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Store a stage as a table in the shared folder and read it back.

    The stage survives the loss of executors, is computed once however often it is read, and, unlike a checkpoint of
    rows, is columnar: later reads take only the columns they need and the planner knows the size. ``options`` are the writer's.
    """
    path = fresh_path(df.sparkSession, "stage")
    df.write.options(**options).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stage_path = path
    return stored


def drop_stages(*stages: DataFrame) -> None:
    """Delete tables made by ``cut_lineage`` that nothing reads any more: what was computed from them is stored itself."""
    for stage in stages:
        jvm = stage.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(stage.stage_path)
        path.getFileSystem(stage.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries that are made and run within it."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: The shuffle files of a query go when it ends, not when the driver happens to collect its garbage: for jobs that store every stage they go on from.
RELEASED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class StagedRows:
    """Rows that later steps of a loop read, stored under the number of the step that will read them.

    ``add`` appends rows with a column ``stage``; ``read`` gives the rows of one stage, whichever steps wrote them, and reads no others.
    """

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema = spark, schema
        self.stage_path = self.path = fresh_path(spark, "rows")
        self.sparkSession = spark

    def add(self, rows: DataFrame) -> None:
        # small stages become one file each, large ones are split evenly
        rows.select(*[c.split()[0] for c in self.schema.split(", ")], "stage").hint("rebalance", "stage").write.mode("append").partitionBy("stage").parquet(self.path)

    def has(self, stage: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/stage={stage}")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def all(self) -> DataFrame:
        """Rows of all stages, with their stage."""
        return self.spark.read.schema(f"{self.schema}, stage int").parquet(self.path)

    def read(self, stage: int) -> DataFrame:
        if not self.has(stage):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/stage={stage}")
