"""Solver logs and level tables, read line by line: a line knows its number in its log, and what follows a marker is found by line numbers.

No log is held as a whole; a file may hold one log or many, and be read in many parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdframe.functions.text import extract, squish
from herdframe.operators.ordered import running
from herdframe.session import cut_lineage

_PART = 1 << 16


def log_lines(spark: SparkSession, path, run_marker: str | None = None) -> DataFrame:
    """(file, run, at, line): the lines of all files below ``path``, numbered from 1 in their file, with runs of white space as one blank. A stored table.

    A run is named by its file, without folder and ending. With ``run_marker``, a pattern with one group, a line that matches it begins a run that
    the group names.
    """
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[A-Za-z]+$", "")
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), name.alias("run"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), squish("value").alias("line")
    )
    # the parts of a file follow each other by their start, the lines of a part by their id
    parts = {"__start": F.col("__block"), "__part": F.floor(F.col("__id") / _PART)}
    lines = running(cut_lineage(raw), ["file"], parts, ["__id"], {"at": ("sum", F.lit(1).cast("long"))})
    if run_marker is None:
        return cut_lineage(lines.select("file", "run", "at", "line"))
    marks = F.regexp_extract("line", run_marker, 1)
    lines = running(lines, ["file"], parts, ["__id"], {"__from": ("max", F.when(marks != "", F.col("at")))})
    lines = cut_lineage(lines.select("file", "run", "at", "line", "__from"))
    named = lines.filter("at = __from").select("file", "__from", F.regexp_extract("line", run_marker, 1).alias("__run"))
    named = lines.join(named, ["file", "__from"], "left")
    return cut_lineage(named.select("file", F.coalesce("__run", "run").alias("run"), "at", "line"))


def _after(lines: DataFrame, heads: DataFrame, first: int, count) -> DataFrame:
    """(file, run, i, line): ``count`` lines of each head's run, from ``first`` lines after the head at ``at`` on; i counts from 0."""
    wanted = heads.withColumn("i", F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1))))
    wanted = wanted.select("file", "run", "i", (F.col("at") + first + F.col("i")).alias("at"))
    return wanted.join(lines, ["file", "run", "at"])


def _first_head(lines: DataFrame, pattern: str) -> DataFrame:
    """The first matching line of each run."""
    return lines.filter(F.col("line").rlike(pattern)).groupBy("file", "run").agg(F.min_by("line", "at").alias("line"), F.min("at").alias("at"))


def extract_fit_metrics(spark: SparkSession, path, run_marker: str | None = None) -> DataFrame:
    """AIC and -2logL of each run (the last line that reports them)."""
    lines = log_lines(spark, path, run_marker).filter(F.col("line").contains("AIC"))
    return lines.groupBy("file", "run").agg(F.max_by("line", "at").alias("line")).select(
        "run",
        extract("line", r"(?<=AIC = )\S+").try_cast("double").alias("aic"),
        extract("line", r"(?<=-2logL = )\S+(?= :)").try_cast("double").alias("neg2logl"),
    )


def extract_var_blocks(spark: SparkSession, path, blocks: dict[str, list[str]], run_marker: str | None = None) -> DataFrame:
    """Variance matrices as (run, val1, val2, var_cov).

    ``blocks`` maps an effect number, or ``residual``, to its labels; runs without a block give no rows for it.
    """
    lines = log_lines(spark, path, run_marker)
    out = None
    for block, labels in blocks.items():
        marker = r"Residual variance\(s\)" if block == "residual" else rf"Genetic variance\(s\) for effect {block}(\D|$)"
        rows = _after(lines, _first_head(lines, marker), 1, F.lit(len(labels)))
        names = F.array(*[F.lit(x) for x in labels])
        cells = rows.select("run", F.get(names, F.col("i")).alias("val1"), F.posexplode(F.split("line", r"\s+")).alias("j", "cell"))
        part = cells.filter(F.col("j") < len(labels)).select(
            "run", "val1", F.get(names, F.col("j")).alias("val2"), F.col("cell").try_cast("double").alias("var_cov")
        )
        out = part if out is None else out.unionByName(part)
    return out


def extract_level_tables(spark: SparkSession, path, effects: list[int], run_marker: str | None = None) -> DataFrame:
    """Level tables as (run, effect, id_original, n, id_renamed); the header line names the number of levels and
    one heading line follows it."""
    lines = log_lines(spark, path, run_marker)
    out = None
    for effect in effects:
        size = F.coalesce(extract("line", r"(?<=with )\d+(?= levels)").try_cast("int"), F.lit(0))
        rows = _after(lines, _first_head(lines, rf"Effect group {effect}(\D|$)"), 2, size)
        parts = F.split("line", r"\s+")
        part = rows.select(
            "run", F.lit(effect).alias("effect"), F.get(parts, 0).alias("id_original"),
            F.get(parts, 1).try_cast("int").alias("n"), F.get(parts, 2).alias("id_renamed"),
        )
        out = part if out is None else out.unionByName(part)
    return out
