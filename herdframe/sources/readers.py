"""Readers. Schemas are explicit, so no reader scans a file to infer types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from herdframe.functions.text import extract, group_from_name, year_from_name
from herdframe.operators.shape import clean_names, remove_empty_rows, tag_and_union

Fields = list[tuple[str, str] | None]

PED_FAMILY: Fields = [
    ("fid", "string"), ("iid", "string"), ("sire", "string"), ("dam", "string"), ("sex", "int"), ("phenotype", "double"),
]
MARKER_MAP: Fields = [
    ("chr", "int"), ("snp", "string"), ("cm", "double"), ("pos", "bigint"), ("a1", "string"), ("a2", "string"),
]
SOLUTIONS: Fields = [
    ("trait", "int"), ("effect", "int"), ("id_renamed", "string"), ("solution", "double"), ("se", "double"),
]


def read_ws(spark: SparkSession, path, fields: Fields, header: bool = False, na: str = "NA") -> DataFrame:
    """Whitespace-delimited text with positional columns; ``None`` skips a column, bad values become null.

    The file is read as one text column (the separator never occurs), so ``header=True`` drops the first line of
    every file while files stay splittable.
    """
    lines = (
        spark.read.schema("value string").option("header", header).option("sep", "\u0001").option("quote", "")
        .option("enforceSchema", True).csv(path)
    )
    parts = F.split(F.trim(F.col("value")), r"\s+")
    cells = lines.filter(F.col("value").isNotNull()).select(parts.alias("p"))
    return cells.select(
        *[
            F.when(F.get("p", i) != na, F.get("p", i)).try_cast(field[1]).alias(field[0])
            for i, field in enumerate(fields)
            if field is not None
        ]
    )


def read_delimited(
    spark: SparkSession, path, schema: str, sep: str = ",", na: str = "", header: bool = True
) -> DataFrame:
    """Delimited text with an explicit schema, a missing-value token and trimmed cells."""
    return spark.read.csv(
        path, schema=schema, sep=sep, nullValue=na, header=header, ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True, enforceSchema=True, mode="PERMISSIVE",
    )


def scan_record_files(
    spark: SparkSession, path: str, columns: list[str], date_columns: list[str] | None = None,
    name_pattern: str = r"[^/]+(?=\.[A-Za-z]+$)",
) -> DataFrame:
    """All record files below a path as text, with year and herd taken from names such as ``Records_ABC_2019.csv``.

    One job reads all herds and years. Columns whose name holds ``date`` become dates. ``name_pattern`` finds the
    name in the file path (the file name by default; a folder name works as well).
    """
    dates = date_columns or [c for c in columns if "date" in c.lower()]
    raw = spark.read.csv(
        path, schema=", ".join(f"`{c}` string" for c in columns), header=True, enforceSchema=True,
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, pathGlobFilter="*.csv", recursiveFileLookup=True,
    ).select("*", extract(F.col("_metadata.file_path"), name_pattern).alias("__name"))
    named = raw.dropna(how="all", subset=columns).withColumns(
        {
            "farm_id": group_from_name("__name"),
            "year": year_from_name("__name"),
            **{c: F.try_to_date(F.col(c)) for c in dates},
        }
    )
    return clean_names(named.drop("__name"), bare=["sold"])


def exclude_sources(df: DataFrame, keys: list[str], herd: str = "farm_id", year: str = "year") -> DataFrame:
    """Drop whole herd-years given as ``HERD_YEAR``."""
    if not keys:
        return df
    name = F.concat_ws("_", F.col(herd), F.col(year).cast("string"))
    return df.filter(~F.coalesce(name.isin(*keys), F.lit(False)))


def nested_daily(df: DataFrame, source: str = "daily") -> DataFrame:
    """High temperature in Celsius and day length in hours from the first entry of a nested daily forecast."""
    day = F.get(F.col(source), 0)
    start, end = F.unix_timestamp(day["sunriseTime"]), F.unix_timestamp(day["sunsetTime"])
    return df.withColumns(
        {
            "apparent_high": (day["apparentTemperatureHigh"] - 32) * 5 / 9,
            "day_length": (end - start) / 3600.0,
        }
    ).drop(source)


def read_family(spark: SparkSession, path) -> DataFrame:
    return read_ws(spark, path, PED_FAMILY)


def read_marker_map(spark: SparkSession, path) -> DataFrame:
    return read_ws(spark, path, MARKER_MAP)


def read_annotation(spark: SparkSession, path, kind: str) -> DataFrame:
    """Interval tables: ``gtf`` (genes) or ``gff`` (trait loci). Comment lines are skipped, attributes unpacked."""
    schema = "chr string, src string, feature string, start_pos bigint, end_pos bigint, score string, strand string, frame string, attributes string"
    raw = spark.read.csv(path, schema=schema, sep="\t", comment="#", quote="", nullValue=".")
    spot = ["chr", "start_pos", "end_pos"]
    if kind == "gtf":
        pick = lambda name: extract("attributes", rf'(?<={name} ")[^"]+').alias(name)
        return raw.filter(F.col("feature") == "gene").select(*spot, pick("gene_id"), pick("gene_name"), pick("gene_biotype"))
    if kind == "gff":
        pick = lambda name: extract("attributes", rf"(?<=(^|;){name}=)[^;]+").alias(name)
        chrom = F.regexp_replace("chr", "^[Cc]hr\\.?", "").alias("chr")
        return raw.select(chrom, *spot[1:], F.col("feature").alias("QTL_type"), pick("QTL_ID"), pick("Name"), pick("trait_ID"))
    raise ValueError(f"unknown kind {kind}")


def read_scores(spark: SparkSession, path, k: int = 10) -> DataFrame:
    """Principal-component scores per animal: the eigenvalue line goes, ``group:id`` becomes id."""
    names = [f"PC{i}" for i in range(1, k + 1)]
    rows = spark.read.text(path).filter(~F.trim("value").startswith("#eigvals"))
    parts = rows.select(F.split(F.trim("value"), r"\s+").alias("p"))
    return parts.select(
        extract(F.get("p", 0), r"[A-Za-z0-9]+$").alias("full_reg"),
        *[F.get("p", i + 1).try_cast("double").alias(n) for i, n in enumerate(names)],
    )


def read_eigenvalues(spark: SparkSession, path) -> DataFrame:
    line = spark.read.text(path).filter(F.trim("value").startswith("#eigvals"))
    parts = F.split(F.trim(F.regexp_replace("value", "#eigvals:", "")), r"\s+")
    cells = line.select(F.posexplode(parts).alias("i", "v"))
    values = cells.select((F.col("i") + 1).alias("pc"), F.col("v").try_cast("double").alias("eigenvalue"))
    total = values.agg(F.sum("eigenvalue").alias("t"))
    return values.withColumn("share", F.col("eigenvalue") / total.scalar())


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Chosen columns of a wide result table; only these are read."""
    return spark.read.parquet(path).select(*columns)


def read_tagged(spark: SparkSession, paths: dict[str, str], fields: Fields, header: bool = True, tag: str = "dataset") -> DataFrame:
    """The same kind of result file for several datasets, each row tagged."""
    return tag_and_union({name: read_ws(spark, p, fields, header) for name, p in paths.items()}, tag)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
