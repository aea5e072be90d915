"""Columns and rows in other shapes: drift, names, pivots, stacks, matrices, strings of dosages."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import all_of
from herdframe.operators.keys import attach
from herdframe.operators.ranks import numbered


def add_missing_columns(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    absent = {c: F.lit(None).cast(t) for c, t in cols.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def union_drifting(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def tag_and_union(dfs: dict[str, DataFrame], out: str = "dataset") -> DataFrame:
    return union_drifting([df.withColumn(out, F.lit(name)) for name, df in dfs.items()])


def snake(name: str) -> str:
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.replace("%", "_percent_").replace("#", "_number_"))
    return re.sub(r"_+", "_", re.sub(r"[^A-Za-z0-9]+", "_", text)).strip("_").lower()


def clean_names(df: DataFrame, bare: list[str] | None = None) -> DataFrame:
    """Snake-case names; names starting with a word in ``bare`` lose digits and punctuation.
    Repeated names get a running number."""
    seen: dict[str, int] = {}
    names = []
    for original in df.columns:
        name = snake(original)
        for word in bare or []:
            if name.startswith(word):
                name = re.sub(r"[^a-z]", "", name)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*names)


def remove_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def remove_empty_cols(df: DataFrame) -> DataFrame:
    """Drops columns without any value; one aggregate of counts decides, one row reaches the driver."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if filled[c] > 0])


def select_columns(df: DataFrame, *wanted: str, drop: tuple[str, ...] = (), everything: bool = False) -> DataFrame:
    """Names, ``prefix*``, ``*part*`` and ``a:b`` ranges, in order; names that do not exist are skipped."""
    cols: list[str] = []
    for item in wanted:
        if ":" in item:
            first, last = item.split(":")
            found = df.columns[df.columns.index(first) : df.columns.index(last) + 1]
        elif "*" in item:
            pattern = re.compile("^" + ".*".join(re.escape(part) for part in item.split("*")) + "$")
            found = [c for c in df.columns if pattern.match(c)]
        else:
            found = [item] if item in df.columns else []
        cols += [c for c in found if c not in cols]
    if everything or not wanted:
        cols += [c for c in df.columns if c not in cols]
    return df.select(*[c for c in cols if c not in drop])


def across(df: DataFrame, cols: list[str], fn, suffix: str = "") -> DataFrame:
    """The same expression over many columns."""
    return df.withColumns({f"{c}{suffix}": fn(F.col(c)) for c in cols})


def filter_all(df: DataFrame, cols: list[str], cond) -> DataFrame:
    return df.filter(all_of([cond(F.col(c)) for c in cols]))


def pivot_wider(df: DataFrame, ids: list[str], names: str, values: dict[str, str], levels: list, agg=F.min) -> DataFrame:
    """Long to wide with explicit levels, so no extra job looks for them. ``values``: column -> name prefix."""
    cells = [
        agg(F.when(F.col(names) == F.lit(level), F.col(value))).alias(f"{prefix}{level}")
        for level in levels
        for value, prefix in values.items()
    ]
    return df.groupBy(*ids).agg(*cells)


def pivot_longer(df: DataFrame, ids: list[str], cols: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, cols, name, value)


def stack_groups(df: DataFrame, ids: list[str], groups: list[dict[str, str]], drop_null: str | None = None) -> DataFrame:
    """k groups of parallel columns to k rows in one scan. Each group maps output name -> source column."""
    sizes = {tuple(sorted(g)) for g in groups}
    if len(sizes) != 1:
        raise ValueError("every group must name the same output columns")
    rows = F.array(*[F.struct(*[F.col(f"`{src}`").alias(out) for out, src in g.items()]) for g in groups])
    out = df.select(*ids, F.inline(rows))
    return out if drop_null is None else out.filter(F.col(drop_null).isNotNull())


def stack_pairs(df: DataFrame, ids: list[str], pairs: list[tuple[str, str]], names=("score_date", "score")) -> DataFrame:
    """Paired (date, score) columns to rows; rows without a score go."""
    return stack_groups(df, ids, [dict(zip(names, pair, strict=True)) for pair in pairs], drop_null=names[1])


def wide_pedigree_to_long(df: DataFrame, triples: list[tuple[str, str, str]]) -> DataFrame:
    """(animal, sire, dam) column triples of one wide row to distinct pedigree rows."""
    names = ("full_reg", "sire_reg", "dam_reg")
    return stack_groups(df, [], [dict(zip(names, t, strict=True)) for t in triples], drop_null=names[0]).distinct()


def melt_matrix(df: DataFrame, row: str, cols: list[str], out: str = "var_cov") -> DataFrame:
    """Square matrix with a row label column to (val1, val2, value)."""
    return df.unpivot([row], cols, "val2", out).withColumnRenamed(row, "val1")


def split_columns(df: DataFrame, source: str, into: list[str], sep: str = " ") -> DataFrame:
    parts = F.split(F.col(source), re.escape(sep))
    return df.withColumns({name: F.get(parts, i) for i, name in enumerate(into)}).drop(source)


def split_rows(df: DataFrame, source: str, out: str, sep: str = "; ") -> DataFrame:
    return df.withColumn(out, F.explode(F.split(F.col(source), re.escape(sep))))


def nest(df: DataFrame, by: list[str], cols: list[str], out: str = "data", rows: int = 10_000) -> DataFrame:
    """One row per group and ``slice`` with its rows as a sorted list column.

    A group of up to ``rows`` rows has one slice, 0; a larger one has as many as give lists of about that length, by a hash of the row.
    """
    sizes = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows).alias("__slices"))
    sliced = attach(df.select(*by, *cols), sizes, by).withColumn("slice", F.pmod(F.xxhash64(*cols), F.col("__slices")).cast("int"))
    return sliced.groupBy(*by, "slice").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(out))


def unnest(df: DataFrame, source: str = "data") -> DataFrame:
    return df.select(*[c for c in df.columns if c not in (source, "slice")], F.inline(F.col(source)))


def dosage_chunks(df: DataFrame, animal: str = "animal", snp: str = "snp", dosage: str = "dosage", size: int = 65_536) -> DataFrame:
    """(animal, chunk, genotype): one digit per marker in marker order, 5 for a missing call, cut at every ``size`` markers of the table.

    However many markers there are, a cell holds ``size`` of them at most (more if an animal has several rows of a marker).
    """
    markers = numbered(df.select(snp).distinct(), [], [snp], "__at").select(F.col(snp).alias("__snp"), F.floor((F.col("__at") - 1) / size).alias("chunk"))
    rows = df.join(markers, F.col(snp).eqNullSafe(F.col("__snp"))).drop("__snp")
    cells = F.array_sort(F.collect_list(F.struct(F.col(snp), F.coalesce(F.col(dosage), F.lit(5)).alias("d"))))
    digits = F.array_join(F.transform(cells, lambda s: s["d"].cast("string")), "")
    return rows.groupBy(animal, "chunk").agg(digits.alias("genotype"))


def dosage_to_string(df: DataFrame, animal: str = "animal", snp: str = "snp", dosage: str = "dosage", size: int = 65_536) -> DataFrame:
    """The chunks of ``dosage_chunks`` put together: one text per animal, a byte per marker. For texts that fit into a cell; files need the chunks only."""
    chunks = dosage_chunks(df, animal, snp, dosage, size)
    parts = F.array_sort(F.collect_list(F.struct("chunk", "genotype")))
    return chunks.groupBy(animal).agg(F.array_join(F.transform(parts, lambda s: s["genotype"]), "").alias("genotype"))


def string_to_dosage(df: DataFrame, animal: str = "animal", genotype: str = "genotype") -> DataFrame:
    """Marker number (from 1) and dosage per digit; 5 becomes null."""
    rows = df.select(animal, F.posexplode(F.split(F.col(genotype), "(?!^)")).alias("snp", "__d")).filter("__d <> ''")
    digit = F.col("__d").cast("int")
    return rows.select(animal, (F.col("snp") + 1).alias("snp"), F.when(digit != 5, digit).alias("dosage"))
