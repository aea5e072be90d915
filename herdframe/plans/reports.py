"""Tables that go into reports: hits with statistics, region tables, copy-number regions, solutions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.text import marker_label, with_thousands
from herdframe.operators.aggregates import add_count
from herdframe.operators.intervals import feature_distance, interval_join, markers_inside, window_or_nearest
from herdframe.operators.keys import null_safe_join, shuffled


def hit_table(markers: DataFrame, features: DataFrame, window: int, stats: DataFrame, values: list[str]) -> DataFrame:
    """Marker-gene hits with marker statistics, display labels, distance and rows per gene.

    ``markers``: chr, pos. ``features``: chr, start_pos, end_pos, gene. Hits grow with the product of both, so all that depends on one side is put on that side: statistics and
    labels before the pairs are made, and the rows per gene from ``markers_inside``. Pairs are never moved.
    """
    places = markers.select("chr", "pos").join(shuffled(stats.select("chr", "pos", *values)), ["chr", "pos"], "left")
    spots = places.withColumn("snp", marker_label("chr", "pos"))
    counts = markers_inside(places, features, ["gene"], window)
    texts = {"start_text": with_thousands("start_pos"), "end_text": with_thousands("end_pos")}
    genes = null_safe_join(features.select("chr", "start_pos", "end_pos", "gene"), shuffled(counts), ["gene"]).withColumns(texts)
    hits = interval_join(spots, genes, window)
    return hits.select("snp", "gene", "start_text", "end_text", with_thousands(feature_distance()).alias("distance"), *values, "n")


def region_table(markers: DataFrame, features: DataFrame, peaks: list[tuple[int, int, int, int]], window: int, max_dist: int) -> DataFrame:
    """Genes near markers with the peak each marker lies in, and how often a gene appears in a peak.

    ``peaks``: (peak number, chromosome, first position, last position), first match wins.
    """
    near = window_or_nearest(markers, features, ["chr", "pos"], window, max_dist, "gene_id")
    peak = None
    for number, chrom, low, high in peaks:
        cond = (F.col("chr") == chrom) & F.col("pos").between(low, high)
        peak = F.when(cond, number) if peak is None else peak.when(cond, number)
    rows = near.withColumn("peak", peak).withColumn("distance", feature_distance())
    return add_count(rows, ["peak", "gene_id"])


def cnv_table(regions: DataFrame, lifted: DataFrame, samples: int, low: int, high: int) -> DataFrame:
    """Copy-number regions with their lifted coordinates and frequency, limited to a span of the new build.

    ``regions``: cnvr, chr, start_pos, end_pos, number_samples. ``lifted``: query, mapped_start, mapped_end.
    """
    query = F.concat(F.lit("chr"), F.col("chr"), F.lit(":"), F.col("start_pos"), F.lit("-"), F.col("end_pos"))
    joined = regions.withColumns({"query": query, "freq": F.col("number_samples") / samples}).join(lifted, "query", "left")
    return joined.filter((F.col("mapped_start") > low) & (F.col("mapped_start") < high))


def solution_table(solutions: DataFrame, levels: DataFrame, effects: dict[int, str]) -> DataFrame:
    """Solutions of chosen effects with the original level names and effect labels; levels may be missing."""
    label = None
    for number, text in effects.items():
        cond = F.col("effect") == number
        label = F.when(cond, text) if label is None else label.when(cond, text)
    chosen = solutions.filter(F.col("effect").isin(*effects))
    joined = chosen.join(levels.select("effect", "id_renamed", "id_original"), ["effect", "id_renamed"], "left")
    return joined.withColumn("effect", label).select("effect", "id_original", "id_renamed", "solution", "se")


def relative_effects(solutions: DataFrame, reference: float, merge: dict[str, str] | None = None) -> DataFrame:
    """Solutions relative to a reference level; merged level names become their number."""
    level = F.col("id_original")
    for name, number in (merge or {}).items():
        level = F.when(F.col("id_original") == name, F.lit(number)).otherwise(level)
    shifted = solutions.withColumn("id_original", level)
    return shifted.withColumns({"rel_solution": F.col("solution") - reference, "positive": F.col("solution") - reference > 0})
