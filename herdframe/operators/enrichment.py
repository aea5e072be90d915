"""Over-representation of terms among hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.tails import hypergeom_sf
from herdframe.functions.text import marker_label
from herdframe.operators.aggregates import joined_list, ordered_items
from herdframe.operators.gwas import bh_adjust
from herdframe.operators.keys import null_safe_join, shuffled
from herdframe.session import cut_lineage


def term_enrichment(hits: DataFrame, terms: DataFrame, item: str, term: str, by: list[str]) -> DataFrame:
    """Hypergeometric over-representation per term and dataset with Benjamini-Hochberg adjustment inside a dataset.

    ``hits``: by..., item. ``terms``: item, term; its distinct items are the universe.
    """
    pairs = terms.select(item, term).distinct()
    universe = pairs.select(item).distinct()
    sizes = pairs.groupBy(term).agg(F.count(F.lit(1)).alias("term_size"))
    drawn = hits.select(*by, item).distinct().join(shuffled(universe), item, "left_semi")
    query = drawn.groupBy(*by).agg(F.count(F.lit(1)).alias("query_size"))
    both = drawn.join(shuffled(pairs), item).groupBy(*by, term).agg(F.count(F.lit(1)).alias("intersection_size"))
    out = null_safe_join(both.join(sizes, term), query, by).withColumn("universe_size", F.lit(universe.count()))
    out = out.withColumn("p_value", hypergeom_sf("intersection_size", "query_size", "term_size", "universe_size"))
    # one row per dataset and term: stored, so that the adjustment does not compute the hits again
    return bh_adjust(cut_lineage(out), "p_value", by, "p_adjusted")


def intersecting_items(
    hits: DataFrame, terms: DataFrame, item: str, term: str, by: list[str], order: list[str], label: str
) -> DataFrame:
    """The hit items of each term as one ordered list, a final report; ``intersecting_rows`` is the long form."""
    rows = _term_hits(hits, terms, item, term, by, order, label)
    return joined_list(rows, [*by, term], order, label, "intersecting_items")


def intersecting_rows(
    hits: DataFrame, terms: DataFrame, item: str, term: str, by: list[str], order: list[str], label: str
) -> DataFrame:
    """The hit items of each term, one row each with its place."""
    return ordered_items(_term_hits(hits, terms, item, term, by, order, label), [*by, term], order, label)


def _term_hits(hits: DataFrame, terms: DataFrame, item: str, term: str, by: list[str], order: list[str], label: str) -> DataFrame:
    return hits.select(*by, item, *[c for c in order if c != item], label).distinct().join(shuffled(terms.select(item, term).distinct()), item)


def qtl_enrichment(hits: DataFrame, database: DataFrame, trait: str, record: str, by: list[str]) -> DataFrame:
    """Per trait: database records near hits against all records of the trait, adjusted inside a dataset.

    ``hits``: by..., record, trait (records found around markers). ``database``: record, trait.
    """
    drawn = hits.select(*by, record, trait).distinct()
    found = drawn.groupBy(*by, trait).agg(F.count(F.lit(1)).alias("n_annotations"))
    query = drawn.groupBy(*by).agg(F.count(F.lit(1)).alias("n_drawn"))
    entries = database.select(record, trait).distinct()
    sizes = entries.groupBy(trait).agg(F.count(F.lit(1)).alias("n_trait"))
    out = null_safe_join(found.join(sizes, trait), query, by).withColumn("n_database", F.lit(entries.count()))
    out = out.withColumn("p_value", hypergeom_sf("n_annotations", "n_drawn", "n_trait", "n_database"))
    # one row per dataset and term: stored, so that the adjustment does not compute the hits again
    return bh_adjust(cut_lineage(out), "p_value", by, "p_adjusted")


def enriched_trait_report(
    enriched: DataFrame, hits: DataFrame, trait: str, by: list[str], limit: float = 0.05, min_annotations: int = 2,
    min_snps: int = 2, chrom: str = "chr", pos: str = "pos",
) -> DataFrame:
    """Significant traits with several annotations, the number of distinct markers and their ordered list."""
    kept = enriched.filter((F.col("p_adjusted") < limit) & (F.col("n_annotations") >= min_annotations))
    spots = cut_lineage(hits.select(*by, trait, chrom, pos).distinct())
    lists = joined_list(spots, [*by, trait], [chrom, pos], marker_label(chrom, pos), "snps")
    counts = spots.groupBy(*by, trait).agg(F.count(F.lit(1)).alias("n_snps"))
    detail = null_safe_join(counts.filter(F.col("n_snps") >= min_snps), lists, [*by, trait])
    return null_safe_join(kept, detail, [*by, trait], "inner").select(
        *by, trait, "p_adjusted", "n_annotations", "n_snps", "snps"
    )
