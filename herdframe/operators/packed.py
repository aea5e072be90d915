"""Genotypes as bit planes: 64 calls in two longs, counted with bit operations.

Bit i of ``lo`` says that the call carries the other allele, bit i of ``hi`` that it carries the counted one. So dosage 0 is (1, 0), dosage 1 (1, 1),
dosage 2 (0, 1) and a missing call (0, 0): a call is there if either bit is set, and two calls share an allele if they share a set bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdframe.session import cut_lineage

BITS = 64
_FILL = 48


def bit_places(geno: DataFrame, along: str) -> DataFrame:
    """(along, chunk, bit): a place for every distinct value of ``along``, the same for all rows packed with it.

    Values are dealt by hash to chunks of about ``_FILL`` and numbered there, so no window sees more than a few dozen; a chunk that got more than fits
    goes on in a further one.
    """
    values = cut_lineage(geno.select(along).filter(F.col(along).isNotNull()).distinct())
    parts = values.count() // _FILL + 1
    dealt = values.withColumn("__part", F.pmod(F.xxhash64(along), F.lit(parts)))
    at = F.row_number().over(Window.partitionBy("__part").orderBy(along)) - 1
    placed = dealt.withColumn("__at", at)
    return placed.select(along, (F.col("__part") + parts * F.floor(F.col("__at") / BITS)).cast("long").alias("chunk"), (F.col("__at") % BITS).cast("int").alias("bit"))


def pack(geno: DataFrame, by: str, places: DataFrame) -> DataFrame:
    """(by, chunk, lo, hi): the calls of each ``by`` value in chunks of the places along the other column. Missing calls set no bit; a chunk without any is left out.

    A pair of animal and marker should have one call; of several, all alleles seen are set.
    """
    along = places.columns[0]
    called = geno.filter(F.col("dosage").isNotNull()).join(places, along)
    one = F.expr("shiftleft(1L, bit)")
    return called.groupBy(by, "chunk").agg(
        F.bit_or(F.when(F.col("dosage") < 2, one).otherwise(F.lit(0).cast("long"))).alias("lo"),
        F.bit_or(F.when(F.col("dosage") > 0, one).otherwise(F.lit(0).cast("long"))).alias("hi"),
    )


def ones(bits: Column) -> Column:
    return F.bit_count(bits).cast("long")


def called(lo: str, hi: str) -> Column:
    return F.col(lo).bitwiseOR(F.col(hi))


def opposing(a: str, b: str) -> Column:
    """Bits of calls without a common allele, among those called on both sides; ``a`` and ``b`` are the suffixes of lo and hi."""
    common = F.col(f"lo{a}").bitwiseAND(F.col(f"lo{b}")).bitwiseOR(F.col(f"hi{a}").bitwiseAND(F.col(f"hi{b}")))
    both = called(f"lo{a}", f"hi{a}").bitwiseAND(called(f"lo{b}", f"hi{b}"))
    return both.bitwiseAND(F.bitwise_not(common))


def impossible(child: str, sire: str, dam: str) -> Column:
    """Bits of child's calls that cannot come from one allele of each parent, among those called in all three."""
    and_ = lambda x, y: F.col(x).bitwiseAND(F.col(y))
    lo, hi = F.col(f"lo{child}"), F.col(f"hi{child}")
    low = lo.bitwiseAND(F.bitwise_not(hi)).bitwiseAND(and_(f"lo{sire}", f"lo{dam}"))
    high = hi.bitwiseAND(F.bitwise_not(lo)).bitwiseAND(and_(f"hi{sire}", f"hi{dam}"))
    mixed = lo.bitwiseAND(hi).bitwiseAND(and_(f"lo{sire}", f"hi{dam}").bitwiseOR(and_(f"hi{sire}", f"lo{dam}")))
    return all_called(child, sire, dam).bitwiseAND(F.bitwise_not(low.bitwiseOR(high).bitwiseOR(mixed)))


def all_called(*suffixes: str) -> Column:
    out = called(f"lo{suffixes[0]}", f"hi{suffixes[0]}")
    for s in suffixes[1:]:
        out = out.bitwiseAND(called(f"lo{s}", f"hi{s}"))
    return out


def dosage_sums(a: str, b: str) -> dict[str, Column]:
    """n, sums, sums of squares and of products of two sides' dosages over the calls of both, as sums over chunks of whole numbers."""
    both = called(f"lo{a}", f"hi{a}").bitwiseAND(called(f"lo{b}", f"hi{b}"))
    plane = {}
    for s in (a, b):
        plane[s] = (F.col(f"hi{s}").bitwiseAND(both), F.col(f"hi{s}").bitwiseAND(F.bitwise_not(F.col(f"lo{s}"))).bitwiseAND(both))
    cross = sum((ones(x.bitwiseAND(y)) for x in plane[a] for y in plane[b]), F.lit(0).cast("long"))
    single = lambda s: ones(plane[s][0]) + ones(plane[s][1])
    square = lambda s: ones(plane[s][0]) + 3 * ones(plane[s][1])
    return {"n": F.sum(ones(both)), "x": F.sum(single(a)), "y": F.sum(single(b)), "xx": F.sum(square(a)), "yy": F.sum(square(b)), "xy": F.sum(cross)}


def side(packed: DataFrame, by: str, key: str, suffix: str) -> DataFrame:
    """Packed rows with the ``by`` column named ``key`` and planes lo, hi with a suffix."""
    return packed.select(F.col(by).alias(key), "chunk", F.col("lo").alias(f"lo{suffix}"), F.col("hi").alias(f"hi{suffix}"))
