"""Pedigrees as edge tables: decoding, parent values, generations, overrides, inbreeding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.operators.keys import left_join_known, null_safe_join, shuffled
from herdframe.session import StagedRows, cut_lineage

ANIMAL, SIRE, DAM = "full_reg", "sire_reg", "dam_reg"


def decode_ids(renamed: DataFrame, unknown: str = "0") -> DataFrame:
    """(id_new, sire_id, dam_id, full_reg) to registrations of animal, sire and dam; unknown parents get a mark."""
    names = renamed.select("id_new", "full_reg")
    out = renamed
    for parent in ("sire", "dam"):
        lookup = names.select(F.col("id_new").alias(f"{parent}_id"), F.col("full_reg").alias(f"{parent}_reg"))
        out = left_join_known(out, lookup, f"{parent}_id", (unknown,))
    marked = out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(unknown)) for c in (SIRE, DAM)})
    kept = marked.filter(F.col(ANIMAL).isNotNull() & (F.col(ANIMAL).cast("string") != unknown))
    return kept.select("id_new", ANIMAL, SIRE, DAM)


def attach_parent_values(df: DataFrame, values: list[str], unknown="0") -> DataFrame:
    """Values of sire and dam next to those of each animal; unknown parents have none."""
    out = df
    for parent, key in (("sire", SIRE), ("dam", DAM)):
        side = df.select(F.col(ANIMAL).alias(key), *[F.col(v).alias(f"{parent}_{v}") for v in values])
        out = left_join_known(out, side, key, (unknown,))
    return out.select(*df.columns, *[f"{p}_{v}" for p in ("sire", "dam") for v in values])


def expand_generations(df: DataFrame, ped: DataFrame, depth: int = 1) -> DataFrame:
    """The animals' rows plus the pedigree rows of their parents, grandparents, ... ``depth`` steps up."""
    cols = [ANIMAL, SIRE, DAM]
    rows = df.select(*cols)
    frontier = rows
    for _ in range(depth):
        parents = frontier.select(F.explode(F.array(SIRE, DAM)).alias(ANIMAL)).filter(F.col(ANIMAL).isNotNull()).distinct()
        frontier = ped.select(*cols).join(parents, ANIMAL, "left_semi")
        rows = rows.unionByName(frontier)
    return rows.distinct()


def member_list(ped: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Distinct ids seen as animal, sire or dam, limited to an allowed list (such as genotyped animals)."""
    ids = ped.select(F.explode(F.array(ANIMAL, SIRE, DAM)).alias(ANIMAL)).filter(F.col(ANIMAL).isNotNull()).distinct()
    return ids if allowed is None else ids.join(allowed.select(ANIMAL).distinct(), ANIMAL, "left_semi")


def override_parents(
    ped: DataFrame, fixes: DataFrame, on: list[str], sire: str = "fix_sire", dam: str = "fix_dam",
    only_unknown: bool = False, unknown="0",
) -> DataFrame:
    """Replace parents where a fix exists; with ``only_unknown`` fill only parents that are unknown."""
    joined = null_safe_join(ped, fixes.select(*on, sire, dam), on)
    out = joined
    for col, fix in ((SIRE, sire), (DAM, dam)):
        use = F.col(fix).isNotNull()
        if only_unknown:
            use = use & (F.col(col) == F.lit(unknown))
        out = out.withColumn(col, F.when(use, F.col(fix)).otherwise(F.col(col)))
    return out.drop(sire, dam)


def rekey_parents(ped: DataFrame, registry: DataFrame, old: str, new: str, unknown="0") -> DataFrame:
    """Parents take the number of a preferred registry when the link is one to one on the preferred side."""
    links = registry.filter(F.col(old).isNotNull() & F.col(new).isNotNull()).select(old, new)
    single = links.groupBy(new).count().filter("count = 1").select(new)
    links = links.join(single, new, "left_semi")
    out = ped
    for col in (SIRE, DAM):
        side = links.select(F.col(old).alias(col), F.col(new).alias("__new"))
        out = left_join_known(out, side, col, (unknown,)).withColumn(col, F.coalesce(F.col("__new"), F.col(col))).drop("__new")
    return out.select(*ped.columns)


def sex_from_role(ped: DataFrame, sex: str | None = "sex", default: str | None = "F") -> DataFrame:
    """Seen as a sire: male; seen as a dam: female; else the recorded sex, else the default."""
    males = ped.select(F.col(SIRE).alias(ANIMAL), F.lit(True).alias("__sire")).distinct()
    females = ped.select(F.col(DAM).alias(ANIMAL), F.lit(True).alias("__dam")).distinct()
    joined = ped.join(males, ANIMAL, "left").join(females, ANIMAL, "left")
    known = [F.when(F.col("__sire"), "M"), F.when(F.col("__dam"), "F")]
    if sex and sex in ped.columns:
        known.append(F.col(sex))
    known.append(F.lit(default).cast("string"))
    return joined.withColumn(sex or "sex", F.coalesce(*known)).drop("__sire", "__dam")


def generations(ped: DataFrame, unknown="0") -> tuple[StagedRows, int]:
    """Pedigree rows with the levels of animal and parents, stored by the animal's level, and the highest level.

    Animals without known parents have level 0, others one more than the higher of their parents. Parents without a row get one. A round stores the
    animals left with a mark on those with a parent among them, which are left for the next round. Rows: full_reg, sire_reg, dam_reg, level, sire_level, dam_level.
    """
    known = lambda c: F.when(F.col(c) != F.lit(unknown), F.col(c))
    rows = ped.filter(F.col(ANIMAL).isNotNull()).select(ANIMAL, known(SIRE).alias(SIRE), known(DAM).alias(DAM)).dropDuplicates([ANIMAL])
    parents = rows.select(F.explode(F.array(SIRE, DAM)).alias(ANIMAL)).filter(F.col(ANIMAL).isNotNull()).distinct()
    base = parents.join(shuffled(rows.select(ANIMAL)), ANIMAL, "left_anti")
    none = [F.lit(None).cast(dict(rows.dtypes)[c]).alias(c) for c in (SIRE, DAM)]
    rows = cut_lineage(rows.unionByName(base.select(ANIMAL, *none)))
    kind = rows.schema[ANIMAL].dataType.simpleString()
    out = StagedRows(ped.sparkSession, f"{ANIMAL} {kind}, {SIRE} {kind}, {DAM} {kind}, level int, sire_level int, dam_level int")
    todo, left, levels = rows, rows.count(), []
    while left:
        links = todo.select(ANIMAL, F.explode(F.array(SIRE, DAM)).alias("__p")).filter("__p is not null")
        below = links.join(shuffled(todo.select(F.col(ANIMAL).alias("__p"))), "__p", "left_semi").select(ANIMAL).distinct()
        marked = todo.join(shuffled(below.withColumn("__later", F.lit(True))), ANIMAL, "left")
        marked = cut_lineage(marked.withColumn("__later", F.coalesce("__later", F.lit(False))))
        later = marked.filter("__later").drop("__later")
        rest = later.count()
        if rest == left:
            raise ValueError("the pedigree holds a cycle")
        levels.append(marked.filter("not __later").select(ANIMAL, F.lit(len(levels)).alias("level")))
        todo, left = later, rest
    if levels:
        level_of = levels[0]
        for part in levels[1:]:
            level_of = level_of.unionByName(part)
        level_of = cut_lineage(level_of)
        placed = rows.join(shuffled(level_of), ANIMAL)
        for c, name in ((SIRE, "sire_level"), (DAM, "dam_level")):
            placed = left_join_known(placed, shuffled(level_of.select(F.col(ANIMAL).alias(c), F.col("level").alias(name))), c)
        out.add(placed.select(*[F.col(c).cast(kind).alias(c) for c in (ANIMAL, SIRE, DAM)], "level", "sire_level", "dam_level", F.col("level").alias("stage")))
    return out, len(levels) - 1


def inbreeding(ped: DataFrame, unknown="0", depth: int | None = None) -> DataFrame:
    """Inbreeding coefficient per animal: (full_reg, f).

    With ``depth`` only so many generations above an animal are known: f is then the bounded kinship of its parents (see ``kinship``).

    Else shares of ancestors are passed down the generations: an animal has half the shares of each parent plus itself,
    and 1 + F = sum(share^2 * d) with d the Mendelian sampling variance of the ancestor (Meuwissen and Luo 1992).
    Animals are handled level by level, one job each. The links of an animal are stored under each level at which it has offspring, so a job reads
    the links it needs and no others. The size is the number of (animal, ancestor) links, never animal pairs.
    """
    if depth is not None:
        rows = ped.filter(F.col(ANIMAL).isNotNull()).dropDuplicates([ANIMAL]).select(ANIMAL, SIRE, DAM)
        if depth < 1:
            return rows.select(ANIMAL, F.lit(0.0).alias("f"))
        f = kinship(ped, rows.select(F.col(SIRE).alias("animal_i"), F.col(DAM).alias("animal_j")), unknown, depth - 1)
        both = rows.join(shuffled(f.select(F.col("animal_i").alias(SIRE), F.col("animal_j").alias(DAM), "kinship")), [SIRE, DAM], "left")
        return both.select(ANIMAL, F.coalesce("kinship", F.lit(0.0)).alias("f"))
    levelled, top = generations(ped, unknown)
    kind = ped.schema[ANIMAL].dataType.simpleString()
    if top < 0:
        return ped.select(ANIMAL, F.lit(0.0).alias("f")).limit(0)
    links = StagedRows(ped.sparkSession, f"{ANIMAL} {kind}, anc {kind}, share double, d double, f double")
    # at which levels each animal has offspring, by its own level; -1 is for the result
    every = levelled.all()
    sides = [F.struct(F.col(c).alias(ANIMAL), F.col(n).alias("stage"), F.col("level").alias("need")) for c, n in ((SIRE, "sire_level"), (DAM, "dam_level"))]
    own_level = F.struct(F.col(ANIMAL), F.col("level").alias("stage"), F.lit(-1).alias("need"))
    offspring = StagedRows(ped.sparkSession, f"{ANIMAL} {kind}, need int")
    offspring.add(every.select(F.inline(F.array(own_level, *sides))).filter(F.col(ANIMAL).isNotNull()).distinct())
    for level in range(top + 1):
        rows = levelled.read(level)
        edges = rows.select(ANIMAL, F.explode(F.array(SIRE, DAM)).alias("__parent")).filter("__parent is not null")
        passed = edges.join(shuffled(links.read(level).withColumnRenamed(ANIMAL, "__parent")), "__parent")
        # the parent's own link, of share one, tells its coefficient; each known parent takes a quarter of 1 + F from the sampling variance
        own = passed.filter("__parent = anc").groupBy(ANIMAL).agg((1 - F.sum(0.25 * (1 + F.col("f")))).alias("d"))
        itself = rows.select(ANIMAL).join(shuffled(own), ANIMAL, "left").select(ANIMAL, F.col(ANIMAL).alias("anc"), F.lit(1.0).alias("share"), F.coalesce("d", F.lit(1.0)).alias("d"))
        older = passed.groupBy(ANIMAL, "anc").agg((F.sum("share") / 2).alias("share"), F.first("d").alias("d"))
        fresh = itself.unionByName(older)
        f = fresh.groupBy(ANIMAL).agg((F.sum(F.col("share") * F.col("share") * F.col("d")) - 1).alias("f"))
        needed = offspring.read(level).join(shuffled(f), ANIMAL)
        kept = fresh.join(shuffled(needed), ANIMAL).filter((F.col("need") >= 0) | (F.col("anc") == F.col(ANIMAL)))
        links.add(kept.withColumnRenamed("need", "stage"))
    return links.read(-1).select(ANIMAL, "f").join(shuffled(ped.select(ANIMAL).distinct()), ANIMAL, "left_semi")


def kinship(ped: DataFrame, pairs: DataFrame, unknown="0", depth: int | None = None) -> DataFrame:
    """Kinship (coancestry) of the given pairs: (animal_i, animal_j, kinship), one row per distinct pair with both sides known.

    The pair with itself has (1 + F) / 2. In other pairs the animals of the higher level are replaced by their parents, which halves the
    value for each; the animal of higher level is no ancestor of the other. Down the levels every pair needed is found once, whoever needs it; up the levels
    each solved pair is passed once to those that need it. Rows are stored by the level that reads them.

    With ``depth`` an animal of a pair has parents, grandparents, ... of so many generations, and those above are unknown. A line that has come up n generations
    has depth - n left; the inbreeding of a common ancestor is counted as far as both lines still reach.
    """
    levelled, top = generations(ped, unknown)
    spark, kind = ped.sparkSession, ped.schema[ANIMAL].dataType.simpleString()
    side = lambda p: [F.col(f"{p}.{c}") for c in ("x", "g", "r")]
    state, ids = ["a", "b", "ra", "rb"], f"a {kind}, b {kind}, ra int, rb int"
    needed = StagedRows(spark, f"{ids}, ga int, gb int, pa {kind}, pb {kind}, pra int, prb int, level int, weight double")
    parts = StagedRows(spark, f"{ids}, v double")

    def ordered(rows: DataFrame, keep: list[str]) -> DataFrame:
        """The side of higher level first (then id); a pair of one animal has the generations that both lines have left."""
        swap = (F.col("u.g") < F.col("w.g")) | ((F.col("u.g") == F.col("w.g")) & (F.col("u.x") < F.col("w.x")))
        rows = rows.withColumns({"u": F.when(swap, F.col("w")).otherwise(F.col("u")), "w": F.when(swap, F.col("u")).otherwise(F.col("w"))})
        rows = rows.select(*[c.alias(n) for p, names in (("u", ("a", "ga", "ra")), ("w", ("b", "gb", "rb"))) for c, n in zip(side(p), names, strict=True)], *keep)
        least = F.when(F.col("a") == F.col("b"), F.least("ra", "rb"))
        return rows.withColumns({"ra": F.coalesce(least, "ra"), "rb": F.coalesce(least, "rb")}).withColumn("stage", F.col("ga"))

    end = lambda x, g, r: F.struct(x.alias("x"), g.cast("int").alias("g"), F.least(r, g).cast("int").alias("r"))
    wanted = pairs.select("animal_i", "animal_j").filter((F.col("animal_i") != F.lit(unknown)) & (F.col("animal_j") != F.lit(unknown))).distinct()
    wanted = cut_lineage(wanted.select(F.col("animal_i").cast(kind).alias("animal_i"), F.col("animal_j").cast(kind).alias("animal_j")))
    if top < 0:
        return spark.createDataFrame([], f"animal_i {kind}, animal_j {kind}, kinship double")
    first, level_of = wanted, levelled.all().select(ANIMAL, "level")
    for c, g in (("animal_i", "__gi"), ("animal_j", "__gj")):
        first = first.join(shuffled(level_of.select(F.col(ANIMAL).alias(c), F.col("level").alias(g))), c)
    reach = lambda g: F.col(g) if depth is None else F.lit(depth)
    first = first.select("animal_i", "animal_j", *[end(F.col(f"animal_{k}"), F.col(f"__g{k}"), reach(f"__g{k}")).alias(n) for k, n in (("i", "u"), ("j", "w"))])
    first = ordered(first, ["animal_i", "animal_j"])
    top_level = [F.lit(None).cast("int").alias(c) for c in ("pra", "prb")]
    needed.add(first.select(*state, "ga", "gb", F.col("animal_i").alias("pa"), F.col("animal_j").alias("pb"), *top_level, F.lit(-1).alias("level"), F.lit(1.0).alias("weight"), "stage"))
    for level in range(top, 0, -1):
        if not needed.has(level):
            continue
        open_ = needed.read(level).filter("ra > 0 and (ga > gb or rb > 0)").select(*state, "ga", "gb").distinct()
        rows = levelled.read(level)
        mine = lambda key, s: rows.select(F.col(ANIMAL).alias(key), *[end(F.col(c), F.col(g), F.lit(1 << 30)).alias(f"{s}{k}") for k, (c, g) in enumerate(((SIRE, "sire_level"), (DAM, "dam_level")))])
        lowered = lambda p, r: F.struct(F.col(f"{p}.x").alias("x"), F.col(f"{p}.g").alias("g"), F.least(F.col(r) - 1, F.col(f"{p}.g")).alias("r"))
        whole = F.struct(F.col("b").alias("x"), F.col("gb").alias("g"), F.col("rb").alias("r"))
        pair = lambda u, w, weight: F.struct(u.alias("u"), w.alias("w"), F.lit(weight).alias("weight"))
        up = open_.join(shuffled(mine("a", "s")), "a")
        same = up.filter("a = b").select(*state, F.array(pair(lowered("s0", "ra"), lowered("s1", "ra"), 0.5)).alias("e"))
        one = up.filter("ga > gb").select(*state, F.array(*[pair(lowered(f"s{k}", "ra"), whole, 0.5) for k in (0, 1)]).alias("e"))
        two = up.filter("ga = gb and a <> b").join(shuffled(mine("b", "t")), "b")
        two = two.select(*state, F.array(*[pair(lowered(f"s{i}", "ra"), lowered(f"t{j}", "rb"), 0.25) for i in (0, 1) for j in (0, 1)]).alias("e"))
        edges = same.unionByName(one).unionByName(two).select(*[F.col(c).alias(n) for c, n in zip(state, ("pa", "pb", "pra", "prb"), strict=True)], F.inline("e"))
        edges = ordered(edges.filter("u.x is not null and w.x is not null"), ["pa", "pb", "pra", "prb", "weight"]).withColumn("level", F.lit(level))
        needed.add(edges)
    for level in range(top + 1):
        if not needed.has(level):
            continue
        sums = parts.read(level).groupBy(*state).agg(F.sum("v").alias("v"))
        own = F.when(F.col("a") == F.col("b"), 0.5).otherwise(0.0)
        solved = needed.read(level).select(*state).distinct().join(shuffled(sums), state, "left").select(*state, (F.coalesce("v", F.lit(0.0)) + own).alias("v")).filter("v <> 0")
        given = needed.read(level).join(shuffled(solved), state)
        given = given.select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("pra").alias("ra"), F.col("prb").alias("rb"), (F.col("weight") * F.col("v")).alias("v"), F.col("level").alias("stage"))
        parts.add(given)
    value = parts.read(-1).groupBy(F.col("a").alias("animal_i"), F.col("b").alias("animal_j")).agg(F.sum("v").alias("kinship"))
    return wanted.join(shuffled(value), ["animal_i", "animal_j"], "left").select("animal_i", "animal_j", F.coalesce("kinship", F.lit(0.0)).alias("kinship"))
