"""Files that leave the project: renamed samples and anonymised records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.functions.base import text_key
from herdframe.operators.joins import anti
from herdframe.operators.keys import null_safe_join
from herdframe.operators.windows import fill_downup, keep_first

# association, country, sex and number of a sample id; zeros before the number are filling
_SAMPLE_ID = r"^([A-Z]{3})([A-Z]*?)([MF])(?:0+(?=[1-9]))?([0-9]+)"


def rename_key(family: DataFrame, samples: DataFrame, ped: DataFrame) -> DataFrame:
    """Pedigree id per sample id; samples outside the pedigree get prefix + number taken from the sample id.

    ``family``: international_id. ``samples``: lab_id, international_id. ``ped``: lab_id, full_reg.
    """
    linked = family.join(samples.select("lab_id", "international_id").distinct(), "international_id", "left")
    linked = linked.join(ped.select("lab_id", "full_reg").distinct(), "lab_id", "left").select("international_id", "full_reg")
    known = linked.filter(F.col("full_reg").isNotNull()).distinct()
    rest = family.select("international_id").distinct().join(known, "international_id", "left_anti")
    rows = known.unionByName(rest, allowMissingColumns=True)
    part = lambda group: F.nullif(F.regexp_extract("international_id", _SAMPLE_ID, group), F.lit(""))
    made = text_key(part(1), part(4))
    return rows.withColumn("full_reg", F.regexp_replace(F.coalesce("full_reg", made), "AAN", "AAA"))


def removal_ids(remove: DataFrame, key: DataFrame) -> DataFrame:
    """Sample ids of animals on the removal list."""
    return remove.join(key, "full_reg").select("full_reg", "international_id")


def population_file(family: DataFrame, population: str = "cow") -> DataFrame:
    """Family rows with a population label in place of the phenotype."""
    return family.drop("phenotype").withColumn("pop", F.lit(population))


def anonymise(records: DataFrame, keep: list[str], secret: str) -> DataFrame:
    """Keyed surrogate ids and the listed columns only. Animals with a lab id keep one id over herds; the id can be
    reproduced with the secret but not turned back without it."""
    filled = fill_downup(records, ["farm_id", "temp_id"], ["score_date"], ["lab_id"])
    who = F.coalesce(F.col("lab_id").cast("string"), text_key("farm_id", "animal_id", "temp_id", sep="|"))
    surrogate = F.concat(F.lit("A0"), F.sha2(F.concat(who, F.lit(secret)), 256))
    return filled.select(surrogate.alias("id"), *keep)


def missing_registrations(records: DataFrame, ped: DataFrame, cond) -> DataFrame:
    """Registration numbers of one registry's animals that the pedigree does not hold yet."""
    rows = records.filter(cond).filter(F.col("registration_number").isNotNull()).select("registration_number").distinct()
    return anti(rows, ped.select(F.col("full_reg").alias("registration_number")), ["registration_number"])


def submission_samples(samples: DataFrame, released: DataFrame, assays: list[str]) -> DataFrame:
    """Genotype samples of released animals on accepted assays: (iid, id)."""
    ok = samples.filter(F.col("assay").isin(*assays)).select("iid", "lab_id")
    return ok.join(released.select("lab_id", "id").distinct(), "lab_id").select("iid", "id").distinct()
