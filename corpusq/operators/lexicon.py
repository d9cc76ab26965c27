"""An entity list: forms from names, checks against the cache and among variants, reviews, lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.operators.ordered import pick

#: A surname stands alone from this length on.
DISTINCTIVE = 4


def person_forms(names: DataFrame) -> DataFrame:
    """gid, form, rule from names as ``Surname, Forename``: as they are, in natural order, with an initial, and distinctive surnames."""
    sur, fore = (F.split_part("name", F.lit(", "), F.lit(k)) for k in (1, 2))
    form = lambda c, rule: F.struct(c.alias("form"), F.lit(rule).alias("rule"))
    forms = F.array(
        form(F.col("name"), "variant-full-name"), form(F.concat(fore, F.lit(" "), sur), "full-name"), form(F.concat(F.substring(fore, 1, 1), F.lit(". "), sur), "initial-surname"),
        form(F.when(F.length(sur) >= DISTINCTIVE, sur), "surname"),
    )
    return names.select("gid", F.inline(forms)).where("form is not null")


def caps(forms: DataFrame) -> DataFrame:
    """form, caps of forms of several words whose capitals have the same length."""
    upper = F.upper("form")
    return forms.where(F.contains("form", F.lit(" ")) & (F.length(upper) == F.length("form"))).select("form", upper.alias("caps"))


def case_doubts(writing: Column, form: Column) -> dict[str, Column]:
    """Why a writing that differs from its form in case only is suspect."""
    low = writing == F.lower(writing)
    return {"lowered": low & (form != F.lower(form)), "incipit": low & (F.substring(form, 1, 1) == F.upper(F.substring(form, 1, 1)))}


def cache_findings(entities: DataFrame, cache: DataFrame) -> DataFrame:
    """gid, finding of entities (gid, name) whose cached record (gid, status, preferred, typed) is missing or wrong."""
    finding = (
        F.when(F.col("status").isNull(), "not_cached").when(F.col("status") == 404, "not_found").when(F.col("status") != 200, "other_status")
        .when(F.col("preferred").isNull(), "no_preferred_name").when(F.col("preferred") != F.col("name"), "name_differs").when(~F.col("typed"), "wrong_type")
    )
    return entities.join(cache, "gid", "left").select("gid", finding.alias("finding")).where("finding is not null")


def variant_findings(variants: DataFrame) -> DataFrame:
    """finding, gid, form of variants (gid, label, form)."""
    twice = variants.groupBy("gid", "form").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate").alias("finding"), "gid", "form")
    same = variants.where("form = label").select(F.lit("redundant").alias("finding"), "gid", "form").distinct()
    bearers = variants.groupBy("form").agg((F.min("gid") != F.max("gid")).alias("several")).where("several").select("form")
    shared = variants.join(bearers, "form", "left_semi").select(F.lit("collision").alias("finding"), "gid", "form").distinct()
    return twice.unionByName(same).unionByName(shared)


def reviewed(variants: DataFrame, decisions: DataFrame) -> DataFrame:
    """Variants (gid, form) with their status: keep or suspect; those rejected (gid, decision) are left out."""
    met = variants.join(decisions, "gid", "left").where("decision is null or decision <> 'reject'")
    return met.select("gid", "form", F.when(F.col("decision") == "approve", "keep").otherwise("suspect").alias("status"))


def listed(lists: list[DataFrame]) -> DataFrame:
    """The union of lists (gid, ...); of entries with one gid the one of the first list."""
    rows = reduce(DataFrame.unionByName, [x.withColumn("_k", F.lit(k)) for k, x in enumerate(lists)])
    return pick(rows, ["gid"], [F.col("_k")]).drop("_k")


def alternatives(surfaces: DataFrame, forms: DataFrame) -> DataFrame:
    """surface, gid of every entity whose form (gid, surface) is a surface or a surface less its final s."""
    tries = surfaces.select("surface", F.explode(F.array_distinct(F.array(F.col("surface"), F.regexp_replace("surface", "s$", "")))).alias("_f"))
    return tries.join(forms.withColumnRenamed("surface", "_f"), "_f").select("surface", "gid").distinct()


def recall_met(mentions: DataFrame, finds: DataFrame, keys: list[str]) -> DataFrame:
    """Mentions (keys, surface) and whether a find with the same keys holds their surface or is held by it."""
    other = finds.withColumnRenamed("surface", "_o")
    a, b = F.lower("surface"), F.lower("_o")
    hit = mentions.join(other, keys).where(F.contains(a, b) | F.contains(b, a)).select(*keys, "surface").distinct().withColumn("met", F.lit(True))
    return mentions.join(hit, [*keys, "surface"], "left").withColumn("met", F.coalesce("met", F.lit(False)))
