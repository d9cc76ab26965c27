"""Known-entity mentions: lexicon forms, longest-match scan, risk ranking, overview, lint, unlisted names."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.operators.ordered import ranked

#: Weights of the risk features, and of an anomaly.
WEIGHTS = {"variant_form_source": 2, "case_tolerant_rule": 2, "single_token_surface": 2, "short_surface": 1, "category_work": 1, "shared_surname_gid": 1}
ANOMALY, HIGH, MEDIUM = 99, 4, 2


def base_rule(rule: Column) -> Column:
    return F.substring_index(rule, ":", 1)


def candidate_class(rule: Column, tier: Column) -> Column:
    """Annotation path of a candidate; the order of the conditions is the priority."""
    base, has = base_rule(rule), lambda s: F.contains(rule, F.lit(s))
    derived = base.isin("legacy-form", "adjective-form")
    for s in (":acronym-case", ":qualifier-strip", ":place-adjective", ":initials", ":subtitle-join"):
        derived = derived | has(s)
    return (
        F.when(tier == 1, "auto").when(has(":running-head"), "running_head").when(has(":suspect"), "suspect")
        .when(has(":ambiguous") | (base == "ambiguous-surname"), "ambiguous").when(has(":in-plain-bibl"), "bibliography").when(has(":in-figure"), "figure")
        .when(derived, "derived").when(base.isin("bare-surname", "caps-surname"), "unanchored").when(base == "crosses-markup", "markup")
        .when(base == "short-title", "short_title").otherwise("other")
    )


def shared_keys(entities: DataFrame, key: Column, gid: str = "gid") -> DataFrame:
    """Keys that more than one entity bears."""
    return entities.groupBy(key.alias("key")).agg(F.countDistinct(gid).alias("bearers")).where("bearers > 1")


def risk_ranked(marks: DataFrame, features: dict[str, Column], anomalies: dict[str, Column], order: list[str | Column]) -> DataFrame:
    """Score, stratum and case id (f0001 is the riskiest); anomalies alone make a mark high."""
    score = sum((F.when(c, WEIGHTS[k]).otherwise(0) for k, c in features.items()), F.lit(0)) + sum((F.when(c, ANOMALY).otherwise(0) for c in anomalies.values()), F.lit(0))
    named = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in (features | anomalies).items()]))
    scored = marks.withColumn("score", score).withColumn("features", F.array_join(named, ","))
    scored = scored.withColumn("stratum", F.when(F.col("score") >= HIGH, "high").when(F.col("score") >= MEDIUM, "medium").otherwise("low"))
    return numbered(scored, [F.col("score").desc(), *order], "f")


def numbered(df: DataFrame, order: list[str | Column], prefix: str, name: str = "case_id") -> DataFrame:
    """Case ids along a total order, from the ranks of one stored range sort."""
    return ranked(df, [], order, "_rank").withColumn(name, F.format_string(prefix + "%04d", F.col("_rank"))).drop("_rank")


def derived_forms(entities: DataFrame, label: str = "label", gid: str = "gid") -> DataFrame:
    """Forms of each label with their rule and tier; derived ones only where no entity bears them outright."""
    words = F.split(F.col(label), " ")
    options = F.array(
        F.struct(F.col(label).alias("form"), F.lit("headword").alias("rule"), F.lit(1).alias("tier")),
        F.struct(F.upper(label).alias("form"), F.lit("caps-form").alias("rule"), F.lit(1).alias("tier")),
        F.struct(F.when(F.size(words) >= 2, F.concat_ws(" ", F.reverse(words))).alias("form"), F.lit("natural-order").alias("rule"), F.lit(1).alias("tier")),
        F.struct(F.when(F.size(words) >= 2, F.concat(F.substring(F.element_at(words, 1), 1, 1), F.lit(". "), F.element_at(words, -1))).alias("form"), F.lit("initial-form").alias("rule"), F.lit(2).alias("tier")),
        F.struct(F.when(F.size(words) >= 3, F.concat_ws(" ", F.slice(words, 1, 2))).alias("form"), F.lit("short-title").alias("rule"), F.lit(2).alias("tier")),
    )
    forms = entities.select(gid, F.inline(options)).where("form is not null").distinct()
    first = forms.where("tier = 1")
    return first.unionByName(forms.where("tier = 2").join(first.select("form").distinct(), "form", "left_anti").select(gid, "form", "rule", "tier"))


def scan_mentions(docs: DataFrame, lexicon: list[tuple[str, str, str, int]], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Longest-match scan of curated forms at word starts; matches do not overlap.

    ``lexicon`` is the curated list (form, gid, rule, tier): a few thousand rows kept by hand, checked
    here before it is broadcast. A form several entities bear gives the least gid and the others as
    alternatives, rule ``:ambiguous`` and tier 2. Forms are looked up by their first run of word
    characters, whatever stands in or before it; a form without any never matches.
    """
    if len(lexicon) > 200_000:
        raise ValueError("a curated list is expected; join larger lexicons on the first word instead")
    forms: dict[str, dict[str, tuple[str, int]]] = {}
    for form, gid, rule, tier in sorted(lexicon):
        forms.setdefault(form, {}).setdefault(gid, (rule, tier))
    index: dict[str, list[tuple[str, int]]] = {}
    for form in sorted(forms, key=lambda f: (-len(f), f)):
        first = re.search(r"\w+", form)
        if first:
            index.setdefault(first[0], []).append((form, first.start()))
    known = docs.sparkSession.sparkContext.broadcast((forms, index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms, index = known.value
        word = re.compile(r"\w+")
        for b in batches:
            rows = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = 0
                for m in word.finditer(t or ""):
                    if m.start() < at:
                        continue
                    for form, lead in index.get(m[0], ()):
                        start = m.start() - lead
                        end = start + len(form)
                        if start >= at and t.startswith(form, start) and not (end < len(t) and (t[end].isalnum() or t[end] == "_")):
                            gids = sorted(forms[form])
                            rule, tier = forms[form][gids[0]]
                            if len(gids) > 1:
                                rule, tier = rule + ":ambiguous", 2
                            rows.append((d, gids[0], form, start, end, rule, tier, gids[1:]))
                            at = end
                            break
            cols = list(zip(*rows)) or [()] * 8
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "gid", "surface", "start", "end", "rule", "tier", "alternatives"])

    return docs.select(F.col(doc).cast("long"), text).mapInArrow(run, "doc_id long, gid string, surface string, start long, end long, rule string, tier int, alternatives array<string>")


def overview(entities: DataFrame, mentions: DataFrame, gid: str = "gid") -> DataFrame:
    """Per listed entity, those without mentions included: automatic and review mentions, documents, alternative-only."""
    own = mentions.groupBy(gid).agg(F.count_if(F.col("tier") == 1).alias("auto"), F.count_if(F.col("tier") > 1).alias("review"), F.countDistinct("doc_id").alias("docs"))
    other = mentions.select(F.explode("alternatives").alias(gid)).groupBy(gid).agg(F.count(F.lit(1)).alias("alternative"))
    zero = F.lit(0)
    return entities.join(own, gid, "left").join(other, gid, "left").select(gid, *[F.coalesce(c, zero).alias(c) for c in ("auto", "review", "docs", "alternative")])


def precision_recall(df: DataFrame, keys: list[str], outcome: str = "outcome") -> DataFrame:
    """hits/(hits+fp), hits/(hits+miss+worklist), (hits+worklist)/(...); null where nothing was counted."""
    n = {k: F.count_if(F.col(outcome) == k) for k in ("hit", "false_positive", "miss", "worklist")}
    total = n["hit"] + n["miss"] + n["worklist"]
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 9))
    return df.groupBy(*keys).agg(ratio(n["hit"], n["hit"] + n["false_positive"]).alias("precision"), ratio(n["hit"], total).alias("recall"), ratio(n["hit"] + n["worklist"], total).alias("coverage"))
