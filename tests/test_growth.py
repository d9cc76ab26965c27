"""Work that is dear or grows: done once, dealt to many tasks, bounded in memory."""

import random

import pytest

from corpusq.functions import edits
from corpusq.plans import registry

DIR = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return registry.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distance():
    r = random.Random(5)
    text = lambda: "".join(r.choice("abé🎉 "[: r.randrange(2, 6)]) for _ in range(r.randrange(90)))
    for a, b in [("", ""), ("", "ab"), ("ab", ""), ("abc", "abc"), ("kitten", "sitting")] + [(text(), text()) for _ in range(300)]:
        assert edits.distance(a, b) == plain_distance(a, b)


@pytest.mark.parametrize("name", ["multi_norm_block", "overall_and_strata_blocks", "outlier_pages", "error_categories"])
def test_rates_are_stored_once(spark, name):
    plan = plan_of(spark, name)
    assert "levenshtein" not in plan and "EvalPython" not in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("name", ["cer_pairs", "paired_test", "confusion_matrix"])
def test_pairs_are_dealt_by_number(spark, name):
    plan = plan_of(spark, name)
    assert "REPARTITION_BY_NUM" in plan and "levenshtein" not in plan


def test_documents_are_dealt_before_resampling(spark):
    plan = plan_of(spark, "within_document_bootstrap")
    assert "REPARTITION_BY_NUM" in plan[plan.index("FlatMapGroups") : plan.index("Window")]


def test_paragraphs_keep_their_digits(spark):
    from pyspark.sql import functions as F

    from corpusq.functions import text as X

    d = spark.createDataFrame([(" no. 10 \n 21 of 1\n32",)], "t string")
    assert d.select(X.paragraphs(F.col("t"), "\n")).first()[0] == ["no. 10", "21 of 1", "32"]


def test_coverage_is_exact(spark):
    from corpusq.operators import pages as P

    r = spark.range(1).selectExpr("array_repeat(struct(1D as w, 10D as h), 150) AS r")
    assert tuple(r.select(P.coverage(r["r"]), P.layout_quality(r["r"])).first()) == (15.0, "warning")


def test_mentions_are_matched_in_groups_that_pass_by(spark):
    from corpusq.operators.pages import _greedy

    def plain(cands, refs, most):
        cands, rows = list(cands), []
        for at in refs:
            free = [(t, abs(c - at), k) for k, (c, t) in enumerate(cands) if abs(c - at) <= most]
            if free:
                t, _, k = min(free)
                rows.append((at, cands.pop(k)[0], t))
        return rows

    r = random.Random(2)
    for _ in range(300):
        cands = sorted((r.randrange(60), r.randrange(3)) for _ in range(r.randrange(30)))
        refs = sorted(r.randrange(60) for _ in range(r.randrange(30)))
        assert list(_greedy(cands, refs, 9)) == plain(cands, refs, 9)
    assert "FlatMapGroups" not in plan_of(spark, "gold_matching")


def test_stability_reads_the_boxes_once(spark):
    plan = plan_of(spark, "reading_order_stability")
    assert "Union" not in plan and plan.count("FileScan") <= 2


@pytest.mark.parametrize("name", ["reading_order", "span_merge"])
def test_rows_are_dealt_by_number(spark, name):
    assert "REPARTITION_BY_NUM" in plan_of(spark, name)


def test_tasks_grow_in_number_with_the_rows(spark):
    from corpusq.sources.tables import sized

    d = spark.range(100_000).selectExpr("id % 997 AS k")
    assert sized(d, "k", most=1_000).rdd.getNumPartitions() == 100


def test_entity_rows_are_made_once(spark):
    assert "Join" not in plan_of(spark, "entity_sorters")


def test_only_words_where_the_list_may_stand(spark):
    from corpusq.operators import matcher

    d = spark.createDataFrame([(1, "the House of THE HOUSES, the hut; Meiers meier Meierling, (A) b (a) c")], "doc_id long, text string")
    got = matcher.words(d, 5, names={"meier"}, forms={"The House", "(A)"}).orderBy("at").collect()
    assert [(r.at, r.word) for r in got] == [(0, "the"), (13, "THE"), (34, "Meiers"), (41, "meier"), (59, "A"), (65, "a")]


@pytest.mark.parametrize("name", ["mention_scan", "mention_by_rule", "mention_overview"])
def test_finds_are_made_once(spark, name):
    assert "WindowGroupLimit" not in plan_of(spark, name)


def test_segments_are_made_once(spark):
    assert "posexplode" not in plan_of(spark, "running_heads")
