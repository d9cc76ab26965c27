"""Queries over resampling and tests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusq.functions import statistics as S
from corpusq.functions import text as X
from corpusq.plans.base import query
from corpusq.plans.expected import folded
from corpusq.sources.tables import spread, table

SEED, B, GRID = 42, 10_000, 4


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document with its label and two values."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", X.suspicious_ratio(F.col("text")).alias("rate"), X.fold(F.col("text")).alias("t"))
    vowels = X.char_count(F.col("t"), "[aeiou]") / F.greatest(F.length("t"), F.lit(1))
    return d.select("doc_id", "lang", "n_chars", "rate", vowels.alias("vowels")).join(lab, "doc_id")


def _counted(values: DataFrame, value: Column, *keys: str) -> DataFrame:
    """How often each value occurs, on a grid of ``GRID`` decimals: shares have 10,001 of them at most, however many rows there are."""
    return values.groupBy(*keys, F.round(value, GRID).alias("v")).agg(F.count(F.lit(1)).alias("n"))


def _intervals(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("v")
    v, n, lang = g["v"].to_numpy(), g["n"].to_numpy(), str(g["stratum"].iloc[0])
    rows = []
    for name, f in (("mean", S.mean), ("median", S.median)):
        for kind, ci in (("percentile", S.percentile_ci), ("bca", S.bca_ci)):
            rows.append((lang, name, kind, int(n.sum()), float(f(v, n)), *ci(v, f, B, S.seed_of(SEED, name, lang), counts=n)))
    return pd.DataFrame(rows, columns=["stratum", "statistic", "method", "n", "point", "low", "high"])


@query()
def bootstrap_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of mean and median per language and overall, percentile and BCa, over all labelled documents."""
    d = _rates(spark, sf_dir)
    both = d.select(F.col("lang").alias("stratum"), "vowels").unionByName(d.select(F.lit("all").alias("stratum"), "vowels"))
    return _counted(both, F.col("vowels"), "stratum").groupBy("stratum").applyInPandas(_intervals, "stratum string, statistic string, method string, n long, point double, low double, high double")


def _paired(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("v")
    n = g["n"].to_numpy()
    return pd.DataFrame([(int(n.sum()), *S.paired(g["v"].to_numpy(), B, S.seed_of(SEED, "paired"), n))], columns=["n", "mean", "low", "high", "p"])


@query()
def paired_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(_rates(spark, sf_dir), F.col("vowels") - F.col("rate")).groupBy(F.lit(1).alias("k")).applyInPandas(_paired, "n long, mean double, low double, high double, p double")


def _page_interval(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("page")
    rates, chars, doc = g["cer"].to_numpy(np.float64), g["chars"].to_numpy(np.float64), int(g["doc"].iloc[0])
    return pd.DataFrame([(doc, len(g), *S.block_ci(rates, chars, B, S.seed_of(SEED, "pages", str(doc))))], columns=["doc", "pages", "low", "high"])


@query()
def within_document_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval of each document's rate from its pages; a document's pages are one group."""
    from corpusq.plans.distance import pagewise_evaluation

    rates = spread(pagewise_evaluation(spark, sf_dir).select("doc", "page", "cer", "chars"), "doc")
    return rates.groupBy("doc").applyInPandas(_page_interval, "doc long, pages long, low double, high double")


def _share_interval(g: pd.DataFrame) -> pd.DataFrame:
    rows = [(r.lang, int(r.n), int(r.hits), *S.bernoulli_ci(int(r.hits), int(r.n), B, S.seed_of(SEED, "share", str(r.lang)))) for r in g.itertuples()]
    return pd.DataFrame(rows, columns=["lang", "n", "hits", "low", "high"])


@query()
def bernoulli_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval of the share of good documents per language, from two counts each."""
    g = _rates(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("hits"))
    return g.groupBy(F.lit(1).alias("k")).applyInPandas(_share_interval, "lang string, n long, hits long, low double, high double")


@query("""WITH c AS (SELECT lang, count(*) AS corpus FROM documents GROUP BY 1), s AS (SELECT lang, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1),
e AS (SELECT coalesce(n, 0) AS n, corpus * sum(coalesce(n, 0)) OVER () / sum(corpus) OVER () AS e FROM c LEFT JOIN s USING (lang)),
p AS (SELECT sum(n) AS n, sum(e) AS e FROM e GROUP BY CASE WHEN e < 1 THEN 1 ELSE 0 END, CASE WHEN e < 1 THEN 0 ELSE e END)
SELECT round(sum((n - e) * (n - e) / e), 6) AS chi2, count(*) - 1 AS df FROM p WHERE e >= 1""")  # fmt: skip
def chi_square_gof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents against the corpus by language; cells under one expected are pooled."""
    return _gof(spark, sf_dir, "lang")


def _gof(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.col(field).alias("lang"))
    lab = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("in"))
    c = d.join(lab, "doc_id", "left").groupBy("lang").agg(F.count(F.lit(1)).alias("corpus"), F.coalesce(F.sum("in"), F.lit(0)).alias("n"))
    total = c.agg(F.sum("corpus").alias("all"), F.sum("n").alias("drawn"))
    e = c.crossJoin(total).select("lang", "n", (F.col("corpus") * F.col("drawn") / F.col("all")).alias("e"))  # one row
    pooled = e.groupBy(F.when(F.col("e") < 1, "_other_").otherwise(F.col("lang")).alias("cell")).agg(F.sum("n").alias("n"), F.sum("e").alias("e")).where("e >= 1")
    return pooled.agg(F.round(F.sum((F.col("n") - F.col("e")) ** 2 / F.col("e")), 6).alias("chi2"), (F.count(F.lit(1)) - 1).alias("df"))


@query("""WITH v AS (SELECT n_chars AS x, (l.doc_id IS NOT NULL)::INT AS a FROM documents LEFT JOIN labels l USING (doc_id)), t AS (SELECT sum(a) AS n, count(*) - sum(a) AS m FROM v),
c AS (SELECT x, sum(sum(a)) OVER (ORDER BY x) AS ca, sum(sum(1 - a)) OVER (ORDER BY x) AS cb FROM v GROUP BY x) SELECT round(max(abs(ca / n - cb / m)), 9) AS d, max(n)::BIGINT AS n, max(m)::BIGINT AS m FROM c, t""")  # fmt: skip
def ks_two_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lengths of labelled against other documents: the largest gap of the two distributions.

    Running counts over a range partitioning: counts per partition first, then within each.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    v = d.join(table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("a")), "doc_id", "left").groupBy("n_chars").agg(F.sum(F.coalesce("a", F.lit(0))).alias("a"), F.sum(F.when(F.col("a").isNull(), 1).otherwise(0)).alias("b"))
    # Lengths are dealt to 4096 fixed bands; the bands' totals are few, so one window over them is bounded.
    v = v.withColumn("band", F.least(F.floor(F.col("n_chars") / 32), F.lit(4095)))
    bands = v.groupBy("band").agg(F.sum("a").alias("ba"), F.sum("b").alias("bb"))
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    bands = bands.select("band", F.coalesce(F.sum("ba").over(before), F.lit(0)).alias("pa"), F.coalesce(F.sum("bb").over(before), F.lit(0)).alias("pb"), F.sum("ba").over(every).alias("n"), F.sum("bb").over(every).alias("m"))
    w = Window.partitionBy("band").orderBy("n_chars")
    c = v.join(F.broadcast(bands), "band").select("n", "m", ((F.col("pa") + F.sum("a").over(w)) / F.col("n") - (F.col("pb") + F.sum("b").over(w)) / F.col("m")).alias("gap"))  # at most 4096 rows
    return c.agg(F.round(F.max(F.abs("gap")), 9).alias("d"), F.max("n").alias("n"), F.max("m").alias("m"))


@query("WITH p AS (SELECT lang, source, count(*) AS a, sum(n_chars) AS b FROM documents GROUP BY ALL), r AS (SELECT row_number() OVER (ORDER BY a, lang, source) AS ra, row_number() OVER (ORDER BY b, lang, source) AS rb FROM p) SELECT round(CASE WHEN count(*) < 3 THEN 0 ELSE 1 - 6 * sum((ra - rb) * (ra - rb)) / (count(*) * (count(*) * count(*) - 1)) END, 9) AS rho, count(*) AS n FROM r")
def spearman_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank correlation without tie correction over the strata (few)."""
    p = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("a"), F.sum("n_chars").alias("b"))
    rank = lambda c: F.row_number().over(Window.orderBy(c, "lang", "source"))
    r = p.select(rank("a").alias("ra"), rank("b").alias("rb"))
    n = F.count(F.lit(1))
    rho = F.when(n < 3, 0.0).otherwise(1 - 6 * F.sum((F.col("ra") - F.col("rb")) ** 2) / (n * (n * n - 1)))
    return r.agg(F.round(rho, 9).alias("rho"), n.alias("n"))


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n FROM lineitem")
def pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"), F.count(F.lit(1)).alias("n"))


_FEATURES = ["vowels", "ln(1 + n_chars)"]
_SQL_RATES = "WITH r AS (SELECT lang, quality::DOUBLE AS y, (length(t) - length(regexp_replace(t, '[aeiou]', '', 'g'))) / greatest(length(t), 1) AS a, ln(1 + n_chars) AS b FROM (SELECT doc_id, lang, n_chars, lower(" + folded("text") + ") AS t FROM documents) JOIN labels USING (doc_id)) "


@query(_SQL_RATES + """, m AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM r), s AS (SELECT sum((a - ma) ** 2) AS aa, sum((b - mb) ** 2) AS bb, sum((a - ma) * (b - mb)) AS ab, sum((a - ma) * (y - my)) AS ay, sum((b - mb) * (y - my)) AS yb, sum((y - my) ** 2) AS yy FROM r, m),
c AS (SELECT n, ma, mb, my, yy, aa * bb - ab * ab AS det, (bb * ay - ab * yb) / (aa * bb - ab * ab) AS ca, (aa * yb - ab * ay) / (aa * bb - ab * ab) AS cb, aa, bb, ab FROM m, s),
e AS (SELECT y - my - ca * (a - ma) - cb * (b - mb) AS e, 1 / n + (bb * (a - ma) ** 2 - 2 * ab * (a - ma) * (b - mb) + aa * (b - mb) ** 2) / det AS h FROM r, c)
SELECT n, round(my - ca * ma - cb * mb, 6) AS b0, round(ca, 6) AS b1, round(cb, 6) AS b2, round(1 - (SELECT sum(e * e) FROM e) / yy, 6) AS r2, round(1 - (SELECT sum((e / (1 - h)) ** 2) FROM e) / yy, 6) AS loocv_r2 FROM c""")
def proxy_ols_loocv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality proxy from two features over all labelled documents, judged by leaving one out.

    Sums suffice for the fit. A left-out row's error is its residual over one less its leverage, which
    holds however the features are scaled in each fold, so a second pass replaces the refits.
    """
    d = _rates(spark, sf_dir).selectExpr(*[f"{f} AS x{k}" for k, f in enumerate(_FEATURES)], "cast(quality as double) AS y")
    xs, at = [f"x{k}" for k in range(len(_FEATURES))], range(len(_FEATURES))
    one = d.agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *[F.avg(x).alias(x) for x in xs],
    ).first()
    z = d.select((F.col("y") - one.y).alias("y"), *[(F.col(x) - one[x]).alias(x) for x in xs])
    s = z.agg(F.sum(F.col("y") ** 2).alias("yy"), *[F.sum(F.col(x) * F.col("y")).alias(f"{x}y") for x in xs], *[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for a in xs for b in xs]).first()
    c, inverse = S.solved(one.n, np.zeros(len(xs)), np.array([[s[f"{a}{b}"] for b in xs] for a in xs]), 0.0, np.array([s[f"{x}y"] for x in xs]))
    row = [F.lit(1.0), *[F.col(x) for x in xs]]
    error = F.col("y") - sum((F.lit(float(c[k + 1])) * F.col(xs[k]) for k in at), F.lit(float(c[0])))
    leverage = sum((F.lit(float(inverse[i, j])) * row[i] * row[j] for i in range(len(row)) for j in range(len(row))), F.lit(0.0))
    out = z.select(error.alias("e"), leverage.alias("h"))
    b0 = one.y + float(c[0]) - sum(float(c[k + 1]) * one[xs[k]] for k in at)
    r2 = lambda e: F.round(1 - F.sum(e**2) / s.yy, 6)
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.lit(b0), 6).alias("b0"), *[F.round(F.lit(float(c[k + 1])), 6).alias(f"b{k + 1}") for k in at],
        r2(F.col("e")).alias("r2"), r2(F.col("e") / (1 - F.col("h"))).alias("loocv_r2"),
    )


@query(_SQL_RATES + """, k AS (SELECT lang, count(*) OVER w AS n, y, sum(y) OVER w AS sy, sum(y * y) OVER w AS syy, a AS x, sum(a) OVER w AS sx, sum(a * a) OVER w AS sxx, sum(a * y) OVER w AS sxy FROM r WINDOW w AS (PARTITION BY lang)),
l AS (SELECT *, (sx - x) / (n - 1) AS mx, (sy - y) / (n - 1) AS my FROM k), p AS (SELECT *, (sxy - x * y - (n - 1) * mx * my) / (n - 2) / ((sxx - x * x) / (n - 1) - mx * mx) AS slope FROM l)
SELECT lang, n, CASE WHEN max(syy) - max(sy) ** 2 / n > 1e-9 THEN round(1 - sum((y - my - slope * (x - mx)) ** 2) / (max(syy) - max(sy) ** 2 / n), 6) ELSE 0 END AS loocv_r2 FROM p GROUP BY lang, n""")
def single_feature_loocv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leave-one-out R² of one feature by language, from the sums of each language less the row itself."""
    d = _rates(spark, sf_dir).select("lang", F.col("vowels").alias("x"), F.col("quality").cast("double").alias("y"))
    x, y, n = F.col("x"), F.col("y"), F.col("n")
    sums = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"))
    p = d.join(F.broadcast(sums), "lang")  # a row per language
    mx, my = (F.col("sx") - x) / (n - 1), (F.col("sy") - y) / (n - 1)
    slope = (F.col("sxy") - x * y - (n - 1) * mx * my) / (n - 2) / ((F.col("sxx") - x * x) / (n - 1) - mx * mx)
    total = F.max("syy") - F.max("sy") ** 2 / n
    return p.groupBy("lang", "n").agg(F.when(total > 1e-9, F.round(1 - F.sum((y - my - slope * (x - mx)) ** 2) / F.nullif(total, F.lit(0.0)), 6)).otherwise(0.0).alias("loocv_r2"))


def _with_p(df: DataFrame, kind: str, value: str, *sizes: str) -> DataFrame:
    """Adds the p of a test to its few rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = {"chi2": S.chi2_sf, "ks": S.ks_p, "r": S.pearson_p}[kind]
        for g in batches:
            yield g.assign(p=[round(f(float(v), *map(int, n)), 9) for v, *n in zip(g[value], *[g[s] for s in sizes])])

    ddl = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in df.schema.fields)
    return df.mapInPandas(run, f"{ddl}, p double")


@query()
def selection_bias_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents against the corpus: by language and source (goodness of fit) and by length (largest gap), each with its p."""
    ks = _with_p(ks_two_sample(spark, sf_dir), "ks", "d", "n", "m").select(F.lit("n_chars").alias("field"), F.lit("ks").alias("test"), F.col("d").alias("statistic"), "p")
    found = ks
    for field in ("lang", "source"):
        one = _with_p(_gof(spark, sf_dir, field), "chi2", "chi2", "df")
        found = found.unionByName(one.select(F.lit(field).alias("field"), F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"), "p"))
    return found.withColumn("comparable", F.col("p") > 0.05)


@query()
def correlation_with_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_p(pearson(spark, sf_dir), "r", "r", "n")
