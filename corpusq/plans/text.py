"""Queries over the text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import text as X
from corpusq.functions.values import DIACRITICS
from corpusq.plans import expected
from corpusq.plans.base import query
from corpusq.plans.expected import FOLD_FROM, FOLD_TO, LANG_CODES, SUSPECT_CLASS
from corpusq.sources.tables import small, table

#: The documents hold no typographic characters; both sides put some in by these rules.
_VARIED = "translate(replace(replace(text, ', ', ' ; '), '. ', ' — '), 'xqz', '«’­')"
_SPARK_VARIED = _VARIED


_STRAIGHT = "repeat(chr(34), 3) || repeat(chr(39), 4) || '-----'"


@query(
    rf"""SELECT doc_id, md5(trim(regexp_replace(translate(regexp_replace(translate({_VARIED}, '«»„‹›`´‐‑–—‒' || chr(173), {_STRAIGHT}), ' +([;:?!])', '\1', 'g'),
    '“”‘’', repeat(chr(34), 2) || repeat(chr(39), 2)), '[\x09-\x0D\x20]+', ' ', 'g'))) AS digest FROM documents"""
)
def normalize_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.normalize_for_comparison(F.expr(_SPARK_VARIED))).alias("digest"))


@query(rf"SELECT doc_id, md5(regexp_replace(replace(translate({_VARIED}, '—„‚‹›' || chr(160) || chr(8201) || chr(8202) || chr(8239), '–“‘‘’    '), '‘', '’'), ' +([;:?!])', '\1', 'g')) AS digest FROM documents")
def tei_char_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.normalize_for_tei(F.expr(_SPARK_VARIED))).alias("digest"))


@query(f"SELECT doc_id, md5(lower(replace(translate(text, '{FOLD_FROM}', '{FOLD_TO}'), 'ß', 'ss'))) AS digest FROM documents")
def fold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.fold(F.col("text"))).alias("digest"))


@query("""WITH t AS (SELECT doc_id, lang = 'fr' AS french, replace(replace(replace(text, ',', ' ,'), 'ea', '«'), 'on', ' ;') AS t FROM documents)
SELECT doc_id, length(t) - length(replace(t, '«', '')) AS guillemets, 0 AS hyphenation_residue,
  len(regexp_extract_all(t, '[  ]+[.,]')) + CASE WHEN french THEN 0 ELSE len(regexp_extract_all(t, ' +[;:?!]')) END AS space_before_punct,
  CASE WHEN french THEN len(regexp_extract_all(t, ' +[;:?!»]')) ELSE 0 END AS space_type FROM t""")  # fmt: skip
def char_lint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("replace(replace(replace(text, ',', ' ,'), 'ea', '«'), 'on', ' ;')")
    counts = X.french_lint(text, F.col("lang") == "fr")
    del counts["straight_apostrophe"]
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in counts.items()])


@query(r"""WITH d AS (SELECT doc_id, lang = 'fr' AS fr, text, regexp_extract_all(regexp_replace(text, '(\p{L})', '\1\1', 'g'), '\p{L}''\p{L}') AS a, string_split(text, ' ') AS w FROM documents),
k AS (SELECT doc_id, len(a) AS straight_apostrophe, length(text) - length(regexp_replace(text, '[«»]', '', 'g')) AS guillemets, length(text) - length(replace(text, '¬', '')) AS hyphenation_residue,
  len(regexp_extract_all(text, '[ \x{A0}\x{202F}]+[.,]')) + CASE WHEN fr THEN 0 ELSE len(regexp_extract_all(text, '[ \x{A0}\x{202F}]+[;:?!]')) END AS space_before_punct,
  CASE WHEN fr THEN len(regexp_extract_all(text, '(?:^|[^ \x{A0}\x{202F}])[ ]+[;:?!»]')) ELSE 0 END AS space_type FROM d),
u AS (UNPIVOT k ON straight_apostrophe, guillemets, hyphenation_residue, space_before_punct, space_type INTO NAME category VALUE n)
SELECT category, sum(n)::BIGINT AS total, count(*) FILTER (n > 0) AS docs FROM u GROUP BY category""")
def char_lint_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and documents per class, apostrophes included (they need look-around)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in X.french_lint(F.col("text"), F.col("lang") == "fr").items()])
    kinds = [c for c in docs.columns if c != "doc_id"]
    return docs.unpivot("doc_id", kinds, "category", "n").groupBy("category").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("docs"))


@query(rf"""SELECT doc_id, length(text) - length(regexp_replace(text, '{SUSPECT_CLASS}', '', 'g')) AS suspicious,
  round(CASE WHEN length(text) > 0 THEN (length(text) - length(regexp_replace(text, '{SUSPECT_CLASS}', '', 'g'))) / length(text) ELSE 0 END, 9) AS ratio FROM documents""")
def suspicious_char_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", X.suspicious_count(c).alias("suspicious"), F.round(X.suspicious_ratio(c), 9).alias("ratio"))


_TOKENS = "list_filter(regexp_extract_all(text, '[a-zA-ZÀ-ɏ]+'), lambda w : length(w) >= 2)"


@query(f"SELECT doc_id, len({_TOKENS}) AS n_tokens, len(list_distinct({_TOKENS})) AS n_distinct FROM documents")
def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(t).alias("n_tokens"), F.size(F.array_distinct(t)).alias("n_distinct"))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every document that counts, and whether the word list of the benchmark passages has it.

    The list is curated: its size is checked before it is broadcast, beyond that words are shuffled to it.
    """
    words = table(spark, sf_dir, "documents").select("doc_id", "lang", F.explode(X.rated_words(F.col("text"), F.col("lang"))).alias("word"))
    known = table(spark, sf_dir, "benchmark").select(F.explode(X.tokens(F.lower("text"))).alias("word")).distinct().withColumn("known", F.lit(True))
    return words.join(small(known), "word", "left").withColumn("known", F.coalesce("known", F.lit(False)))


_TOKEN_LIST = "list_filter(regexp_extract_all({0}, '[a-zA-ZÀ-ɏ]+'), lambda w : length(w) >= 2)"
_HITS = f"""WITH a AS (SELECT doc_id, lang, {_TOKEN_LIST.format('text')} AS w FROM documents), c AS (SELECT *, list_filter(w, lambda x : NOT regexp_matches(x, '^\\p{{Lu}}') OR x = upper(x)) AS f FROM a),
w AS (SELECT doc_id, lang, lower(unnest(CASE WHEN lang = 'fr' AND len(f) >= 0.5 * len(w) THEN f ELSE w END)) AS word FROM c),
k AS (SELECT DISTINCT unnest({_TOKEN_LIST.format('lower(text)')}) AS word FROM benchmark),
h AS (SELECT doc_id, lang, w.word, count(*) AS n, k.word IS NOT NULL AS known FROM w LEFT JOIN k ON w.word = k.word GROUP BY ALL) """


@query(_HITS + "SELECT doc_id, sum(n)::BIGINT AS words, coalesce(sum(n) FILTER (known), 0)::BIGINT AS hits, round(coalesce(sum(n) FILTER (known), 0) / sum(n), 9) AS hit_rate FROM h GROUP BY doc_id")
def dictionary_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, hits = F.count(F.lit(1)), F.count_if("known")
    return _hits(spark, sf_dir).groupBy("doc_id").agg(n.alias("words"), hits.alias("hits"), F.round(hits / n, 9).alias("hit_rate"))


@query(_HITS + rf""", r AS (SELECT doc_id, lang, coalesce(sum(n) FILTER (known), 0) / sum(n) AS hit FROM h GROUP BY doc_id, lang),
s AS (SELECT r.lang, round((0.8 * hit + 0.2 * (1 - (length(text) - length(regexp_replace(text, '{SUSPECT_CLASS}', '', 'g'))) / length(text))) * 100, 1) AS score FROM r JOIN documents USING (doc_id))
SELECT lang, count(*) AS n, round(avg(score), 6) AS mean, round(quantile_cont(score, 0.5), 6) AS median, round(coalesce(stddev_samp(score), 0), 6) AS std, min(score) AS lo, max(score) AS hi FROM s GROUP BY lang""")
def quality_score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = _hits(spark, sf_dir).groupBy("doc_id").agg((F.count_if("known") / F.count(F.lit(1))).alias("hit"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", X.suspicious_ratio(F.col("text")).alias("suspicious")).join(rate, "doc_id")
    s = docs.select("lang", X.quality_score(F.col("hit"), F.col("suspicious")).alias("score"))
    return s.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.percentile("score", 0.5), 6).alias("median"),
        F.round(F.coalesce(F.stddev_samp("score"), F.lit(0.0)), 6).alias("std"), F.min("score").alias("lo"), F.max("score").alias("hi"),
    )


@query(_HITS + ", u AS (SELECT lang, word, sum(n)::BIGINT AS n FROM h WHERE NOT known GROUP BY lang, word) SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM u QUALIFY place <= 20")
def top_unknown_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusq.operators.ordered import top_per_group

    unknown = _hits(spark, sf_dir).where(~F.col("known")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(unknown, ["lang"], [F.col("n").desc(), F.col("word")], 20)


@query("""SELECT doc_id, unnest(list_filter(list_transform(string_split(trim(text), chr(10)), lambda p : trim(p)), lambda p : p <> '')) AS paragraph,
  generate_subscripts(list_filter(list_transform(string_split(trim(text), chr(10)), lambda p : trim(p)), lambda p : p <> ''), 1) - 1 AS ordinal FROM documents""")  # fmt: skip
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.paragraphs(F.col("text"), "\n")).alias("ordinal", "paragraph"))


_CODES = {"[fr]": "fra", " EN-us ": "eng", "ger": "deu", "xx": "xx", "[ITA]": "ita", "": "", "gsw": "gsw", "Q12": "q12"}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _CODES.items()) + ") t(raw, code) UNION ALL SELECT DISTINCT lang, CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_CODES.items()) + " ELSE lang END FROM documents")
def lang_code_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.createDataFrame([(k,) for k in _CODES], T.StructType([T.StructField("raw", T.StringType())]))
    raw = raw.unionByName(table(spark, sf_dir, "documents").select(F.col("lang").alias("raw")).distinct())
    return raw.select("raw", X.normalize_lang_code(F.col("raw")).alias("code"))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").alias("ref"), F.expr("replace(replace(text, 'é', 'e'), 'ü', 'u')").alias("hyp"))


def _sql_rate(lang: str) -> str:
    n = lambda c: f"(length({c}) - length(regexp_replace({c}, '[{expected.DIACRITICS[lang]}]', '', 'g')))"
    return f"WHEN lang = '{lang}' THEN CASE WHEN {n('text')} = 0 THEN CASE WHEN {n('hyp')} = 0 THEN 1.0 ELSE 0.0 END ELSE least({n('text')}, {n('hyp')}) / {n('text')} END"


@query("WITH d AS (SELECT *, replace(replace(text, 'é', 'e'), 'ü', 'u') AS hyp FROM documents) SELECT doc_id, round(CASE " + " ".join(map(_sql_rate, DIACRITICS)) + " END, 9) AS rate FROM d")
def diacritic_preservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages without a letter set give null."""
    rate = F.coalesce(*[F.when(F.col("lang") == k, X.diacritic_rate(F.col("ref"), F.col("hyp"), v)) for k, v in DIACRITICS.items()])
    return _damaged(spark, sf_dir).select("doc_id", F.round(rate, 9).alias("rate"))


_CLASSES = ["é", "ü", "ñ", "[;:?!]", "'"]


@query("WITH d AS (SELECT doc_id, text, replace(replace(text, 'é', 'e'), 'ü', 'u') AS hyp FROM documents), c AS (SELECT doc_id, unnest([" + ", ".join("{'r': length(text) - length(regexp_replace(text, '" + k.replace("'", "''") + "', '', 'g')), 'h': length(hyp) - length(regexp_replace(hyp, '" + k.replace("'", "''") + "', '', 'g'))}" for k in _CLASSES) + "]) AS x FROM d) SELECT doc_id, round(coalesce(avg(least(x.h / x.r, 1)) FILTER (x.r > 0), 1), 9) AS rate FROM c GROUP BY doc_id")
def hcpr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged(spark, sf_dir).select("doc_id", F.round(X.class_preservation(F.col("ref"), F.col("hyp"), _CLASSES), 9).alias("rate"))


@query("""WITH t AS (SELECT 'd' || doc_id AS key, text FROM documents UNION ALL SELECT 'c' || conv_id || '/' || turn, CASE WHEN turn = 1 THEN '  --  ' WHEN turn = 2 THEN ' [Blank page] ' WHEN turn = 3 THEN '............' ELSE text END FROM conversations)
SELECT key, CASE WHEN text IS NULL THEN '' WHEN length(trim(text)) <= 5 THEN 'len<=5' WHEN NOT regexp_matches(trim(text), '[A-Za-zÀ-ÿ0-9]') THEN 'no-alnum'
  WHEN length(trim(text)) < 40 AND trim(regexp_replace(regexp_replace(lower(trim(text)), '[^a-z ]+', ' ', 'g'), ' +', ' ', 'g')) IN ('blank page', 'blank', 'blank pages', 'page blanche', 'page vide') THEN 'blank-marker' ELSE '' END AS reason FROM t""")  # fmt: skip
def blank_text_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    text = F.when(turn == 1, "  --  ").when(turn == 2, " [Blank page] ").when(turn == 3, "............").otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("key"), "text")
    turns = table(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("/"), "turn").alias("key"), text.alias("text"))
    return docs.unionByName(turns).select("key", X.blank_reason(F.col("text")).alias("reason"))


_STRIPPED = (
    r"trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '(?s)<!--.*?-->|<\?.*?\?>|<[^>]*>', ' ', 'g'),"
    r" '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))"
)


@query(f"SELECT page_id, length({_STRIPPED}) AS n_chars, CASE WHEN length({_STRIPPED}) <= 20 THEN 'empty' WHEN length({_STRIPPED}) >= 200 THEN 'substantial' ELSE 'marginal' END AS class FROM pages")
def text_volume_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length(X.strip_markup(F.col("html")))
    return table(spark, sf_dir, "pages").select("page_id", n.alias("n_chars"), X.volume_class(n).alias("class"))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(replace(replace(text, 'the', '**the**'), ' of ', ' *of* '), '\*\*(.+?)\*\*', '<hi rend="bold">\1</hi>', 'g'), '\*(.+?)\*', '<hi rend="italic">\1</hi>', 'g')) AS digest FROM documents""")
def markdown_to_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("replace(replace(text, 'the', '**the**'), ' of ', ' *of* ')")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.markdown_inline(text)).alias("digest"))


@query("SELECT doc_id, md5(regexp_replace(replace(text, 'nd ', '-' || chr(10)), '-' || chr(10) || '([a-zà-öø-ÿß])', '\\1', 'g')) AS digest FROM documents")
def dehyphenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.dehyphenate(F.expr("replace(text, 'nd ', '-\\n')"))).alias("digest"))


@query("""WITH o AS (SELECT doc_id, string_split(text, 'the') AS p FROM documents)
SELECT doc_id, CASE WHEN len(p) > 3 THEN length(p[1]) + length(p[2]) + length(p[3]) + 6 ELSE -1 END AS third FROM o""")
def nth_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.nth_index(F.col("text"), F.lit("the"), F.lit(2)).alias("third"))
