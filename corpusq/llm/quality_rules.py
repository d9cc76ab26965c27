"""Quality rules, line-first, DataFrame operations only (no shuffle: every value is row-local).

Each ``\\n``-split line is judged by three rules; lines that fail are removed, and a document that
loses more than ``MAX_LOST`` of its word characters is rejected:

* punctuation: over ``MAX_MARKS`` of the line's characters outside words' letters and digits are
  decoration (``#*$%&|<>~^=_``), or over half of its words (of at least four) end in ``!!``, or the
  line breaks off in an ellipsis: a teaser;
* navigation: three or more entries separated by bars, bullets or angle quotes;
* boilerplate: phrases of licences, consent banners or page furniture, in four languages, at least one
  for every ``BOILERPLATE_CHARS`` characters, however long the line. Words that ordinary sentences
  use (cookie, copyright) count in the phrases of such notices only.

Before that a document fails the base rules if it has under 50 words or more than half of them
lie in three-word windows that occur twice or more in it.

Null text has no words: it fails. Empty text the same. Repeated rows give repeated results, null ids
stay, texts of any length are judged whole; extra columns, whatever their names, are ignored by
:func:`quality` and carried along by :func:`clean_documents`. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_LOST = 0.3
MAX_MARKS = 0.1
#: Phrases of notices and page furniture, in lower case, as patterns, by a part that each
#: of them holds. Lines are judged by the patterns only where a text holds one of the parts.
BOILERPLATE_CHARS = 200
NOTICES = {
    "rights reserved": ["all rights reserved"], "licen": ["licensed under", "general public license"], "released under": ["released under the"], "creative commons": ["creative commons"],
    "terms of": ["terms of use", "terms of service"], "privac": ["privacy policy", "política de privacidad"], "cookie": ["cookie (?:policy|settings|notice)", "(?:uses|use|accept|accepting) (?:all )?cookies", "cookies akzeptieren", "accepter les cookies", "aceptar (?:las )?cookies"],
    "javascript": ["enable javascript"], "subscribe to": ["subscribe to (?:our|the|this)"], "sign up": ["sign up for"], "log in": ["log in"], "click here": ["click here"], "read more": ["read more"], "share this": ["share this"],
    "back to top": ["back to top"], "skip to": ["skip to content"], "powered by": ["powered by"], "copyright": ["copyright (?:©|\\(c\\)|[0-9]{4})"], "©": ["© ?[0-9]{4}"],
    "vorbehalten": ["alle rechte vorbehalten"], "datenschutz": ["datenschutzerklärung"], "nutzungsbed": ["nutzungsbedingungen"], "hier klicken": ["hier klicken"], "mehr lesen": ["mehr lesen"], "nach oben": ["nach oben"],
    "tous droits": ["tous droits réservés"], "confidentialit": ["politique de confidentialité"], "conditions d": ["conditions d'utilisation"], "cliquez": ["cliquez ici"], "lire la suite": ["lire la suite"], "haut de page": ["haut de page"],
    "los derechos": ["todos los derechos reservados"], "condiciones de": ["condiciones de uso"], "haga clic": ["haga clic"], "leer más": ["leer más"], "volver arriba": ["volver arriba"],
}
BOILERPLATE = [p for patterns in NOTICES.values() for p in patterns]
MARKS = "[#*$%&|<>~^=_]"
NAVIGATION = "[|•»›]"
SHOUT = r"!!(?:[\x20\x09-\x0D]|$)"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _words(text: str) -> str:
    """SQL of the array of words of the string expression ``text``."""
    trimmed = f"trim(BOTH ' \\t\\n\\u000b\\u000c\\r' FROM {text})"
    return f"if({trimmed} = '', cast(array() as array<string>), split({trimmed}, '[\\\\x20\\\\x09-\\\\x0D]+', -1))"


def _chars(text: str, pattern: str) -> str:
    """SQL of the number of characters of ``text`` that match the one-character ``pattern``."""
    return f"(length({text}) - length(regexp_replace({text}, {_sql(pattern + '+')}, '')))"


def line_fails(line: str) -> str:
    """SQL predicate: the line expression breaks one of the rules; ``_notice`` tells whether its text may hold a notice."""
    dense = f"length(regexp_replace({line}, '[\\\\x20\\\\x09-\\\\x0D]+', ''))"
    shouts = f"(size(split({line}, {_sql(SHOUT)}, -1)) - 1)"
    return (
        f"({_chars(line, MARKS)} > {MAX_MARKS} * {dense}"
        f" OR size(split({line}, {_sql(NAVIGATION)}, -1)) >= 3"
        f" OR ({shouts} >= 4 AND 2 * {shouts} > size({_words(line)}))"
        f" OR endswith(trim(TRAILING ' \\t\\n\\u000b\\u000c\\r' FROM {line}), '...') OR endswith(trim(TRAILING ' \\t\\n\\u000b\\u000c\\r' FROM {line}), '…')"
        f" OR (_notice AND {line} <> '' AND {BOILERPLATE_CHARS} * regexp_count(lower({line}), {_sql('|'.join(BOILERPLATE))}) >= length({line})))"
    )


def _repeat_words() -> str:
    """SQL of the words in three-word windows found twice or more, from the columns _w and n_words.

    Windows are hashed; only where a hash repeats are they sorted, and neighbours with one hash
    count as equal when their words are.
    """
    hashes = "transform(sequence(0, n_words - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2]))"
    order = f"sort_array(transform({hashes}, (h, i) -> struct(h, i)))"
    same = "(s[k].h = s[{o}].h AND _w[s[k].i] = _w[s[{o}].i] AND _w[s[k].i + 1] = _w[s[{o}].i + 1] AND _w[s[k].i + 2] = _w[s[{o}].i + 2])"
    marks = (
        f"transform(array({order}), s -> sort_array(filter(transform(s, (x, k) -> if((k > 0 AND {same.format(o='k - 1')}) OR (k < n_words - 3 AND {same.format(o='k + 1')}), x.i, -1)), p -> p >= 0)))[0]"
    )
    covered = f"aggregate({marks}, struct(0 as n, -3 as last), (a, p) -> struct(a.n + least(3, p - a.last) as n, p as last), a -> a.n)"
    distinct = f"size(array_distinct({hashes}))"
    return f"if(n_words < 4, 0, if({distinct} = n_words - 2, 0, {covered}))"


def _analysed(rows: DataFrame) -> DataFrame:
    """``rows`` has _t (never null); adds the columns of :func:`quality` and _kept_lines."""
    lines = "split(_t, '\\n', -1)"
    worded = f"filter({lines}, l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    low = rows.selectExpr("*", "lower(_t) as _low")
    notice = " OR ".join(f"contains(_low, {_sql(part)})" for part in NOTICES)
    return (
        low.selectExpr("*", f"({notice}) as _notice", f"{_words('_t')} as _w", f"{lines} as _l", f"{worded} as _wl")
        .selectExpr("*", "size(_w) as n_words", f"filter(_l, l -> NOT {line_fails('l')}) as _kept_lines")
        .selectExpr(
            "*",
            "length(array_join(_w, '')) as word_chars",
            f"{_chars('_t', '[#*$%&|<>]')} as n_symbols",
            "size(_wl) - size(array_distinct(_wl)) as n_dup_lines",
            f"{_repeat_words()} as n_repeat_words",
            "length(regexp_replace(array_join(_kept_lines, ''), '[\\\\x20\\\\x09-\\\\x0D]+', '')) as kept_chars",
            "size(_l) - size(_kept_lines) as n_removed_lines",
        )
        .selectExpr("*", f"n_words < {MIN_WORDS} OR 100L * n_repeat_words > 50L * n_words as base_failed")
        .selectExpr("*", f"NOT base_failed AND (word_chars - kept_chars) <= {MAX_LOST} * word_chars as kept")
    )


RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "kept_chars"]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base counts (long), base_failed, kept."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    longs: list[Column] = [F.col(c).cast("long").alias(c) for c in RESULT]
    return _analysed(rows).select(F.col("_id").alias(id_col), *longs, "base_failed", "kept")


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents that pass, all their columns, without the lines that failed.

    Where ``chars_col`` is a column, it is set to the code points of the cleaned text.
    """
    rows = _analysed(docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")))
    # The always-true partition number keeps the filter above the projections: pushed below them, it would
    # split the text anew for every word it looks at.
    kept = rows.withColumn("_part", F.spark_partition_id()).where("kept AND _part >= 0")
    text = F.array_join("_kept_lines", "\n")
    new = {text_col: text} | ({chars_col: F.length(text).cast(docs.schema[chars_col].dataType)} if chars_col in docs.columns else {})
    return kept.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
