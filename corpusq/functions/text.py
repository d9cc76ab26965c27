"""Column functions on text: normalisation, folding, tokens, lint counts. All run inside codegen or as native expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import edits
from corpusq.functions.values import (
    BLANK_MARKERS, EXPECTED_EXTRA, FOLD_FROM, FOLD_TO, LANG_2TO3, LANG_B2T, SUSPICIOUS, TEI_FROM, TEI_TO,
)


def normalize_text(c: Column) -> Column:
    """Runs of white space to one space, curly quotes to straight ones, trimmed."""
    return F.trim(F.regexp_replace(F.translate(c, "“”‘’", "\"\"''"), r"(?U)\s+", " "))


def normalize_for_comparison(c: Column, casefold: bool = False) -> Column:
    """Both sides of a comparison: quotes and dashes to ASCII, soft hyphens and spaces before ``; : ? !`` removed, composed last."""
    plain = F.translate(c, "«»„‹›`´‐‑–—‒­", "\"\"\"''''-----")
    plain = F.regexp_replace(plain, " +([;:?!])", "$1")
    return nfc(normalize_text(F.lower(F.replace(plain, F.lit("ß"), F.lit("ss"))) if casefold else plain))


def normalize_for_tei(c: Column) -> Column:
    """The edition's character rules; low single quotes become apostrophes in a second pass."""
    once = F.translate(c, TEI_FROM, TEI_TO)
    return F.regexp_replace(F.translate(once, "‘", "’"), " +([;:?!])", "$1")


def fold(c: Column) -> Column:
    """Lower case without accents, ``ß`` as ``ss``: the searchable form."""
    return F.lower(F.replace(F.translate(c, FOLD_FROM, FOLD_TO), F.lit("ß"), F.lit("ss")))


def normalize_lang_code(c: Column) -> Column:
    """Three-letter code of a language tag; unknown tags stay as they are."""
    code = F.lower(F.regexp_replace(F.trim(c), r"^[\[\]]+|[\[\]]+$", ""))
    primary = F.substring_index(code, "-", 1)
    known = F.create_map(*[F.lit(x) for kv in (LANG_2TO3 | LANG_B2T).items() for x in kv])
    three = F.when(primary.rlike("^[a-z]{3}$"), primary)
    return F.when(c == "", c).otherwise(F.coalesce(known[primary], three, code))


def tokens(c: Column) -> Column:
    """Words of at least two Latin letters."""
    return F.filter(F.regexp_extract_all(c, F.lit("([a-zA-ZÀ-ɏ]+)"), F.lit(1)), lambda w: F.length(w) >= 2)


def rated_words(c: Column, lang: Column) -> Column:
    """The words that a word list is asked for, in lower case.

    French and mixed texts lose capitalised words that are not all capitals (names), as long as half
    of the words remain.
    """
    words = tokens(c)
    plain = F.filter(words, lambda w: ~w.rlike(r"^\p{Lu}") | (w == F.upper(w)))
    chosen = F.when(lang.isin("fr", "multi") & (F.size(plain) >= 0.5 * F.size(words)), plain).otherwise(words)
    return F.transform(chosen, F.lower)


@F.pandas_udf(T.StringType())
def _composed(c: pd.Series) -> pd.Series:
    return c.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


def nfc(c: Column) -> Column:
    """Canonical composition; no built-in composes. Texts of ASCII stay in the JVM."""
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(_composed(c))


def regime(c: Column, name: str) -> Column:
    """The regimes of comparison, each on top of the one before: raw, nfc, nfc_hyphen, nfc_hyphen_case."""
    if name == "raw":
        return c
    out = nfc(c)
    if name in ("nfc_hyphen", "nfc_hyphen_case"):
        out = F.translate(F.replace(out, F.lit("\u00ad"), F.lit("")), "‐‑‒–—", "-----")
    return F.lower(F.replace(out, F.lit("ß"), F.lit("ss"))) if name == "nfc_hyphen_case" else out


def char_count(c: Column, pattern: str) -> Column:
    """Characters that match a one-character pattern."""
    return F.length(c) - F.length(F.regexp_replace(c, f"(?:{pattern})+", ""))


def suspicious_count(c: Column) -> Column:
    """Characters that clean French or German print does not have."""
    return char_count(c, f"[{SUSPICIOUS}]|[^\\x00-\\x7F{EXPECTED_EXTRA}\\p{{Z}}]")


def suspicious_ratio(c: Column) -> Column:
    return F.when(F.length(c) > 0, suspicious_count(c) / F.length(c)).otherwise(F.lit(0.0))


def quality_score(hit_rate: Column, suspicious: Column) -> Column:
    return F.round((0.8 * hit_rate + 0.2 * (1 - suspicious)) * 100, 1)


def blank_reason(c: Column) -> Column:
    """Why a page text counts as blank, '' if it does not (null text does not)."""
    s = F.trim(c)
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), "[^a-z ]+", " "), " +", " "))
    return (
        F.when(c.isNull(), "")
        .when(F.length(s) <= 5, "len<=5")
        .when(~s.rlike("[A-Za-zÀ-ÿ0-9]"), "no-alnum")
        .when((F.length(s) < 40) & words.isin(BLANK_MARKERS), "blank-marker")
        .otherwise("")
    )


def volume_class(n: Column) -> Column:
    return F.when(n <= 20, "empty").when(n >= 200, "substantial").otherwise("marginal")


def page_bucket(n: Column) -> Column:
    return F.when(n <= 2, "xs").when(n <= 5, "s").when(n <= 10, "m").when(n <= 20, "l").when(n <= 60, "xl").otherwise("xxl")


def size_bucket(n: Column) -> Column:
    return F.when(n <= 5, "short").when(n <= 20, "medium").otherwise("long")


def strip_markup(c: Column) -> Column:
    """Comments, instructions and tags to spaces, the five basic references decoded, white space collapsed."""
    bare = F.regexp_replace(c, r"(?s)<!--.*?-->|<\?.*?\?>|<[^>]*>", " ")
    for ref, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(ref), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"[\s]+", " "))


def markdown_inline(c: Column) -> Column:
    """Bold first, then italic, both shortest match."""
    bold = F.regexp_replace(c, r"\*\*(.+?)\*\*", '<hi rend="bold">$1</hi>')
    return F.regexp_replace(bold, r"\*(.+?)\*", '<hi rend="italic">$1</hi>')


def dehyphenate(c: Column) -> Column:
    """Joins words parted by a hyphen at a line end before a lower-case letter."""
    return F.regexp_replace(c, r"-\n(?=\p{Ll})", "")


def paragraphs(c: Column, separator: str = r"\n\s*\n") -> Column:
    """Trimmed non-empty paragraphs."""
    # Not F.trim itself: it has a second argument, for which transform() would give the place.
    return F.filter(F.transform(F.split(F.trim(c), separator), lambda p: F.trim(p)), lambda p: p != "")


def nth_index(text: Column, needle: Column, n: Column) -> Column:
    """0-based index of the nth non-overlapping occurrence (n from 0), -1 if there is none."""
    at = F.length(F.call_function("substring_index", text, needle, (n + 1).cast("int")))
    return F.when(at < F.length(text), at).otherwise(-1)


def context(text: Column, start: Column, end: Column, pad: int = 40) -> Column:
    """The text around a span, white space collapsed."""
    lo = F.greatest(F.lit(0), start - pad)
    return F.trim(F.regexp_replace(F.substring(text, lo + 1, end + pad - lo), r"\s+", " "))


def french_lint(c: Column, french: Column) -> dict[str, Column]:
    """Counts per class of typographic slips. A narrow space before high punctuation is right in French."""
    spaced = lambda p: F.regexp_count(c, F.lit(p))
    low, high = spaced("[   ]+[.,]"), spaced("[   ]+[;:?!]")
    plain_high = spaced("(?<![   ])[ ]+[;:?!»]")
    return {
        "straight_apostrophe": spaced(r"(?<=\p{L})'(?=\p{L})"),
        "guillemets": spaced("[«»]"),
        "hyphenation_residue": spaced("¬"),
        "space_before_punct": low + F.when(french, 0).otherwise(high),
        "space_type": F.when(french, plain_high).otherwise(0),
    }


def initials_only(c: Column) -> Column:
    return c.rlike(r"^(?:\p{Lu}\.[ -]?)+$")


def title_author(c: Column) -> Column:
    """Title case where at least four fifths of the letters are capitals."""
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    capitals = F.length(F.regexp_replace(c, r"[^\p{Lu}]", ""))
    return F.when((letters > 0) & (capitals >= 0.8 * letters), F.initcap(F.lower(c))).otherwise(c)


def diacritic_rate(ref: Column, hyp: Column, letters: str) -> Column:
    """Share of the reference's special letters still there; null where no letters are defined."""
    count = lambda c: char_count(c, f"[{letters}]")
    expected, observed = count(ref), count(hyp)
    return F.when(expected == 0, F.when(observed == 0, 1.0).otherwise(0.0)).otherwise(F.least(expected, observed) / expected)


def class_preservation(ref: Column, hyp: Column, classes: list[str]) -> Column:
    """Mean over the character classes present in the reference of min(hyp / ref, 1); 1 if none is."""
    pairs = F.array(*[F.struct(char_count(ref, k).alias("r"), char_count(hyp, k).alias("h")) for k in classes])
    rates = F.transform(F.filter(pairs, lambda x: x["r"] > 0), lambda x: F.least(x["h"] / x["r"], F.lit(1.0)))
    return F.when(F.size(rates) == 0, 1.0).otherwise(F.aggregate(rates, F.lit(0.0), lambda a, x: a + x) / F.size(rates))


@F.arrow_udf(T.IntegerType())
def distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Levenshtein distance. The built-in fills the whole table cell by cell, forty times slower on pages of a thousand characters."""
    known = lru_cache(4)(edits.distance)  # regimes of one page often give the same pair
    return pa.array([None if x is None or y is None else known(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())


def cer(ref: Column, hyp: Column) -> Column:
    """Character error rate; an empty reference gives 0 for an empty text and 1 for any other."""
    return F.when(F.length(ref) == 0, F.when(F.length(hyp) == 0, 0.0).otherwise(1.0)).otherwise(distance(hyp, ref) / F.length(ref))


def has_emphasis(c: Column) -> Column:
    """Words between stars, or between underscores that stand outside words, without spaces at the edges."""
    return c.rlike(r"\*+(?!\s)[^*\n]+?(?<!\s)\*+") | c.rlike(r"(?U)(?<!\w)_+(?!\s)[^_\n]+?(?<!\s)_+(?!\w)")


def unbracketed(c: Column) -> Column:
    return F.regexp_replace(c, r"^\[(.*)\]$", "$1")


def bracketed(c: Column) -> Column:
    return F.when(c.startswith("["), c).otherwise(F.concat(F.lit("["), c, F.lit("]")))


def first_language(c: Column) -> Column:
    """The first of several languages, in lower case; 'unknown' for none or ``?``."""
    low = F.trim(F.lower(c))
    first = F.trim(F.element_at(F.split(low, "[/,]"), 1))
    return F.when(c.isNull() | c.isin("", "?") | (first == ""), "unknown").otherwise(first)


#: Two-letter codes a header knows, and codes a name scan knows.
IDENTS = {"fr": "fra", "de": "deu", "en": "eng", "it": "ita"}
KNOWN_LANGUAGES, GERMAN = ["fr", "fra", "fre", "en", "eng", "it", "ita", "es", "spa", "de", "deu", "ger"], ["de", "deu", "ger"]


def language_idents(c: Column) -> Column:
    """The three-letter codes of a language field, comma-joined, each once; unknown parts and none are 'und'."""
    parts = F.filter(F.split(F.lower(F.trim(c)), r"[/,;\s]+"), lambda p: p != "")
    known = F.create_map(*[F.lit(x) for kv in IDENTS.items() for x in kv])
    codes = F.array_distinct(F.transform(parts, lambda p: F.when(p.rlike("^[a-z]{3}$"), p).otherwise(F.coalesce(F.try_element_at(known, p), F.lit("und")))))
    return F.when(c.isNull() | (F.size(codes) == 0), "und").otherwise(F.array_join(codes, ","))


def single_words_allowed(c: Column) -> Column:
    """A capitalised word alone tells a name: in a known language without a German share."""
    parts = F.split(F.lower(c), r"[/,;\s]+")
    has = lambda codes: F.arrays_overlap(parts, F.array(*map(F.lit, codes)))
    return F.coalesce(has(KNOWN_LANGUAGES) & ~has(GERMAN), F.lit(False))


def xml_escape(c: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(ref))
    return c


def strip_markdown(c: Column) -> Column:
    return F.regexp_replace(c, "[*_#]", "")


def ascii_only(c: Column) -> Column:
    """Without accents, ``ß`` as ``ss``, any other character beyond ASCII as ``?``."""
    return F.regexp_replace(F.replace(F.translate(c, FOLD_FROM, FOLD_TO), F.lit("ß"), F.lit("ss")), r"[^\x00-\x7F]", "?")


def find_phrase(text: Column, phrase: Column) -> Column:
    """0-based place of a phrase in a text without Markdown signs, case aside; -1 if it is not there."""
    return F.instr(F.lower(strip_markdown(text)), F.lower(phrase)) - 1


def tagged_block(c: Column, tag: str) -> Column:
    """The trimmed content of the first such element, or the trimmed text where there is none."""
    found = F.regexp_extract(c, f"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.when(F.contains(c, F.lit(f"<{tag}>")) & F.contains(c, F.lit(f"</{tag}>")), F.trim(found)).otherwise(F.trim(c))
