"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

DataFrame operations only. A pattern's matches and the pieces between them give the code point
offsets: ``split`` and ``regexp_extract_all`` walk the same matches, and a running sum by doubling
steps adds their lengths up. What stands at an offset is read from blocks of the text, so the time
grows with the text, times the logarithm of the number of matches, however many there are.

Kinds in their fixed order: email, ip, card, phone (the base: every confirmed match counts) and the
added ones iban (mod-97) and ssn (needs a context word). An added span must score ``MIN_SCORE``:
its kind's start score, plus ``CONTEXT_BONUS`` if one of its kind's words stands within
``CONTEXT_CHARS`` before it. Base spans carry a score too, and stay whatever it is.

An IBAN is tried at every place it may start, at the length its country has: whatever follows it or
fails before it takes nothing from it. Codes outside the table take as many groups as follow. Of
confirmed ones that overlap the first stays.

Null text counts as empty: no spans. Spans of different kinds may overlap; :func:`redact` masks
overlapping spans as one, by the kind of the first. Repeated rows give repeated results, null ids
stay, texts of any length are searched whole. :func:`spans` ignores extra columns, whatever their
names, :func:`redact` carries them along. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = KINDS[:4]
MIN_SCORE, CONTEXT_BONUS, CONTEXT_CHARS = 0.6, 0.4, 40
#: Length of an IBAN: the countries of the registry that have it.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL PS SV", 29: "BR EG QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Takes the two letters only, so that other starts are tried too; the whole code is group 1."""
    codes = {n: c.replace(" ", "|") for n, c in IBAN.items()}
    known = [rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in codes.items()]
    other = rf"(?!{'|'.join(codes.values())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=((?:{'|'.join([*known, other])})(?![A-Za-z0-9])))[A-Z]{{2}}"


#: The contract's patterns, with possessive parts and a look-behind so that no text takes more than
#: linear time; they match the same spans (of cards, those with as many digits as a card has).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
#: A text without this cannot hold a span of the kind.
NEEDS = {"email": "@", "ip": ".", "card": "[0-9]", "phone": "+", "iban": "[0-9]", "ssn": "-"}
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": ["mail", "contact"], "ip": ["ip", "address", "host"], "card": ["card", "visa", "credit"], "phone": ["phone", "tel", "call", "mobile"],
    "iban": ["iban", "account", "konto"], "ssn": ["ssn", "social security"],
}


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """SQL: the string of digits passes the Luhn check."""
    value = f"cast(substr({digits}, length({digits}) - i, 1) as int)"
    return f"(aggregate(sequence(0, length({digits}) - 1), 0, (a, i) -> a + if(i % 2 = 0, {value}, if({value} > 4, 2 * {value} - 9, 2 * {value}))) % 10 = 0)"


def _mod97(code: str) -> str:
    """SQL: the IBAN without spaces leaves 1 modulo 97 after its first four characters move to the end."""
    moved = f"concat(substr({code}, 5), substr({code}, 1, 4))"
    value = f"cast(instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr({moved}, i, 1)) - 1 as int)"
    return f"(aggregate(sequence(1, length({code})), 0, (a, i) -> if({value} > 9, a * 100 + {value}, a * 10 + {value}) % 97) = 1)"


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_DIGITS = "regexp_replace(m.hit, '[^0-9]', '')"
_CODE = "replace(m.hit, ' ', '')"
CONFIRM = {
    "email": "true",
    "ip": f"m.hit rlike {_sql('^' + _OCTET + ('[.]' + _OCTET) * 3 + '$')}",
    "card": _luhn(_DIGITS),
    "phone": f"length({_DIGITS}) between 10 and 15",
    "iban": f"if(length({_CODE}) between 15 and 34, {_mod97(_CODE)}, false)",
    "ssn": "true",
}


#: Code points in a block of the text.
SHIFT = 8
BLOCK = 1 << SHIFT
_BLOCKS = f"regexp_extract_all(_t, '(?s).{{1,{BLOCK}}}', 0)"


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(values: str, both: str) -> str:
    """SQL: the running combination of an array, in doubling steps; ``both`` combines x and y."""
    return (
        f"aggregate(sequence(0, length(bin(size({values})))), {values},"
        f" (s, k) -> transform(s, (x, i) -> if(i < shiftleft(1, k), x, {both.replace('y', 's[i - shiftleft(1, k)]')})))"
    )


def _cut(blocks: str, start: str, end: str) -> str:
    """SQL: the text from ``start`` to before ``end``, from its blocks."""
    first, last = f"shiftright({start}, {SHIFT})", f"shiftright(greatest({end} - 1, {start}), {SHIFT})"
    return f"substr(array_join(slice({blocks}, {first} + 1, {last} - {first} + 1), ''), ({start} & {BLOCK - 1}) + 1, {end} - {start})"


def _spans(kind: str) -> str:
    """SQL of the confirmed spans of one kind in _t: array of (start, place, kind, end, score)."""
    pattern, need = _sql(PATTERNS[kind]), NEEDS[kind]
    found = f"_t rlike {_sql(need)}" if len(need) > 1 else f"instr(_t, {_sql(need)}) > 0"
    none = "cast(array() as array<struct<start:int,place:int,kind:string,end:int,score:double>>)"
    group, taken = (1, "2") if kind == "iban" else (0, "length({})")
    steps = f"transform(v.h, (h, k) -> length(v.p[k]) + {taken.format('h')})"
    ends = _let(steps, "n", _running("n", "x + y"))
    placed = f"zip_with(v.h, {ends}, (h, e) -> struct(e - {taken.format('h')} as start, e - {taken.format('h')} + length(h) as end, h as hit))"
    good = _let(f"struct(regexp_extract_all(_t, {pattern}, {group}) as h, split(_t, {pattern}, -1) as p)", "v", f"filter({placed}, m -> {CONFIRM[kind]})")
    if kind == "iban":  # of overlapping ones the first stays
        flags = "split(aggregate(g, struct(0 as last, '' as f), (a, m) -> if(m.start < a.last, struct(a.last as last, concat(a.f, '0') as f), struct(m.end as last, concat(a.f, '1') as f)), a -> a.f), '')"
        good = _let(good, "g", _let(flags, "f", "filter(g, (m, i) -> f[i] = '1')"))
    words = r"(?<![a-z])(?:" + "|".join(CONTEXT[kind]) + ")"
    before = f"lower({_cut('b', f'greatest(0, m.start - {CONTEXT_CHARS})', 'm.start')})"
    score = f"least(1.0D, {START_SCORE[kind]}D + if({before} rlike {_sql(words)}, {CONTEXT_BONUS}D, 0D))"
    scored = f"transform(g, m -> struct(m.start as start, {KINDS.index(kind)} as place, {_sql(kind)} as kind, m.end as end, {score} as score))"
    if kind not in BASE:
        scored = f"filter({scored}, s -> s.score >= {MIN_SCORE})"
    return f"if({found}, {_let(good, 'g', f'if(size(g) = 0, {none}, {_let(_BLOCKS, chr(98), scored)})')}, {none})"


def _found(rows: DataFrame) -> DataFrame:
    """``rows`` has _t (never null); adds _all, every span by start, then kind."""
    each = rows.selectExpr("*", *[f"{_spans(k)} as _{k}" for k in KINDS])
    return each.selectExpr("*", f"sort_array(concat({', '.join('_' + k for k in KINDS)})) as _all")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base counts, base_sha256, spans, scores (comma-joined, in the order of spans)."""
    rows = _found(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")))
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return rows.selectExpr(
        f"_id as `{id_col}`",
        *[f"cast(size(_{k}) as long) as n_{k}" for k in BASE],
        f"sha2({joined.format(f'filter(_all, s -> s.place < {len(BASE)})')}, 256) as base_sha256",
        f"{joined.format('_all')} as spans",
        "array_join(transform(_all, s -> format_number(s.score, 2)), ',') as scores",
    )


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by ``<KIND>``; ``chars_col`` follows the new text. Null texts stay."""
    rows = _found(docs.select(F.struct("*").alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")))
    # What stands before each span that no earlier one overlaps, then its kind; at last what follows the last end.
    past = _running("e", "greatest(x, y)")
    shown = f"zip_with(_all, m, (s, x) -> struct(s, x)), (z, i) -> if(i > 0 and z.s.start < m[i - 1], '', concat({_cut('b', 'if(i > 0, m[i - 1], 0)', 'z.s.start')}, '<', upper(z.s.kind), '>'))"
    whole = f"concat(array_join(transform({shown}), ''), {_cut('b', 'm[size(m) - 1]', 'length(_t)')})"
    masked = _let("transform(_all, s -> s.end)", "e", _let(past, "m", _let(_BLOCKS, "b", whole)))
    text = F.expr(f"if(size(_all) = 0, _t, {masked})")
    done = rows.select("_row", text.alias("_new"))
    there = F.col(f"_row.`{text_col}`").isNotNull()
    new = {text_col: F.when(there, F.col("_new"))}
    if chars_col in docs.columns:
        new[chars_col] = F.when(there, F.length("_new").cast(docs.schema[chars_col].dataType)).otherwise(F.col(f"_row.`{chars_col}`"))
    return done.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
