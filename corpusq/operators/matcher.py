"""Mentions of a curated list's entities in texts: forms, surnames, and the signals that weigh a find.

The list comes as two tables. ``forms``: form, gid, category, rule. ``surnames``: key, gid, and
``released``, true where the surname alone may stand for its bearer. Both meet the texts' words by
their first word; joins are broadcast where the list is small (its size is checked), else shuffled.

At each word one find stays: the longest listed form; else a person's form in capitals; else a form of
two or more words that differs in case; else a surname, over as many hyphens as a key has. Behind a
form may stand a genitive s or an adjective suffix (tier 2). Of finds that overlap in a document
the earlier one stays, whole; a person's full name takes a particle and its own surname with it.

A surname is resolved by the persons whose full names stand anywhere in the document: one of its
bearers anchors it (tier 1), several make it ambiguous; without any a released bearer takes it, else it
stays bare. Signals demote a find to tier 2, in this order of suffixes: ``:ambiguous`` (several
bearers), ``:suspect`` (homograph, compound, citation or institution around it), then the zones it
stands in. Null texts have no finds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.sources.tables import small
from corpusq.storage import stored

#: Tiers of rules, words and suffixes that the rules name.
TIER_1 = ["full-name", "variant-full-name", "initial-surname", "anchored-surname", "anchor-free-surname", "caps-full-name", "org-name", "org-variant", "org-token", "work-title", "work-variant"]
FULL_NAMES = ["full-name", "variant-full-name", "caps-full-name", "initial-surname"]
WEIGHED_SURNAMES = ["bare-surname", "anchored-surname", "anchor-free-surname"]
ADJECTIVE_SUFFIXES = ["iennes", "ienne", "schem", "schen", "scher", "sches", "iens", "iano", "iana", "iani", "iane", "sche", "ien", "ian"]
FUNCTION_WORDS = ["weil", "wahl"]
HONORIFICS = [
    "dr", "frau", "fräulein", "herr", "herrn", "madame", "mademoiselle", "miss", "mister", "mlle", "mme", "monsieur", "mr", "mrs", "nationalrat", "pfarrer",
    "prof", "professor", "signor", "signora", "signorina", "sir",
]
INSTITUTIONS = ["Fondation", "Stiftung", "Foundation", "Fondazione"]
PARTICLES, EDITORS = ["de", "von", "van"], ["éd", "ed", "hrsg", "Hrsg", "Hg"]
ZONES = ["in-plain-bibl", "in-figure", "running-head"]
W = r"[\p{L}\p{N}_]"
BEFORE, BEHIND = 40, 90


#: A list with at most so many forms and surnames is broadcast whole, so that other words are left out at once.
CURATED = 200_000


def words(docs: DataFrame, reach: int, doc: str = "doc_id", text: str = "text", names: set[str] | None = None, forms: set[str] | None = None) -> DataFrame:
    """doc, at, word, before (``BEFORE`` characters), after (``reach`` characters from the word on) of every word.

    With a list, only words where it may stand: ``names``, lower-case first words of surnames, as they are, with a genitive s or an
    adjective suffix; ``forms``, where the text has the whole form, case aside.
    """
    known = docs.sparkSession.sparkContext.broadcast((names, forms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, (names, forms) = re.compile(r"\w+"), known.value
        endings = ("s", *ADJECTIVE_SUFFIXES)
        # By the first word and the two characters behind it; "" where these do not tell.
        index: dict[str, dict[str, list[tuple[int, str, str]]]] = {}
        for form in {v for f in forms or () for v in (f, f.upper())}:
            if first := word.search(form):
                behind = form[first.end() : first.end() + 2].lower()
                index.setdefault(first[0].lower(), {}).setdefault(behind if form.isascii() and len(behind) == 2 else "", []).append((first.start(), form, form.lower()))

        def wanted(t: str, at: int, w: str) -> bool:
            low = w.lower()
            if low in names or low.endswith(endings) and any(low.endswith(e) and low[: -len(e)] in names for e in endings):
                return True
            listed = index.get(low)
            if listed is None:
                return False
            behind = t[at + len(w) : at + len(w) + 2].lower()
            for lead, form, same in (*(listed.get(behind, ()) if behind else ()), *listed.get("", ())):
                if at >= lead and ((piece := t[at - lead : at - lead + len(form)]) == form or piece.lower() == same):
                    return True
            return False

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = [(d, m.start(), m[0], t[max(0, m.start() - BEFORE) : m.start()], t[m.start() : m.start() + reach]) for m in word.finditer(t or "") if names is None or wanted(t, m.start(), m[0])]
                for k in range(0, len(found), 10_000):
                    cols = list(zip(*found[k : k + 10_000]))
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, kinds)], ["doc", "at", "word", "before", "after"])

    return docs.select(F.col(doc).cast("long"), text).mapInArrow(run, "doc long, at long, word string, before string, after string")


def tier_of(rule: Column) -> Column:
    """1 for the rules of the first tier, 2 for the others and for derived channels (a colon in the rule)."""
    return F.when(rule.isin(TIER_1), 1).otherwise(2)


def _behind(rest: Column, closed: Column) -> Column:
    """What follows a form that matched: kind and length of its ending, null where the word goes on. ``closed``: the form ends in no word character."""
    suffix = F.regexp_extract(rest, f"^({'|'.join(ADJECTIVE_SUFFIXES)})(?!{W})", 1)
    ending = lambda kind, n: F.struct(F.lit(kind).alias("kind"), n.cast("int").alias("n"))
    return (
        F.when(closed, ending("plain", F.lit(0)))
        .when(suffix != "", ending("adjective", F.length(suffix)))
        .when(rest.rlike(f"^s(?!{W})"), ending("genitive", F.lit(1)))
        .when(~rest.rlike(f"^{W}"), ending("plain", F.lit(0)))
    )


def _owned(forms: DataFrame, surnames: DataFrame, key: Column) -> DataFrame:
    """Each form once: key, its owner with the least gid, and all bearers, those of an equal surname included."""
    owners = forms.groupBy(key.alias("form")).agg(F.min(F.struct("gid", "category", "rule")).alias("o"), F.collect_set("gid").alias("gids"))
    named = surnames.groupBy(F.col("key").alias("form")).agg(F.collect_set("gid").alias("named"))
    both = owners.join(named, "form", "left")
    bearers = F.sort_array(F.array_union("gids", F.coalesce("named", F.array().cast("array<string>"))))
    first = F.regexp_extract("form", f"{W}+", 0)
    return both.select("form", "o.gid", "o.category", "o.rule", bearers.alias("bearers"), first.alias("first"), (F.instr("form", first) - 1).alias("lead")).where("first <> ''")


_FOUND = ["doc", "at", "start", "stop", "gid", "category", "rule", "tier", "bearers", "form", "channel", "before", "rest"]


def _form_finds(tokens: DataFrame, forms: DataFrame, channel: int, same: Column, met: Column, rule: Column, ending: Column | None = None) -> DataFrame:
    """Finds of forms at words: ``met`` joins by the first word, ``same`` holds where the text has the form."""
    n = F.length("form") - F.col("lead")
    hit = tokens.join(small(forms), met).where(same)
    hit = hit.withColumn("rest", F.expr("substr(after, cast(length(form) - lead + 1 as int))"))
    closed = ~F.col("form").rlike(f"{W}$")
    hit = hit.withColumn("end", _behind(F.col("rest"), closed) if ending is None else ending).where("end is not null")
    adjective = F.col("end.kind") == "adjective"
    hit = hit.withColumn("rule", F.when(adjective, "adjective-form").otherwise(rule))
    hit = hit.withColumn("tier", tier_of(F.col("rule"))).withColumn("channel", F.lit(channel)).withColumn("start", F.col("at") - F.col("lead")).withColumn("stop", F.col("at") + n + F.col("end.n"))
    return hit.withColumn("rest", F.expr("substr(rest, end.n + 1)")).select(*_FOUND)


def _surname_finds(tokens: DataFrame, surnames: DataFrame) -> DataFrame:
    """Finds of surnames: as they are or in the genitive, over hyphens; else as an adjective; else in capitals."""
    run = F.regexp_extract("after", f"^{W}+(?:-{W}+)*", 0)
    parts = F.split(run, "-")
    whole = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "-"))
    one = lambda key, n, kind: F.struct(key.alias("key"), n.cast("int").alias("n"), F.lit(kind).alias("kind"))
    plain = F.transform(whole, lambda p: one(p, F.length(p), 0))
    genitive = F.transform(F.filter(whole, lambda p: F.endswith(p, F.lit("s"))), lambda p: one(F.regexp_replace(p, "s$", ""), F.length(p), 1))
    word, n = F.col("word"), F.length("word")
    stems = F.array(*[F.when(F.endswith(word, F.lit(s)) & (n > len(s)), one(F.regexp_replace(word, f"{s}$", ""), n, 2 + k)) for k, s in enumerate(ADJECTIVE_SUFFIXES)])
    caps = F.when((n > 1) & (word == F.upper(word)) & (word != F.lower(word)), F.array(one(word, n, 99)))
    tries = F.concat(plain, genitive, F.array_compact(stems), F.coalesce(caps, F.expr("cast(array() as array<struct<key:string,n:int,kind:int>>)")))
    keys = surnames.groupBy("key").agg(F.sort_array(F.collect_set("gid")).alias("gids"), F.sort_array(F.collect_set(F.when(F.col("released"), F.col("gid")))).alias("free"))
    upper = surnames.where(F.upper("key") != F.col("key")).groupBy(F.upper("key").alias("key")).agg(F.sort_array(F.collect_set("gid")).alias("gids"), F.array().cast("array<string>").alias("free"))
    listed = keys.withColumn("caps", F.lit(False)).unionByName(upper.withColumn("caps", F.lit(True)))
    hit = tokens.select("*", F.explode(tries).alias("t")).select("*", "t.*").join(small(listed), "key").where(F.col("caps") == (F.col("kind") == 99))
    order = [F.when(F.col("kind") < 2, 0).otherwise(F.col("kind")), F.when(F.col("kind") < 2, -F.col("n")), F.col("kind")]
    hit = hit.withColumn("_k", F.row_number().over(Window.partitionBy("doc", "at").orderBy(*order))).where("_k = 1")
    rule = F.when(F.col("kind") < 2, "bare-surname").when(F.col("kind") == 99, "caps-surname").otherwise("adjective-form")
    return hit.select(
        "doc", "at", F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("stop"), F.col("gids")[0].alias("gid"), F.lit("person").alias("category"), rule.alias("rule"),
        F.lit(2).alias("tier"), F.col("gids").alias("bearers"), F.col("key").alias("form"), F.lit(3).alias("channel"), "before", F.expr("substr(after, n + 1)").alias("rest"), "free",
    )


def _leftmost(finds: DataFrame) -> DataFrame:
    """Of overlapping finds of a document the earlier one, in one pass over the document's finds."""
    cols = [c for c in finds.columns if c not in ("doc", "start", "stop")]
    lists = finds.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "stop", F.struct(*cols).alias("x")))).alias("a"))
    flags = "split(aggregate(a, struct(0L as last, '' as f), (s, m) -> if(m.start < s.last, struct(s.last as last, concat(s.f, '0') as f), struct(m.stop as last, concat(s.f, '1') as f)), s -> s.f), '')"
    kept = lists.withColumn("f", F.expr(flags)).select("doc", F.explode(F.expr("filter(a, (m, i) -> f[i] = '1')")).alias("m"))
    return kept.select("doc", "m.start", "m.stop", "m.x.*")


def find(docs: DataFrame, forms: DataFrame, surnames: DataFrame, zones: DataFrame | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, start, stop, gid, category, rule, tier, alternatives, form of every find.

    ``zones``: doc, kind (of ``ZONES``), start, stop; a find that starts in one carries its suffix.
    """
    reach = (forms.agg(F.max(F.length("form"))).first()[0] or 0) + BEHIND
    listed = [x.distinct().limit(CURATED + 1).collect() for x in (surnames.select(F.lower(F.regexp_extract("key", f"{W}+", 0)).alias("w")), forms.select(F.col("form").alias("w")))]
    curated = sum(map(len, listed)) <= CURATED
    tokens = words(docs, reach, doc, text, *[{r.w for r in x} if curated else None for x in listed])
    tokens = stored(tokens, "matcher-words") if curated else tokens
    exact, upper = _owned(forms, surnames, F.col("form")), F.upper("form")
    person = forms.where((F.col("category") == "person") & F.contains("form", F.lit(" ")) & (F.length(upper) == F.length("form")) & (upper != F.col("form")))
    caps = _owned(person.withColumn("rule", F.lit("caps-full-name")), surnames.limit(0), upper)
    n = "cast(length(form) - lead as int)"
    there = F.expr(f"substr(after, 1, {n}) = substr(form, lead + 1) and right(before, lead) = left(form, lead)")
    a = _form_finds(tokens, exact, 0, there, F.col("word") == F.col("first"), F.col("rule"))
    go_on = F.when(~F.col("rest").rlike(f"^{W}"), F.struct(F.lit("plain").alias("kind"), F.lit(0).alias("n")))
    b = _form_finds(tokens.where("length(word) > 1 and word = upper(word)"), caps, 1, there, F.col("word") == F.col("first"), F.col("rule"), go_on)
    piece = F.expr(f"concat(right(before, lead), substr(after, 1, {n}))")
    lower_piece = (piece == F.lower(piece)) & (F.col("form") != F.lower("form"))
    small_title = (F.col("category") == "work") & piece.rlike(r"^\p{Ll}") & F.col("form").rlike(r"^\p{Lu}")
    other = (F.lower(piece) == F.lower("form")) & (piece != F.col("form")) & ~((F.col("category") == "person") & (piece == F.upper(piece)))
    loose = exact.where(F.contains("form", F.lit(" "))).withColumn("lower_first", F.lower("first"))
    c = _form_finds(tokens, loose, 2, other, F.lower("word") == F.col("lower_first"), F.when(lower_piece | small_title, F.concat("rule", F.lit(":suspect"))).otherwise(F.col("rule")))
    none = F.array().cast("array<string>").alias("free")
    finds = reduce(DataFrame.unionByName, [x.select("*", none) for x in (a, b, c)]).unionByName(_surname_finds(tokens, surnames))
    best = Window.partitionBy("doc", "at").orderBy("channel", (F.col("start") - F.col("stop")), "form")
    finds = finds.withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k")
    # A form of several bearers is ambiguous; the surnames' own rules decide later.
    listed = F.col("channel") < 3
    many = (F.size("bearers") > 1) & (listed | F.col("rule").isin("adjective-form", "caps-surname"))
    suspect = F.endswith("rule", F.lit(":suspect"))
    bare = F.regexp_replace("rule", ":suspect$", "")
    rule = F.when(many, F.concat(bare, F.lit(":ambiguous"), F.when(suspect, ":suspect").otherwise(""))).otherwise(F.col("rule"))
    finds = finds.withColumns({"rule": rule, "tier": F.when(many, 2).otherwise(F.col("tier"))})
    # What follows asks the finds several times; each would look up all words again.
    finds = stored(finds, "matcher-finds")
    # A full name goes on over a particle to its own surname.
    base = F.substring_index("rule", ":", 1)
    full = (F.col("category") == "person") & base.isin(FULL_NAMES) & (F.col("tier") == 1)
    bridge = F.when(full, F.regexp_extract("rest", f"^ (?:{'|'.join(PARTICLES)}) ({W}+)", 1))
    finds = finds.withColumn("_b", F.nullif(bridge, F.lit("")))
    own = surnames.select(F.col("key").alias("_key"), F.col("gid").alias("_gid")).distinct().withColumn("_own", F.lit(True))
    over = finds.where("_b is not null").select("doc", "at", "gid", F.explode(F.array_distinct(F.array("_b", F.regexp_replace("_b", "s$", "")))).alias("_key"))
    over = over.join(small(own.withColumnRenamed("_gid", "gid")), ["_key", "gid"]).select("doc", "at", "_own").distinct()
    finds = finds.join(over, ["doc", "at"], "left")
    longer = F.length(F.regexp_extract("rest", f"^ (?:{'|'.join(PARTICLES)}) {W}+", 0))
    finds = finds.withColumns({"stop": F.when(F.col("_own"), F.col("stop") + longer).otherwise(F.col("stop")), "rest": F.when(F.col("_own"), F.expr("substr(rest, length(regexp_extract(rest, '^ (?:" + "|".join(PARTICLES) + ") [\\\\p{L}\\\\p{N}_]+', 0)) + 1)")).otherwise(F.col("rest"))})
    finds = _leftmost(finds.drop("_b", "_own"))
    finds = stored(_guarded(finds), "matcher-kept")
    anchors = finds.where((F.col("tier") == 1) & (F.col("category") == "person") & (F.col("channel") < 3)).select("doc", F.col("gid").alias("_a")).distinct()
    finds = _resolved(finds, anchors)
    finds = _weighed(finds, tokens, forms, surnames)
    finds = _zoned(finds, zones) if zones is not None else finds
    return finds.select("doc", "start", "stop", "gid", "category", "rule", "tier", "alternatives", "form")


def _compound() -> Column:
    """A hyphen stands right before or behind the find."""
    return F.endswith("before", F.lit("-")) | F.startswith("rest", F.lit("-"))


def _guarded(finds: DataFrame) -> DataFrame:
    """First-tier forms in compounds, and full names in a citation or behind an institution's word, become suspect."""
    full = (F.col("category") == "person") & F.col("rule").isin(FULL_NAMES)
    editor = F.col("rest").rlike(f"^, (?:{'|'.join(EDITORS)})\\.")
    author = F.col("before").rlike(r"[A-ZÀ-Þ]\S* [A-ZÀ-Þ]\.(?: ?[A-ZÀ-Þ]\.)*, $")
    house = F.col("before").rlike(rf"(?:^|\s)(?:{'|'.join(INSTITUTIONS)}) $")
    hit = (F.col("tier") == 1) & (F.col("channel") < 3) & (_compound() | (full & (editor | author | house)))
    return _suspected(finds, hit)


def _suspected(finds: DataFrame, hit: Column) -> DataFrame:
    marked = finds.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    return marked.withColumns({"rule": F.when(F.col("_hit"), F.concat("rule", F.lit(":suspect"))).otherwise(F.col("rule")), "tier": F.when(F.col("_hit"), 2).otherwise(F.col("tier"))}).drop("_hit")


def _resolved(finds: DataFrame, anchors: DataFrame) -> DataFrame:
    """Surnames by the persons the document names in full; adds alternatives."""
    held = finds.where((F.col("channel") == 3) & (F.col("rule") == "bare-surname")).select("doc", "start", F.explode("bearers").alias("_a")).join(anchors, ["doc", "_a"])
    held = held.groupBy("doc", "start").agg(F.sort_array(F.collect_set("_a")).alias("_in"))
    met = finds.join(held, ["doc", "start"], "left")
    surname, n, free = (F.col("channel") == 3) & (F.col("rule") == "bare-surname"), F.coalesce(F.size("_in"), F.lit(0)), F.size("free")
    n = F.when(F.col("_in").isNull(), 0).otherwise(n)
    rule = (
        F.when(~surname, F.col("rule")).when(n == 1, "anchored-surname").when(n > 1, "ambiguous-surname").when(free == 1, "anchor-free-surname")
        .when(F.size("bearers") > 1, "bare-surname:ambiguous").otherwise("bare-surname")
    )
    gid = F.when(surname & (n > 0), F.get("_in", F.lit(0))).when(surname & (free == 1), F.get("free", F.lit(0))).otherwise(F.col("gid"))
    several = F.when(F.size("bearers") > 1, F.col("bearers")).otherwise(F.array().cast("array<string>"))
    tier = F.when(surname & ((n == 1) | ((n == 0) & (free == 1))), 1).otherwise(F.col("tier"))
    return met.withColumns({"rule": rule, "gid": gid, "tier": tier, "alternatives": several}).drop("_in")


def _weighed(finds: DataFrame, tokens: DataFrame, forms: DataFrame, surnames: DataFrame) -> DataFrame:
    """Surnames that other signs show to be no names become suspect.

    A lower-case twin in the document, a function word, a hyphen beside it, a bracket without a digit
    behind it, a capitalised neighbour that is no listed pair with it (not at a sentence's start or an
    honorific before; not behind a genitive).
    """
    base = F.substring_index("rule", ":", 1)
    mine = finds.withColumn("_w", base.isin(WEIGHED_SURNAMES) & (F.col("channel") == 3))
    surface = F.expr("concat(form, '')")
    genitive = F.col("stop") - F.col("start") > F.length("form")
    mine = mine.withColumn("_s", F.when(genitive, F.concat(surface, F.lit("s"))).otherwise(surface))
    low = tokens.where(F.col("word").rlike(r"^\p{Ll}")).select("doc", F.lower("word").alias("_f")).distinct()
    asked = mine.where("_w").select("doc", F.lower("_s").alias("_f")).distinct()
    twins = asked.join(low, ["doc", "_f"]).select(F.col("doc").alias("_d"), "_f", F.lit(True).alias("_twin"))
    # Neighbours: the word before, unless it starts a sentence, and the word behind.
    left = F.regexp_extract("before", f"(^|.)( *)({W}+) $", 3)
    opens = F.col("before").rlike(rf"(?:^|[.!?:;]) *{W}+ $")
    right = F.regexp_extract("rest", f"^ ({W}+)", 1)
    known = forms.select(F.col("form").alias("_pair")).unionByName(forms.select(F.upper("form").alias("_pair"))).distinct().withColumn("_known", F.lit(True))
    mine = mine.withColumn("_l", F.when(F.col("_w") & (left != "") & left.rlike(r"^\p{Lu}") & ~opens & ~F.lower(left).isin(HONORIFICS), F.concat(left, F.lit(" "), F.col("_s"))))
    mine = mine.withColumn("_r", F.when(F.col("_w") & ~genitive & right.rlike(r"^\p{Lu}"), F.concat("_s", F.lit(" "), right)))
    mine = mine.join(twins, (F.col("doc") == F.col("_d")) & (F.lower("_s") == F.col("_f")), "left").drop("_d", "_f")
    for side in ("_l", "_r"):
        mine = mine.join(small(known.withColumnRenamed("_pair", side).withColumnRenamed("_known", f"{side}k")), side, "left")
    bracket = F.col("rest").rlike(r"^ ?\([^)0-9]{0,60}\)")
    doubt = F.coalesce("_twin", F.lit(False)) | F.lower("_s").isin(FUNCTION_WORDS) | _compound() | bracket | (F.col("_l").isNotNull() & F.col("_lk").isNull()) | (F.col("_r").isNotNull() & F.col("_rk").isNull())
    return _suspected(mine, F.col("_w") & doubt).drop("_w", "_s", "_twin", "_l", "_r", "_lk", "_rk")


def _zoned(finds: DataFrame, zones: DataFrame) -> DataFrame:
    """Suffixes of the zones a find starts in, in their fixed order; each demotes."""
    z = zones.select(F.col("doc").alias("_d"), "kind", F.col("start").alias("_a"), F.col("stop").alias("_z"))
    met = finds.select("doc", "start").join(z, (F.col("doc") == F.col("_d")) & (F.col("start") >= F.col("_a")) & (F.col("start") < F.col("_z")))
    held = met.groupBy("doc", "start").agg(F.collect_set("kind").alias("_kinds"))
    found = finds.join(held, ["doc", "start"], "left")
    suffix = F.concat(*[F.when(F.array_contains("_kinds", k), f":{k}").otherwise("") for k in ZONES])
    inside = F.col("_kinds").isNotNull()
    return found.withColumns({"rule": F.when(inside, F.concat("rule", suffix)).otherwise(F.col("rule")), "tier": F.when(inside, 2).otherwise(F.col("tier"))}).drop("_kinds")
