"""SQL (DuckDB) for the queries of :mod:`corpusq.llm.registry`, written apart from the operators, constants included."""

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""

#: Notices and page furniture.
_NOTICES = "|".join([
    "all rights reserved", "licensed under", "released under the", "general public license", "creative commons", "terms of (?:use|service)", "privacy policy",
    "cookie policy", "cookie settings", "cookie notice", "(?:use|uses|accept|accepting) (?:all cookies|cookies)", "enable javascript", "subscribe to (?:our|the|this)", "sign up for",
    "log in", "click here", "read more", "share this", "back to top", "skip to content", "powered by", r"copyright ©", r"copyright \(c\)", "copyright [0-9]{4}", "© ?[0-9]{4}",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "cookies akzeptieren", "hier klicken", "mehr lesen", "nach oben",
    "tous droits réservés", "politique de confidentialité", "conditions d''utilisation", "accepter les cookies", "cliquez ici", "lire la suite", "haut de page",
    "todos los derechos reservados", "política de privacidad", "condiciones de uso", "aceptar cookies", "aceptar las cookies", "haga clic", "leer más", "volver arriba",
])

ORACLE["op2_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x : x <> '') AS ws, string_split(t, chr(10)) AS ls FROM d),
tri AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
pos AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep),
reps AS (SELECT doc_id, count(*) AS r FROM pos GROUP BY doc_id),
line AS (SELECT doc_id, unnest(ls) AS l FROM w),
judged AS (
  SELECT doc_id, l, length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) AS dense,
    len(list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda x : x <> '')) AS n,
    len(string_split_regex(l, '!!(?:[\x20\x09-\x0D]|$)')) - 1 AS shouts
  FROM line),
failed AS (
  SELECT doc_id, dense, dense > 0 AS worded, l,
    length(l) - length(regexp_replace(l, '[#*$%&|<>~^=_]', '', 'g')) > 0.1 * dense
    OR length(l) - length(regexp_replace(l, '[|•»›]', '', 'g')) >= 2
    OR (shouts >= 4 AND 2 * shouts > n)
    OR regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$')
    OR (l <> '' AND 200 * len(regexp_extract_all(lower(l), '{_NOTICES}')) >= length(l)) AS bad
  FROM judged),
lines AS (
  SELECT doc_id, coalesce(sum(dense) FILTER (NOT bad), 0) AS kept_chars, count(*) FILTER (bad) AS n_removed_lines,
    count(*) FILTER (worded) - count(DISTINCT l) FILTER (worded) AS n_dup_lines
  FROM failed GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(list_aggregate(ws || [''], 'string_agg', ''))::BIGINT AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines, coalesce(r, 0) AS n_repeat_words,
    n_removed_lines, kept_chars::BIGINT AS kept_chars
  FROM w JOIN lines USING (doc_id) LEFT JOIN reps USING (doc_id))
SELECT *, base_failed IS FALSE AND word_chars - kept_chars <= 0.3 * word_chars AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
"""

ORACLE["op5_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < max(page_id) OVER w THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY payload_digest)
"""

#: Plain patterns and confirmations, apart from the operator's. ``\b`` stands in for look-around: the test
#: tables have no letters beyond ASCII beside such spans; the tests compare the operator with a brute-force version.
_CODE, _DIGITS = "replace(hit, ' ', '')", "regexp_replace(hit, '[^0-9]', '', 'g')"
_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 0.9, "mail|contact"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_bool_and(list_transform(string_split(hit, '.'), lambda x : length(ltrim(x, '0')) <= 3 AND coalesce(try_cast(ltrim(x, '0') AS INT), 0) <= 255))", 0.6, "ip|address|host"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(0, length({_DIGITS})), lambda i : CASE WHEN i % 2 = 0 THEN substr({_DIGITS}, length({_DIGITS}) - i, 1)::INT WHEN substr({_DIGITS}, length({_DIGITS}) - i, 1)::INT > 4 THEN 2 * substr({_DIGITS}, length({_DIGITS}) - i, 1)::INT - 9 ELSE 2 * substr({_DIGITS}, length({_DIGITS}) - i, 1)::INT END)) % 10 = 0", 0.8, "card|visa|credit"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15", 0.6, "phone|tel|call|mobile"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", f"length({_CODE}) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length({_CODE}) + 1), lambda i : (instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr(substr({_CODE}, 5) || substr({_CODE}, 1, 4), i, 1)) - 1)::BIGINT)), lambda a, x : (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1", 0.9, "iban|account|konto"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(hit, '^(000|666|9)|-00-|-0000$')", 0.3, "ssn|social security"),
]
_FOUND = " UNION ALL ".join(
    f"SELECT r, t, '{k}' AS kind, {i} AS place, {s} AS base, '(^|[^a-z])({w})' AS words, ({c}) AS good, hit, start FROM (SELECT r, t, h[i] AS hit, (list_sum(list_transform(p[1:i], lambda x : length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x : length(x))), 0))::INT AS start FROM (SELECT r, t, h, p, unnest(range(1, len(h) + 1)) AS i FROM (SELECT r, t, regexp_extract_all(t, '{x}') AS h, string_split_regex(t, '{x}') AS p FROM d)))"
    for i, (k, x, c, s, w) in enumerate(_KINDS)
)
ORACLE["op10_pii"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_FOUND}),
s AS (SELECT r, kind, place, start, start + length(hit) AS e, least(1.0, base + CASE WHEN regexp_matches(lower(substr(t, greatest(1, start + 1 - 40), least(start, 40))), words) THEN 0.4 ELSE 0 END) AS score FROM f WHERE good),
k AS (SELECT * FROM s WHERE place < 4 OR score >= 0.6),
g AS (SELECT r, string_agg(kind || ':' || start || ':' || e, ',' ORDER BY start, place) AS spans, string_agg(kind || ':' || start || ':' || e, ',' ORDER BY start, place) FILTER (place < 4) AS base,
  string_agg(printf('%.2f', score::DOUBLE), ',' ORDER BY start, place) AS scores, count(*) FILTER (place = 0) AS a, count(*) FILTER (place = 1) AS b, count(*) FILTER (place = 2) AS c, count(*) FILTER (place = 3) AS p FROM k GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_email, coalesce(b, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(p, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN g USING (r)
"""
