"""SQL twins (DuckDB) of the operators that SQL can express over whole tables."""

from __future__ import annotations

VECTORS = """WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.vec_id) AS n_links,
       (SELECT min(b) FROM reach WHERE a = v.vec_id) AS component_id,
       (SELECT min(b) FROM reach WHERE a = v.vec_id) = v.vec_id AS kept
FROM v"""

_PRICE = "1 + (CAST({n} + 5 AS HUGEINT) * 1000000000) // ({total} + 5 * {terms})"

DIVERGENCE = f"""WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 30),
langs AS (SELECT lang, count(*) AS terms, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
seen AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM seen GROUP BY ALL),
grid AS (
  SELECT lang, source, term, coalesce(seen.n, 0) AS n,
         {_PRICE.format(n="coalesce(seen.n, 0)", total="coalesce(totals.total, 0)", terms="langs.terms")} AS p,
         {_PRICE.format(n="kept.n", total="langs.total", terms="langs.terms")} AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang)
  LEFT JOIN totals USING (lang, source) LEFT JOIN seen USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(apart.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM grid WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""

# CRC-32 a byte and a bit at a time; the names are ASCII
_CRC = """xor(list_reduce(
    [4294967295::UBIGINT] || list_transform(range(1, len(name) + 1), lambda i: ascii(substr(name, i::BIGINT, 1))::UBIGINT),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))),
    4294967295)"""

REPAIR = f"""WITH RECURSIVE named AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN '' ELSE '=' || conv_id END AS conv, turn,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
kinds AS (SELECT *, {_CRC} % 20 AS kind FROM named),
damaged AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (
           PARTITION BY conv ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text)) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '' END AS initial
  FROM damaged),
lines AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS beside,
         CASE WHEN solid = '' THEN 3
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
              WHEN right(solid, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault
  FROM placed),
sizes AS (SELECT conv, count(*) AS n FROM lines GROUP BY conv),
moves(initial, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
inserts(p, q, cost, audit) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''),
  (0, 2, 2, 'I'), (1, 2, 2, 'I'), (3, 2, 2, 'I'), (2, 3, 2, 'I'), (0, 3, 4, 'II'), (1, 3, 4, 'II')),
edits AS (
  SELECT conv, i, p, p AS q, 3 AS cost, 'D' AS letter FROM lines, (SELECT unnest([0, 1, 2, 3]) AS p)
  UNION ALL SELECT conv, i, p, q, fault, 'K' FROM lines JOIN moves USING (initial) WHERE fault < 2
  UNION ALL SELECT conv, i, p, q, 2 + fault, 'R' FROM lines, moves WHERE fault < 2 AND moves.initial <> 's'),
steps AS (
  SELECT conv, i, e.p, s.q, e.cost + s.cost AS cost, e.letter || s.audit AS audit
  FROM edits e JOIN inserts s ON e.q = s.p),
paths(conv, i, q, best) AS (
  SELECT conv, 0::BIGINT, q, struct_pack(cost := cost::BIGINT, audit := audit) FROM sizes, inserts WHERE p = 0
  UNION ALL
  SELECT s.conv, s.i, s.q, min(struct_pack(cost := (best.cost + s.cost)::BIGINT, audit := best.audit || s.audit))
  FROM paths JOIN steps s ON s.conv = paths.conv AND s.i = paths.i + 1 AND s.p = paths.q GROUP BY s.conv, s.i, s.q),
answers AS (
  SELECT conv, min(best) AS best FROM paths JOIN sizes USING (conv) WHERE i = n AND q IN (0, 3) GROUP BY conv),
letters AS (
  SELECT conv, spot, substr(audit, spot::BIGINT, 1) AS letter, len(replace(audit, 'D', '')) AS kept
  FROM (SELECT conv, best.audit AS audit, unnest(range(1, len(best.audit) + 1)) AS spot FROM answers)),
marked AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w - 1 - kept % 2 AS place
  FROM letters WINDOW w AS (PARTITION BY conv ORDER BY spot)),
repaired AS (
  SELECT conv, string_agg(
    CASE letter WHEN 'K' THEN role ELSE to_role END || ':'
      || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS text
  FROM (SELECT m.conv, spot, letter, l.role, l.text, CASE WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END AS to_role
        FROM marked m LEFT JOIN lines l ON l.conv = m.conv AND l.i = m.i WHERE letter <> 'D') GROUP BY conv),
counted AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 3) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 1) AS truncated,
         count(*) FILTER (beside IS NOT NULL AND beside NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lines GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(repaired.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM named) LEFT JOIN counted USING (conv)
LEFT JOIN answers USING (conv) LEFT JOIN repaired USING (conv)"""

ORACLE: dict[str, str] = {
    "op4_embedding_dedup": VECTORS,
    "op11_source_divergence": DIVERGENCE,
    "op13_conversation_repair": REPAIR,
}
