"""DuckDB SQL for the text operators that SQL can express.

Fingerprints, edit distances, byte strings, keyed permutations, learned weights, token
lattices, page trees and approximate search are tested against brute force instead.
"""

from __future__ import annotations

from tidemark.llm import collocations, host_rules, licenses, prefix_trie

_SPACE = r"\x20\x09-\x0D"

_SHARDING = """
WITH table_ AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
sized AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size,
         CASE WHEN doc_id IS NULL THEN 'null' ELSE 'k' || doc_id END AS key
  FROM documents
),
summed AS (
  SELECT s.*, xor(list_reduce(
      list_concat([4294967295::BIGINT],
        list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) AS text_crc32
  FROM sized s, table_
),
drawn AS (
  SELECT *, list_min(list_transform(range({n}), lambda s: {{'draw': {draw}, 'shard': s}})).shard AS shard,
         list_min(list_transform(range({n} + 1), lambda s: {{'draw': {draw}, 'shard': s}})).shard AS grown
  FROM summed
),
cut AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || '#' || text_crc32 || '#' || size), 1, 12))::BIGINT % 1024 AS piece
  FROM drawn
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY piece, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       grown::INTEGER AS grown_shard
FROM cut
""".format(
    n=40,
    draw="-ln((('0x' || substr(md5(key || '#' || s), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)",
)

_TRIE = """
WITH table_ AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
heads AS (
  SELECT conv_id, conv_id - conv_id % {family} AS base, xor(list_reduce(
      list_concat([4294967295::BIGINT],
        list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) % {heads} AS h
  FROM (SELECT DISTINCT conv_id FROM own), table_
),
rebuilt AS (
  SELECT h.conv_id, o.role, o.text, row_number() OVER (PARTITION BY h.conv_id ORDER BY o.conv_id <> h.base OR o.i > h.h, o.i) AS d
  FROM heads h JOIN own o ON (o.conv_id = h.base AND o.i <= h.h) OR (o.conv_id = h.conv_id AND o.i > h.h)
),
paths AS (
  SELECT conv_id, d, strlen(text) AS bytes,
         list(md5(length(role) || ':' || role || ':' || text)) OVER (PARTITION BY conv_id ORDER BY d) AS key
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, [] FROM heads
),
nodes AS (
  SELECT key, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own_saved
  FROM paths GROUP BY key
),
children AS (SELECT key[:-2] AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT DISTINCT a.key AS top, b.key AS key FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.d >= a.d
),
sums AS (
  SELECT top AS key, count(*) FILTER (c.n IS NULL) AS n_leaves, sum(own_saved) AS saved
  FROM below b JOIN nodes USING (key) LEFT JOIN children c USING (key) GROUP BY top
),
ends AS (
  SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(key, d) AS key FROM paths GROUP BY conv_id) GROUP BY key
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (key) LEFT JOIN children c USING (key) LEFT JOIN ends e USING (key)
LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[:-2]
""".format(family=prefix_trie.FAMILY, heads=prefix_trie.HEADS)

_PHRASES = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS id, lang, piece FROM (
    SELECT coalesce(lang, '{no_lang}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
    FROM documents)
),
words AS (SELECT id, lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces),
total AS (SELECT lang, sum(len(ws)) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words), range(1, {longest} + 1) s(m)
  WHERE i + m - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= {least}
),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS left_, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS right_
  FROM grams c, range(1, {longest}) s(k)
  WHERE c.m > 1 AND k < c.m AND NOT EXISTS (
    SELECT 1 FROM grams g WHERE g.lang = c.lang AND g.m > c.m AND 100 * g.f >= {percent} * c.f
    AND contains(' ' || g.phrase || ' ', ' ' || c.phrase || ' '))
),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r, n::BIGINT AS n,
         ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts JOIN grams l ON l.lang = cuts.lang AND l.phrase = left_ JOIN grams r ON r.lang = cuts.lang AND r.phrase = right_
  JOIN total ON total.lang = cuts.lang
),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= {kept}
""".format(
    longest=collocations.LONGEST, least=collocations.LEAST, percent=collocations.SUBSUMED_PERCENT,
    kept=collocations.KEPT, no_lang=collocations.NO_LANG,
)

_HOSTS = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS text FROM documents
),
w AS (SELECT *, regexp_extract_all(text, '[^{_SPACE}]+') AS ws FROM d),
windows AS (
  SELECT rn, i, array_to_string(ws[i:i + 7], ' ') AS words
  FROM (SELECT rn, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
),
repeated AS (
  SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, words) AS c FROM windows) WHERE c > 1
),
covered AS (
  SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY rn
),
lines AS (
  SELECT rn, count(*) - count(DISTINCT line) AS n
  FROM (SELECT rn, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^{_SPACE}]') GROUP BY rn
),
m AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN lines USING (rn) LEFT JOIN covered USING (rn)
),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         greatest(n_symbols * 5 / greatest(n_words, 1), n_dup_lines * 20 / greatest(n_words, 1),
                  word_chars / (12 * greatest(n_words, 1))) AS excess
  FROM m
),
hosts AS (
  SELECT source, count(*) AS n, sum((base_failed OR n_symbols * 5 > n_words OR n_dup_lines * 20 > n_words
                                     OR word_chars > 12 * n_words)::INT) AS k
  FROM f GROUP BY source
),
sums AS (
  SELECT count(*) AS hosts, sum(n)::DOUBLE AS docs,
         least(greatest(sum(k) / sum(n), 1e-6), 1 - 1e-6) AS mean,
         sum(n * (k / n) * (k / n)) AS squares, sum(n::DOUBLE * n) AS docs_squared
  FROM hosts
),
spread AS (
  SELECT *, mean * (1 - mean) AS largest,
         CASE WHEN docs - docs_squared / docs > 0
           THEN (squares - docs * mean * mean - (hosts - 1) * mean * (1 - mean)) / (docs - docs_squared / docs)
           ELSE 0 END AS variance
  FROM sums
),
prior AS (
  SELECT mean, CASE WHEN variance > 0
      THEN least(greatest(largest / least(variance, largest) - 1, 1.0), 1e6) ELSE 1e6 END AS strength
  FROM spread
),
rates AS (SELECT source, (k + mean * strength) / (n + strength) AS rate FROM hosts, prior),
limits AS (
  SELECT source, greatest(1.0, least({host_rules.GROSS},
    pow((1 - rate) / rate * {host_rules.SUSPECT_RATE / (1 - host_rules.SUSPECT_RATE)}, 1.0::DOUBLE / {host_rules.EVIDENCE_POWER}))) AS limit_
  FROM rates
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND excess <= limit_ AS kept
FROM f JOIN limits l ON l.source IS NOT DISTINCT FROM f.source
"""


def _license_sql(threshold: float = 0.8) -> str:
    rows = [
        f"('{name}', {number}, [{', '.join(repr(g) for g in licenses.template_bigrams(text))}])"
        for name, texts in sorted(licenses.TEMPLATES.items())
        for number, text in enumerate(texts)
    ]
    return rf"""
WITH templates(license, template, grams) AS (VALUES {", ".join(rows)}),
d AS (
  SELECT row_number() OVER () AS rn, doc_id, text, string_split_regex(text, '{licenses.PARAGRAPH_END}') AS paragraphs
  FROM documents WHERE text IS NOT NULL
),
units AS (
  SELECT rn, doc_id, 'line' AS unit, string_split(text, chr(10)) AS parts FROM d
  UNION ALL SELECT rn, doc_id, 'sentence', flatten(list_transform(
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{licenses.SENTENCE_END}[^ \t\r]')),
    lambda l: string_split(regexp_replace(l, '{licenses.SENTENCE_END}', '\1' || chr(10), 'g'), chr(10)))) FROM d
  UNION ALL SELECT rn, doc_id, 'paragraph', paragraphs FROM d
  UNION ALL SELECT rn, doc_id, 'text', [text] FROM d WHERE len(paragraphs) > 1
),
parts AS (
  SELECT rn, doc_id, unit, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS position FROM units
),
words AS (
  SELECT rn, doc_id, unit, position,
         string_split(trim(lower(regexp_replace(part, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS ws
  FROM parts WHERE unit <> 'paragraph' OR contains(part, chr(10))
),
grams AS (
  SELECT rn, doc_id, unit, position,
         list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g
  FROM words
),
scored AS (
  SELECT rn, doc_id, unit, position, license, template, len(g) AS n_bigrams,
         2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM grams JOIN templates ON list_has_any(g, grams)
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY rn, unit, position ORDER BY dice DESC, license, template) = 1 AS best
  FROM scored WHERE dice >= {threshold}
)
SELECT doc_id, unit, position::BIGINT AS position, license, template::INTEGER AS template,
       n_bigrams::BIGINT AS n_bigrams, dice, best FROM ranked
"""


ORACLE: dict[str, str] = {
    "op2_sharding": _SHARDING,
    "op6_license_scan": _license_sql(),
    "op9_host_rules": _HOSTS,
    "op11_prefix_trie": _TRIE,
    "op12_collocations": _PHRASES,
}
