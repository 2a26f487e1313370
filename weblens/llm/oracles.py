"""DuckDB SQL for the queries that SQL can express."""

SOURCE_MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':mix')[1:3])::INT AS bucket
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT 0 AS round, sum(3 * source_size)::HUGEINT AS num, sum(2 * weight)::HUGEINT AS den FROM totals
  UNION ALL
  SELECT round + 1,
         (SELECT sum(3 * source_size)::HUGEINT - coalesce(sum(4 * source_size) FILTER (weight * f.num > 2 * source_size * f.den), 0)
          FROM totals)::HUGEINT,
         (SELECT coalesce(sum(2 * weight) FILTER (NOT weight * f.num > 2 * source_size * f.den), 0) FROM totals)::HUGEINT
  FROM filled f WHERE round < 100 AND den > 0),
level AS (SELECT num, den FROM filled ORDER BY round DESC LIMIT 1),
goals AS (
  SELECT source, source_size,
         CASE WHEN den = 0 OR weight * num > 2 * source_size * den THEN source_size::DOUBLE * 2
              ELSE (weight * num)::DOUBLE / den::DOUBLE END AS target
  FROM totals, level),
wanted AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
         target - whole * source_size AS want
  FROM goals),
cells AS (
  SELECT s.source, s.bucket, sum(s.size)::BIGINT AS amount, any_value(w.want) AS want
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source WHERE s.size > 0 GROUP BY s.source, s.bucket),
ordered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket) AS k FROM cells),
steps AS (
  SELECT source, 0::BIGINT AS k, -1 AS bucket, want AS rest, false AS taken, 0::BIGINT AS amount FROM wanted
  UNION ALL
  SELECT s.source, o.k, o.bucket, CASE WHEN o.amount <= s.rest THEN s.rest - o.amount ELSE s.rest END, o.amount <= s.rest, o.amount
  FROM steps s JOIN ordered o ON o.source IS NOT DISTINCT FROM s.source AND o.k = s.k + 1),
lasts AS (SELECT source, arg_max(rest, k) AS rest FROM steps GROUP BY source),
extras AS (
  SELECT s.source, arg_min(s.bucket, (abs(s.amount - l.rest), s.bucket)) AS extra
  FROM steps s JOIN lasts l ON s.source IS NOT DISTINCT FROM l.source
  WHERE s.k > 0 AND NOT s.taken AND abs(s.amount - l.rest) < l.rest GROUP BY s.source)
SELECT s.doc_id, s.size, w.source_size, w.target,
       (s.size * (w.whole + coalesce(t.taken OR s.bucket IS NOT DISTINCT FROM e.extra, false)::INT))::BIGINT AS taken
FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source
LEFT JOIN steps t ON s.source IS NOT DISTINCT FROM t.source AND s.bucket = t.bucket
LEFT JOIN extras e ON s.source IS NOT DISTINCT FROM e.source
"""

NEAR_DUPLICATES = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))) AS norm
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.95),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, l.b) AS component_id,
       least(e.vec_id, l.b) = e.vec_id AS kept
FROM embeddings e LEFT JOIN least l ON e.vec_id = l.a LEFT JOIN counted c ON e.vec_id = c.a
"""

HAMMING = """
WITH codes AS (
  SELECT vec_id, list_sum(list_transform(range(len(embedding)), lambda i: CASE WHEN embedding[i + 1] > 0
         AND NOT isnan(embedding[i + 1]) THEN (1::HUGEINT << i::INT) ELSE 0 END))::UHUGEINT::UBIGINT AS code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code)::BIT)::BIGINT AS distance
  FROM codes q, codes c WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank, vec_id, distance
FROM near QUALIFY rank <= 10
"""

JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(len(w) - 3), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) END AS s
  FROM words),
sized AS (SELECT doc_id, len(s)::BIGINT AS n_shingles, s FROM sets),
flat AS (SELECT doc_id, n_shingles AS n, unnest(s) AS x FROM sized),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, s.n_shingles, least(s.doc_id, l.b) AS component_id FROM sized s LEFT JOIN least l ON s.doc_id = l.a
"""

CONVERSATIONS = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(
           list_concat([4294967295], list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, ignored: xor(x >> 1, 3988292384 * (x & 1)))),
           4294967295) % 20 AS kind
  FROM conversations),
kept AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn FROM kept),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('', '.', '!', '?') AS cut,
         coalesce(lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY rn) || role[1:1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM numbered),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv_id),
acts(f, t, letter, needs, price, gives) AS (VALUES
  (0, 0, 'D', NULL, 4, NULL), (1, 1, 'D', NULL, 4, NULL), (2, 2, 'D', NULL, 4, NULL), (3, 3, 'D', NULL, 4, NULL),
  (0, 2, 'R', NULL, 3, 'user'), (1, 2, 'R', NULL, 3, 'user'), (2, 3, 'R', NULL, 3, 'assistant'), (3, 2, 'R', NULL, 3, 'user'),
  (0, 1, 'K', 's', 0, NULL), (0, 2, 'K', 'u', 0, NULL), (1, 2, 'K', 'u', 0, NULL), (2, 3, 'K', 'a', 0, NULL), (3, 2, 'K', 'u', 0, NULL)),
inserts(f, t, letters, added) AS (VALUES
  (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
  (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:'])),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM counted
  UNION ALL
  SELECT w.conv_id, w.i + 1, a.t, min({
           'cost': (w.best.cost + 3 * length(s.letters) + a.price + CASE WHEN a.letter <> 'D' AND r.cut THEN 3 ELSE 0 END)::BIGINT,
           'audit': w.best.audit || s.letters || a.letter,
           'lines': list_concat(w.best.lines, s.added, CASE a.letter WHEN 'D' THEN [] ELSE [coalesce(a.gives, r.role) || ':' || r.text] END)})
  FROM ways w JOIN inserts s ON s.f = w.state
  JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.rn = w.i + 1
  JOIN acts a ON a.f = s.t AND (a.letter = 'D' OR NOT r.blank AND NOT r.again AND (a.letter = 'R' OR a.needs = r.role[1:1]))
  GROUP BY w.conv_id, w.i, a.t),
ended AS (
  SELECT w.conv_id, min({'cost': (w.best.cost + 3 * length(s.letters))::BIGINT, 'audit': w.best.audit || s.letters,
                         'lines': list_concat(w.best.lines, s.added)}) AS best
  FROM ways w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
  JOIN inserts s ON s.f = w.state AND s.t IN (0, 3) GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
       coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES = {
    "op1_near_duplicates": NEAR_DUPLICATES,
    "op2_source_mix": SOURCE_MIX,
    "op7_ngram_jaccard": JACCARD,
    "op8_hamming_topk": HAMMING,
    "op13_conversation_repair": CONVERSATIONS,
}
