"""SQL for DuckDB of the registered queries that SQL can express."""

OP11 = r"""
WITH coded AS (SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce([CAST(4294967295 AS BIGINT)] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) AS h FROM documents),
sized AS (SELECT *, len(w) AS n, h // 10 AS g FROM coded),
placed AS (SELECT *, g % greatest(n, 1) AS a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM sized),
texts AS MATERIALIZED (SELECT doc_id, doc, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM placed),
tok AS MATERIALIZED (SELECT doc, i, n, words[i + 1] AS word, CASE WHEN i > 0 THEN words[i] END AS prev FROM (SELECT doc, w AS words, len(w) AS n, unnest(range(len(w))) AS i FROM texts)),
g2 AS (SELECT *, hash(word, lead(word) OVER (PARTITION BY doc ORDER BY i)) AS h FROM tok),
g4 AS (SELECT * REPLACE (hash(h, lead(h, 2) OVER (PARTITION BY doc ORDER BY i)) AS h) FROM g2),
g8 AS (SELECT * REPLACE (hash(h, lead(h, 4) OVER (PARTITION BY doc ORDER BY i)) AS h) FROM g4),
grams AS MATERIALIZED (SELECT doc, i, n, prev, hash(h, lead(h, 8) OVER (PARTITION BY doc ORDER BY i)) AS gram FROM g8 QUALIFY i + 16 <= n),
often AS (SELECT doc, gram FROM grams GROUP BY ALL HAVING count(*) > 1),
again AS MATERIALIZED (SELECT grams.* FROM grams JOIN often USING (doc, gram)),
far AS MATERIALIZED (SELECT DISTINCT x.doc, y.i - x.i AS d FROM again x JOIN again y ON x.doc = y.doc AND x.gram = y.gram AND y.i > x.i AND x.prev IS DISTINCT FROM y.prev AND 3 * (y.i - x.i) <= x.n),
same AS (SELECT far.doc, d, x.i, x.i - row_number() OVER (PARTITION BY far.doc, d ORDER BY x.i) AS island FROM far JOIN tok x ON x.doc = far.doc JOIN tok y ON y.doc = x.doc AND y.i = x.i + d AND y.word = x.word),
stretches AS (SELECT doc, d, min(i) AS start, count(*) + d AS length FROM same GROUP BY doc, d, island),
runs AS MATERIALIZED (SELECT doc, start, length, min(d) AS period FROM stretches WHERE length >= greatest(24, 3 * d) GROUP BY ALL),
listed AS (SELECT doc, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS line FROM runs GROUP BY doc),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS place FROM runs) WHERE place = 1),
gone AS (SELECT DISTINCT doc, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc, string_agg(word, ' ' ORDER BY i) AS text FROM tok ANTI JOIN gone USING (doc, i) GROUP BY doc)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(coalesce(line, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc) LEFT JOIN best USING (doc) LEFT JOIN kept USING (doc)
"""

OP12 = r"""
WITH coded AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS code FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT row, vec_id, unnest(code) AS c, generate_subscripts(code, 1) AS at FROM coded),
scores AS (SELECT q.row AS query, q.vec_id AS query_vec_id, v.row, v.vec_id, CAST(sum(q.c * v.c) AS BIGINT) AS score FROM parts q JOIN parts v ON q.at = v.at AND q.row <> v.row WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_vec_id AS query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""

OP13 = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM words),
items AS (SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
asked AS (SELECT item_id, item, term, count(*) AS times FROM items GROUP BY ALL),
tokens AS (SELECT doc_id, row, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM words),
freq AS MATERIALIZED (SELECT doc_id, row, n, term, count(*) AS tf FROM tokens WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM freq, size GROUP BY term, docs),
impacts AS (SELECT doc_id, row, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)) AS p FROM freq, size),
scores AS (SELECT item_id, item, doc_id, row, CAST(sum(times * w * p) AS BIGINT) AS score FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 20
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha256(body) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6 = f"""
WITH docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS doc, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM (SELECT doc, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS MATERIALIZED (SELECT doc, i, n, item_id FROM grams JOIN windows USING (n, gram)),
hit AS (SELECT doc, count(DISTINCT spot) AS n_hit FROM (SELECT doc, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY doc),
found AS (SELECT doc, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY doc)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (doc) LEFT JOIN found USING (doc)
"""


def _escaped(column):
    """The length of a text with the template's escapes: & < [ ] become 5, 4, 5 and 5 characters."""
    return f"(length({column}) + 4 * (length({column}) - length(replace({column}, '&', ''))) + 3 * (length({column}) - length(replace({column}, '<', ''))) + 4 * (length({column}) - length(translate({column}, '[]', ''))))"


OP7 = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS spot FROM rows),
marked AS (SELECT *, (lag(role) OVER (PARTITION BY conv_id ORDER BY spot) IS DISTINCT FROM role) AS opens FROM placed)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY spot)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY spot) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(7 + sum({_escaped('text')}) + sum(CASE WHEN opens THEN 5 + 2 * {_escaped('role')} ELSE 3 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

O = {"op3_warc_writer": OP3, "op6_decontamination": OP6, "op7_chat_formatting": OP7, "op11_periodic_runs": OP11, "op12_topk_search": OP12, "op13_lexical_search": OP13}
