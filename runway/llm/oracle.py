"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: words of a text: maximal runs of bytes other than ASCII white space
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

ORACLES["op5_minhash_neardup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN coalesce(len(w), 0) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS x FROM w
), d AS (SELECT DISTINCT doc_id, x FROM s
), n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM d a JOIN d b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node WHERE r.root < l.b
), low AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents JOIN low ON node = documents.doc_id LEFT JOIN n ON n.doc_id = documents.doc_id
"""

ORACLES["op6_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op3_substring_dedup"] = f"""
WITH w AS (
  SELECT doc_id, coalesce({_WORDS.format(text="text")}, []) AS w FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w WHERE len(w) >= 13
), h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS x FROM g
), m AS (SELECT x, min(doc_id) AS least FROM h GROUP BY x
), r AS (SELECT doc_id, i FROM h JOIN m USING (x) WHERE least < doc_id
), c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM r
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM words ANTI JOIN c USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLES["op11_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM d WINDOW same AS (PARTITION BY text)
"""

ORACLES["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), v AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL
), g AS (SELECT DISTINCT lang, source FROM d
), size AS (SELECT lang, count(*) AS v, sum(n) AS n FROM v GROUP BY lang
), total AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) + any_value(size.v) AS total FROM g JOIN size USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source
), p AS (
  SELECT total.lang, total.source, v.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 1)) // total.total AS p, 1 + (1000000000 * (v.n + 1)) // (size.n + size.v) AS q
  FROM total JOIN size USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = v.lang AND c.source = total.source AND c.term = v.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES["op13_resample"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), words AS (SELECT doc_id, unnest(w) AS word FROM d
), target AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), distinct_words AS (SELECT DISTINCT word FROM (SELECT word FROM words UNION ALL SELECT word FROM target)
), crc_table AS (
  SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS x FROM range(256) AS r(i)
), crc_list AS (SELECT list(x ORDER BY i) AS x FROM crc_table
), hex_words AS (SELECT word, hex(encode(word)) AS h FROM distinct_words
), hashed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, len(h) // 2),
      lambda k: CAST(('0x' || substr(h, CAST(2 * k + 1 AS BIGINT), 2)) AS BIGINT))),
    lambda r, b: xor(r >> 8, crc_list.x[CAST(xor(r & 255, b) + 1 AS BIGINT)])), 4294967295) % 10000 AS bucket
  FROM hex_words, crc_list
), s AS (SELECT bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM words) + 10000 AS DOUBLE)
    / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT count(*) FROM target) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), weights AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || d.doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""
