"""DuckDB statements for the queries that SQL can express."""

#: Every row is a document of its own, rows that share an id included.
OP5 = r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT row, doc_id, i, lines[i] AS line, translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM docs, LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)
), common AS (
  SELECT k, max(doc_id) AS last_id FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT row) >= 3
), judged AS (
  SELECT d.*, c.k IS NOT NULL AND d.doc_id IS DISTINCT FROM c.last_id AS lost FROM keyed d LEFT JOIN common c ON d.k = c.k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY row
"""

#: CRC-32 of distinct features byte by byte, with the reflected polynomial 0xEDB88320.
OP11 = r"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, i AS v, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY byte) AS t FROM steps WHERE k = 8),
texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark
), worded AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), features AS (
  SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM worded
), counted AS (SELECT kind, id, f, count(*) AS n FROM features GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, octet_length(encode(f)) + 1),
            lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]::BIGINT)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM counted), crc_table
), bucketed AS (SELECT kind, id, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t
  FROM bucketed GROUP BY bucket
), gained AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain FROM sums
), weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM bucketed JOIN gained USING (bucket) WHERE kind = 'd' GROUP BY id
), scored AS (
  SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS fits,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded LEFT JOIN weighed USING (id) WHERE kind = 'd'
), placed AS (SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN fits AND place <= 25 * (SELECT count(*) FROM scored WHERE fits) // 100 THEN place END AS rank
FROM placed
"""

#: Base 32 of the hexadecimal digest: five digits are four letters.
OP12 = r"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS p FROM pages),
digested AS (SELECT page_id, octet_length(p)::BIGINT AS n, sha1(p) AS h, max(page_id) OVER (PARTITION BY p) AS keeper FROM payloads)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keeper OR keeper IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper OR keeper IS NULL THEN NULL ELSE keeper END AS refers_to
FROM digested
"""

_ASSIGN = """
far{r} AS MATERIALIZED (
  SELECT x.row, x.p, b.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))::BIGINT AS far
  FROM parts x JOIN book{r} b USING (p)
), near{r} AS MATERIALIZED (
  SELECT row, p, e, far FROM far{r} QUALIFY row_number() OVER (PARTITION BY row, p ORDER BY far, e) = 1
)"""
_ROUND = """
means{r} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY i) AS v FROM (
    SELECT n.p, n.e, i, floor(sum(x.v[i])::DOUBLE / count(*))::BIGINT AS m
    FROM near{r} n JOIN parts x ON x.row = n.row AND x.p = n.p, range(1, (SELECT max(len(v)) FROM parts) + 1) AS t(i)
    GROUP BY n.p, n.e, i) GROUP BY p, e
), book{s} AS MATERIALIZED (
  SELECT p, e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN means{r} m USING (p, e)
)"""

#: Six rounds written out one after another; every pair of part and entry is compared.
OP13 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, p, v[len(v) // 8 * p + 1 : len(v) // 8 * (p + 1)] AS v FROM kept, range(8) t(p)
), book0 AS MATERIALIZED (SELECT p, row - 1 AS e, v FROM parts WHERE row <= 16),
{",".join(_ASSIGN.format(r=r) + "," + _ROUND.format(r=r, s=r + 1) for r in range(6))},
{_ASSIGN.format(r=6)}, coded AS (
  SELECT row, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(far)::BIGINT AS error FROM near6 GROUP BY row
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book6) AS codebooks_sha256
FROM coded JOIN kept USING (row)
"""

ORACLE_SQL = {"op5_line_dedup": OP5, "op11_importance_resampling": OP11, "op12_warc_archives": OP12, "op13_vector_codes": OP13}
