"""DuckDB SQL of the queries that SQL can express, written apart from the operators."""

WORD = r"[^\x20\x09-\x0D]+"

#: Every run of 50 or more words that occurs at an earlier place, lines compared without white space around them.
LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), k AS (
  SELECT doc_id, i, regexp_extract(line, '[^\\x20\\x09-\\x0D](.*[^\\x20\\x09-\\x0D])?', 0, 's') AS said, n,
    row_number() OVER w AS p, sum(n) OVER w AS c
  FROM (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS n FROM l) WHERE n > 0
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), reach AS (
  SELECT a.doc_id, a.p AS f, b.p AS t FROM k a JOIN k b ON a.doc_id = b.doc_id AND b.p >= a.p AND b.c >= a.c - a.n + 50
), runs AS (
  SELECT doc_id, f, min(t) AS t FROM reach GROUP BY doc_id, f UNION SELECT doc_id, max(f), t FROM reach GROUP BY doc_id, t
), said AS (
  SELECT r.doc_id, f, t, string_agg(k.said, chr(10) ORDER BY k.p) AS said, min(k.i) AS a, max(k.i) AS b
  FROM runs r JOIN k ON k.doc_id = r.doc_id AND k.p BETWEEN f AND t GROUP BY r.doc_id, f, t
), later AS (
  SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, f) > 1
), gone AS (
  SELECT DISTINCT l.doc_id, l.i FROM l JOIN later ON l.doc_id = later.doc_id AND l.i BETWEEN a AND b
), kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL) AS text, count(gone.i) AS n
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id
)
SELECT doc_id, coalesce(n, 0) AS lines_removed, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN kept USING (doc_id)
"""

#: Shortest prefix of 60 bits of the MD5 of the id whose texts have at most 1 MiB, or that is one document.
SHARDS = """
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
    array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111',
      4 * (instr('0123456789abcdef', c) - 1)::INT + 1, 4) FOR c IN string_split(substr(md5(doc_id::VARCHAR), 1, 15), '')], '') AS bits
  FROM documents
), p AS (
  SELECT doc_id, bytes, substr(bits, 1, n) AS shard, n FROM d, (SELECT unnest(range(61))::INT AS n)
), fit AS (
  SELECT shard, n FROM p GROUP BY shard, n HAVING sum(bytes) <= 1048576 OR count(*) = 1
)
SELECT doc_id, any_value(bytes)::BIGINT AS bytes, min_by(shard, n) AS shard, 0::BIGINT AS page, min(n)::BIGINT AS depth
FROM p JOIN fit USING (shard, n) GROUP BY doc_id
"""

ORACLE = {
    "op1_line_dedup": LINE_DEDUP,
    "op6_extendible_shards": SHARDS,
}
