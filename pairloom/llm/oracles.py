"""SQL twins of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_FOLDED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""

OP6 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, pos, md5(array_to_string(list_slice(w, pos, pos + 49), ' ')) AS h FROM s),
m AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY h) AS least FROM h),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS i FROM m WHERE least < doc_id),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT k.doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM k ANTI JOIN gone USING (doc_id, i) GROUP BY k.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP7 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_FOLDED}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_FOLDED}') AS w FROM benchmark),
i AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, list_slice(w, pos, pos + 9) AS win FROM i),
z AS (SELECT DISTINCT len(win) AS size FROM p),
s AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, z WHERE len(w) >= size),
o AS (SELECT doc_id, pos, size, item_id FROM (SELECT doc_id, pos, size, list_slice(w, pos, pos + size - 1) AS win FROM s) x JOIN p USING (win)),
n AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS x FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
  n.n IS NOT NULL AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, pos, pos + 3), ' ')) AS h FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS pos FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT l.b, r.reached FROM r JOIN l ON l.a = r.doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)"""

OP9 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id, vec_id AS reached FROM v UNION SELECT l.b, r.reached FROM r JOIN l ON l.a = r.vec_id),
c AS (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, component_id = vec_id AS kept FROM c LEFT JOIN n USING (vec_id)"""


_KEY = "substr(md5(concat_ws(':', {})), 1, 16)"

OP11 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS words, count(*) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS num FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE num % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM src),
o AS (SELECT *, coalesce(sum(3 * words) OVER (ORDER BY 3 * words / weight, num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
  sum(weight) OVER (ORDER BY 3 * words / weight, num ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
l AS (SELECT coalesce(arg_min(level, pos), 0) AS level FROM (
  SELECT ((SELECT sum(words) FROM w) - spent) / rest AS level, words, weight, row_number() OVER (ORDER BY 3 * words / weight, num) AS pos FROM o) WHERE 3 * words >= level * weight),
t AS (SELECT w.*, CASE WHEN 3 * words < level * weight THEN CAST(3 * words AS DOUBLE) ELSE level * weight END AS target,
  greatest(1, CAST(ceil(words / 1048576) AS BIGINT), CAST(ceil(n / 65536) AS BIGINT)) AS shards FROM w, l),
g AS (SELECT source, doc_id, size, count(*) AS copies FROM d GROUP BY ALL),
c AS (SELECT source, doc_id, size, copies, unnest(range(0, (copies - 1) // 64 + 1)) AS lot FROM g),
k AS (SELECT c.*, t.num, t.shards, least(64, copies - 64 * lot) AS held,
  {_KEY.format("'0', coalesce(CAST(doc_id AS VARCHAR), ''), size, lot")} AS key FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source),
s AS (SELECT *, (CAST('0x' || substr(key, 1, 8) AS BIGINT) * shards) >> 32 AS shard FROM k),
p AS (SELECT *, coalesce(CAST(sum(size * held) OVER (PARTITION BY num, shard ORDER BY key, doc_id, size, lot
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS begin FROM s),
b AS (SELECT num, shard, CAST(sum(size * held) AS BIGINT) AS words, (CAST(sum(size * held) AS BIGINT) + 15) // 16 AS blocks
  FROM p GROUP BY num, shard HAVING sum(size * held) > 0),
v AS (SELECT t.num, t.target * CAST(sum(b.blocks) AS BIGINT) / t.words AS votes, CAST(3 * sum(b.blocks) AS BIGINT) AS most
  FROM t JOIN b ON t.num = b.num GROUP BY t.num, t.target, t.words),
q AS (SELECT num, count(*) AS seats FROM (
  SELECT num, row_number() OVER (ORDER BY votes / (2 * k + 1) DESC, num) AS r FROM (SELECT num, votes, unnest(range(0, most)) AS k FROM v))
  WHERE r <= (SELECT floor(sum(votes) + 0.5) FROM v) GROUP BY num),
u AS (SELECT num, shard, count(*) AS quota FROM (
  SELECT x.num, shard, seats, row_number() OVER (PARTITION BY x.num ORDER BY votes / (2 * k + 1) DESC, shard) AS r
  FROM (SELECT num, shard, CAST(blocks AS DOUBLE) AS votes, unnest(range(0, 3 * blocks)) AS k FROM b) x JOIN q ON x.num = q.num)
  WHERE r <= seats GROUP BY num, shard),
z AS (SELECT b.num, b.shard, b.words, blocks, coalesce(quota, 0) AS quota FROM b LEFT JOIN u ON b.num = u.num AND b.shard = u.shard),
e AS (SELECT num, shard, i, i * words // blocks AS low, (i + 1) * words // blocks AS high, quota // blocks
    + CASE WHEN row_number() OVER (PARTITION BY num, shard ORDER BY {_KEY.format("'0', 'block', num, shard, i")}, i) <= quota % blocks THEN 1 ELSE 0 END AS times
  FROM (SELECT *, unnest(range(0, blocks)) AS i FROM z)),
f AS (SELECT num, shard, doc_id, size, begin + j * size AS low, begin + (j + 1) * size AS high FROM (SELECT *, unnest(range(0, held)) AS j FROM p)),
y AS (SELECT f.num, f.shard, f.doc_id, f.low, f.size, coalesce(CAST(sum(times * (least(f.high, e.high) - greatest(f.low, e.low))) AS BIGINT), 0) AS taken
  FROM f LEFT JOIN e ON f.num = e.num AND f.shard = e.shard AND e.low < f.high AND e.high > f.low GROUP BY ALL)
SELECT doc_id, size, words AS source_size, target, taken, source FROM y JOIN t ON y.num = t.num"""
