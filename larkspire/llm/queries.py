"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspire.llm.common import held_out, read_table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.ann import nearest

    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


OP1_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, list_dot_product(q.e, v.e) AS score FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.language_id import identify_held_out

    return identify_held_out(read_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.suffix_dedup import dedup_substrings

    return dedup_substrings(read_table(spark, sf_dir, "documents"), digests=True)


OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS s FROM d),
w AS (SELECT doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) AS k FROM p),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM w) WHERE n > 1),
i AS (SELECT doc_id, s, max(s + 100) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM r),
g AS (SELECT doc_id, s, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM i),
m AS (SELECT doc_id, g, min(s) AS a, max(s) + 100 AS b FROM g GROUP BY doc_id, g),
t AS (SELECT doc_id, count(*) AS n, sum(b - a) AS removed FROM m GROUP BY doc_id),
k AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS x, a AS y FROM m UNION ALL SELECT doc_id, max(b), NULL FROM m GROUP BY doc_id),
o AS (SELECT k.doc_id, string_agg(substr(h, 2 * x + 1, CASE WHEN y IS NULL THEN len(h) ELSE 2 * (y - x) END), '' ORDER BY x) AS h FROM k JOIN d ON d.doc_id = k.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(t.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(t.n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(o.h, d.h))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN o ON o.doc_id = d.doc_id
"""


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.decontaminate import find_leaks

    return find_leaks(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH t AS (SELECT 0 AS src, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT src, id, unnest(a) AS word, unnest(range(len(a))) AS pos
  FROM (SELECT src, id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') AS a FROM t)),
c AS (SELECT *, regexp_replace(word, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') AS core,
  coalesce(lag(regexp_matches(word, '[.!?:;]["'')\]}»”’]*$')) OVER (PARTITION BY src, id ORDER BY pos), true) AS opens FROM w),
k AS (SELECT *, lower(core) AS low, regexp_extract(lower(core), '^([$€£]?[-+]?\d+(?:[.,]\d+)*)([a-zµ°%€$£/]+)$', ['n', 'u']) AS nu,
  regexp_full_match(lower(core), '[-+]?(?:\d+(?:[.,:/]\d+)*)(?:st|nd|rd|th|%)?') AS num FROM c),
e AS (SELECT *, coalesce(lag(num) OVER p, false) OR coalesce(lead(num) OVER p, false) AS beside FROM k WINDOW p AS (PARTITION BY src, id ORDER BY pos)),
x AS (SELECT src, id, pos, CASE
  WHEN beside AND (low IN (UNITS) OR lower(word) IN (UNITS)) THEN [{'t': '<unit>', 'v': coalesce(nullif(low, ''), word)}]
  WHEN core = '' THEN []
  WHEN num THEN [{'t': '<num>', 'v': low}]
  WHEN nu.u IN (UNITS) THEN [{'t': '<num>', 'v': nu.n}, {'t': '<unit>', 'v': nu.u}]
  WHEN NOT opens AND regexp_matches(core, '^\p{Lu}') THEN [{'t': '<name>', 'v': low}]
  ELSE [{'t': low, 'v': NULL}] END AS parts FROM e),
u AS (SELECT src, id, pos, unnest(parts) AS part, unnest(range(len(parts))) AS sub FROM x),
y AS (SELECT src, id, part.t AS t, part.v AS v, coalesce(part.v, part.t) AS l, row_number() OVER (PARTITION BY src, id ORDER BY pos, sub) - 1 AS i, count(*) OVER (PARTITION BY src, id) AS n FROM u),
z AS (SELECT src, id, i, n, [t, lead(t, 1) OVER p, lead(t, 2) OVER p, lead(t, 3) OVER p, lead(t, 4) OVER p] AS ts, [l, lead(l, 1) OVER p, lead(l, 2) OVER p, lead(l, 3) OVER p] AS ls FROM y WINDOW p AS (PARTITION BY src, id ORDER BY i)),
g AS (SELECT src, id, i, n, 5 AS size, array_to_string(ts, chr(1)) AS w FROM z WHERE i <= n - 5
  UNION ALL SELECT src, id, i, n, size, size || chr(2) || array_to_string(ls[1:size], chr(1)) FROM z JOIN (SELECT DISTINCT n AS size FROM y WHERE src = 1 AND n < 5) ON i <= n - size AND (src = 0 OR n = size)),
hits AS (SELECT b.id AS item, d.id AS doc, b.i AS bi, d.i AS di, b.w AS w, b.size AS size, d.i - b.i AS s, b.n AS tokens FROM g b JOIN g d ON b.src = 1 AND d.src = 0 AND b.w = d.w),
nb AS (SELECT id AS item, count(DISTINCT w) AS n FROM g WHERE src = 1 GROUP BY id),
ok AS (SELECT item, doc, m, n FROM (SELECT item, doc, count(DISTINCT w) AS m FROM hits GROUP BY item, doc) JOIN nb USING (item) WHERE m >= 0.75 * n),
h AS (SELECT hits.* FROM hits JOIN ok USING (item, doc)),
slack AS (SELECT DISTINCT item, doc, s, unnest([0, greatest(tokens // 2, 1)]) AS slack FROM h),
near AS (SELECT * FROM (SELECT h.*, a.s AS centre, slack, row_number() OVER (PARTITION BY item, doc, a.s, slack, bi ORDER BY abs(h.s - a.s), h.s) AS r
  FROM h JOIN slack a USING (item, doc) WHERE abs(h.s - a.s) <= slack) WHERE r = 1),
occ AS (SELECT item, doc, centre, slack FROM near JOIN nb USING (item) GROUP BY item, doc, centre, slack, n HAVING count(DISTINCT w) >= 0.75 * n),
q AS (SELECT item, doc, NULL AS centre, NULL AS slack, bi, di, size FROM h UNION ALL SELECT item, doc, centre, slack, bi, di, size FROM near JOIN occ USING (item, doc, centre, slack)),
votes AS (SELECT q.item, q.doc, q.centre, q.slack, a.t AS kind, a.v AS own, b.v AS val, count(*) AS c FROM q CROSS JOIN range(5) o(k)
  JOIN y a ON a.src = 1 AND a.id = q.item AND a.i = q.bi + o.k JOIN y b ON b.src = 0 AND b.id = q.doc AND b.i = q.di + o.k WHERE o.k < q.size AND a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY ALL),
best AS (SELECT item, doc, centre, slack, kind, own, max(c) AS top, sum(c) AS total, arg_max(val, (c, val)) AS most FROM votes GROUP BY ALL),
told AS (SELECT item, doc, centre, slack, sum(top) AS agreed, sum(total) AS total, count(*) FILTER (WHERE most <> own) AS changed FROM best GROUP BY ALL),
judged AS (SELECT p.item, p.doc, p.centre, coalesce(changed, 0) AS changed FROM (SELECT DISTINCT item, doc, centre, slack FROM q) p
  LEFT JOIN told s ON s.item = p.item AND s.doc = p.doc AND s.centre IS NOT DISTINCT FROM p.centre AND s.slack IS NOT DISTINCT FROM p.slack WHERE coalesce(agreed, 0) >= 0.75 * coalesce(total, 0))
SELECT doc AS doc_id, item AS item_id, m AS n_matched, n AS n_windows, CAST(coalesce(max(changed) FILTER (WHERE centre IS NULL), min(changed)) AS BIGINT) AS n_changed
FROM judged JOIN ok USING (item, doc) GROUP BY item, doc, m, n
"""


def op4_sql() -> str:
    from larkspire.llm.decontaminate import UNITS

    return OP4_SQL.replace("UNITS", ", ".join(f"'{u}'" for u in sorted(UNITS)))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.bpe_codec import encode

    return encode(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), digests=True)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.minhash_dedup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * c >= 75 * (u.n + v.n - c)),
r(x, y) AS (SELECT DISTINCT x, x FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.y, d.doc_id) AS component_id, coalesce(m.y, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.x = d.doc_id
"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.line_dedup import dedup_lines

    done = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, r, unnest(a) AS line, unnest(range(len(a))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, count(g.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE g.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN g ON k.key = g.key GROUP BY r
"""


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.secret_scan import scan_secrets

    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.toxicity import score_toxicity, train, training_rows

    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, train(training_rows(docs), training_rows(labels)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from larkspire.llm.token_counts import count_tokens

    return count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_nearest, op2_language_id, op3_suffix_dedup, op4_decontaminate, op5_bpe_codec, op6_minhash_dedup, op7_line_dedup, op8_secret_scan, op9_toxicity, op10_token_counts)}


def oracle_sql() -> dict[str, str]:
    return {"op1_nearest": OP1_SQL, "op3_suffix_dedup": OP3_SQL, "op4_decontaminate": op4_sql(), "op6_minhash_dedup": OP6_SQL, "op7_line_dedup": OP7_SQL}
