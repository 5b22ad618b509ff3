"""The registered queries of the corpus operators and the SQL that some can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import (
    exact_dedup,
    html_text,
    language_id,
    near_dup,
    packing,
    pii,
    piece_codec,
    quality,
    secret_scan,
    spelling,
    token_alignment,
    topk,
    toxicity,
)
from lodestone.llm.shared import read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.numbered(read_table(spark, sf_dir, "documents"))
    return exact_dedup.exact_groups(rows).drop(exact_dedup.ROW)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.numbered(read_table(spark, sf_dir, "documents"))
    return secret_scan.span_report(secret_scan.secret_spans(rows))


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode(read_table(spark, sf_dir, "documents"))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.held_rows(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near_dup.near_classes(rows).drop(exact_dedup.ROW)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def packed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations, of which only the assistant's bear loss, under three limits that all bind."""
    turns = read_table(spark, sf_dir, "conversations").withColumn(
        "head", F.when(F.col("role") == "assistant", 0).otherwise(F.length("text"))
    )
    limits = packing.Limits(tokens=1024, segments=24, loss=384)
    return packing.pack(turns, id_col="conv_id", limits=limits, loss_from_col="head")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.numbered(read_table(spark, sf_dir, "documents"))
    return pii.span_report(pii.private_spans(rows))


OP1_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       CAST(count(*) OVER w AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm)
"""

OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


def _op5_kind(number: int) -> str:
    """Spans of one kind: values and gaps of its matches, each placed by a running sum of lengths."""
    _, pattern, least = secret_scan.KINDS[number]
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, owner, repo, {number} AS kind, m, v, sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop, {least} AS least
  FROM (SELECT doc_id, owner, repo, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[1:len(ms)]) AS g, generate_subscripts(ms, 1) AS i
    FROM (SELECT doc_id, owner, repo, regexp_extract_all(t, '{quoted}', 0) AS ms, regexp_extract_all(t, '{quoted}', 1) AS vs,
                 string_split_regex(t, '{quoted}') AS gs FROM d))"""


OP5_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS repo, regexp_extract(coalesce(source, ''), '^[^/]*', 0) AS owner
  FROM documents
),
s AS (SELECT doc_id, owner, repo, kind, CAST(stop - length(m) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, v FROM (
  {" UNION ALL ".join(_op5_kind(k) for k in range(len(secret_scan.KINDS)))}) WHERE length(v) >= least),
f AS (SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos,
  regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= 6
  AND NOT regexp_matches(v, '(?i)example|changeme|placeholder|your|dummy|xxxx|0000|12345') AS lively FROM s GROUP BY v),
j AS (SELECT s.*, owners >= 3 AND (NOT lively OR repos >= 10) AS copied,
  lively AND NOT (owners >= 3 AND (NOT lively OR repos >= 10)) AS live
  FROM s JOIN f USING (v)),
l AS (SELECT *, concat(['assign', 'access', 'hex', 'prefixed'][kind + 1], ':', start, ':', stop) AS line FROM j),
a AS (SELECT doc_id, start, kind, line FROM l UNION
  SELECT doc_id, stop - length(v), 4, concat('live:', stop - length(v), ':', stop) FROM j WHERE live),
c AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
  count(*) FILTER (WHERE kind = 2) AS n_hex, string_agg(line, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
  count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE copied) AS n_copied FROM l GROUP BY doc_id),
t AS (SELECT doc_id, string_agg(line, ',' ORDER BY start, kind, line) AS spans FROM a GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""

#: The contract's patterns, as they are, and what a match of each must also be. RE2 takes them in linear time.
OP13_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", "translate(m, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda p: CAST(right('000' || ltrim(p, '0'), greatest(3, length(ltrim(p, '0')))) AS HUGEINT))) <= 255", "m"),
    (
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        """length(v) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(v) + 1), lambda i:
    (1 + (i + 1) % 2) * CAST(v[-i] AS INTEGER) - CASE WHEN i % 2 = 0 AND v[-i] > '4' THEN 9 ELSE 0 END)) % 10 = 0""",
        "v",
    ),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(v) BETWEEN 9 AND 15", "v"),
)


def _op13_kind(number: int) -> str:
    """Spans of one kind with what stands before and after, each placed by a running sum of lengths."""
    _, pattern, valid, entity = OP13_KINDS[number]
    return f"""
  SELECT r, {number} AS kind, stop - length(m) AS start, stop, '{number}:' || {entity} AS entity, right(g, {pii.WINDOW}) AS bef,
    left(g2, {pii.WINDOW}) AS aft, length(g) > {pii.WINDOW} AS cut_bef, length(g2) > {pii.WINDOW} AS cut_aft
  FROM (SELECT r, m, g, g2, regexp_replace(m, '[^0-9]', '', 'g') AS v, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) AS stop
    FROM (SELECT r, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, unnest(gs[2:len(ms) + 1]) AS g2, generate_subscripts(ms, 1) AS i
      FROM (SELECT r, regexp_extract_all(t, '{pattern}', 0) AS ms, string_split_regex(t, '{pattern}') AS gs FROM d)))
  WHERE {valid}"""


OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT r, kind, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, entity, bef, aft, cut_bef, cut_aft FROM (
  {" UNION ALL ".join(_op13_kind(k) for k in range(len(OP13_KINDS)))})),
w AS (SELECT r, entity, bef || chr(0) || aft AS context, bef AS t, start - length(bef) AS pos, cut_bef AS cut_first, false AS cut_last FROM s
  UNION ALL SELECT r, entity, bef || chr(0) || aft, aft, stop, false, cut_aft FROM s),
p AS (SELECT r, entity, context, pos, cut_first, cut_last, length(t) AS size, translate(m, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, length(m) AS n,
    sum(length(g) + length(m)) OVER (PARTITION BY k ORDER BY i) AS stop
  FROM (SELECT *, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g, generate_subscripts(ms, 1) AS i
    FROM (SELECT *, row_number() OVER () AS k, regexp_extract_all(t, '{pii.TERM}', 0) AS ms, string_split_regex(t, '{pii.TERM}') AS gs FROM w))),
f AS (SELECT r, entity, context, term, CAST(pos + stop - n AS BIGINT) AS start, CAST(pos + stop AS BIGINT) AS stop FROM p
  WHERE (NOT cut_first OR stop > n) AND (NOT cut_last OR stop < size)),
o AS (SELECT entity, term, r, min(context) AS context FROM f GROUP BY ALL),
ct AS (SELECT entity, term, count(*) AS n_ct FROM o GROUP BY ALL HAVING count(DISTINCT context) >= 2),
c AS (SELECT entity, count(DISTINCT r) AS n_c FROM s GROUP BY entity),
tt AS (SELECT term, count(*) AS n_t FROM (SELECT DISTINCT r, translate(unnest(regexp_extract_all(t, '{pii.TERM}', 0)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d) GROUP BY term),
j AS (SELECT entity, term, 1 - log2(n_t / n_ct) / log2((SELECT count(*) FROM d) / n_c) AS share FROM ct JOIN c USING (entity) JOIN tt USING (term)
  WHERE n_c < (SELECT count(*) FROM d)),
l AS (SELECT f.r, f.start, max(f.stop) AS stop, CASE WHEN max(share) >= 0.9 THEN 5 ELSE 4 END AS kind FROM f JOIN j USING (entity, term)
  WHERE share >= 0.75 AND NOT EXISTS (SELECT 1 FROM s WHERE s.r = f.r AND s.start < f.stop AND s.stop > f.start) GROUP BY f.r, f.start),
a AS (SELECT r, start, kind, stop FROM s UNION ALL SELECT r, start, kind, stop FROM l),
x AS (SELECT r, string_agg(['email', 'ip', 'card', 'phone', 'general', 'remove'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans,
  string_agg(['email', 'ip', 'card', 'phone'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (WHERE kind < 4) AS base,
  {", ".join(f"count(*) FILTER (WHERE kind = {k}) AS n_{n}" for k, n in enumerate(("email", "ip", "card", "phone", "general", "removed")))} FROM a GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n in ("email", "ip", "card", "phone"))}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_general, 0) AS n_general, coalesce(n_removed, 0) AS n_removed
FROM d LEFT JOIN x USING (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_exact_dedup,
        op2_piece_codec,
        op3_top_k,
        op4_language_id,
        op5_secret_scan,
        op6_near_dup,
        op7_quality,
        op8_packing,
        op9_toxicity,
        op10_html_text,
        op11_token_alignment,
        op12_spelling_variants,
        op13_private_data,
        packed_conversations,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op3_top_k": OP3_SQL, "op5_secret_scan": OP5_SQL, "op13_private_data": OP13_SQL}
