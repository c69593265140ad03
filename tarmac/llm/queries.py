"""One registered query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontam, html, mixing, pii, prefix_trie, quality, rules, sentencepiece_bpe, ship, simhash, spelling, substring, suffix, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship.ensure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.line_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_later_copies(_table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentencepiece_bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_toxicity,
        op3_html,
        op4_quality,
        op5_pii,
        op6_substring,
        op7_rules,
        op8_decontam,
        op9_simhash,
        op10_suffix,
        op11_sentencepiece,
        op12_spelling,
        op13_prefix_trie,
    )
}

#: DuckDB statements of the queries that SQL can express.
STATEMENTS: dict[str, str] = {
    "op6_substring": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
win AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (
    SELECT doc_id, list(DISTINCT p) AS ps
    FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN twice USING (s))
    GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, k: ps IS NULL OR NOT list_contains(ps, k)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
""",
    "op10_suffix": r"""
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
),
win AS (
    SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS s
    FROM (SELECT doc_id, h, unnest(range(1, n - 48)) AS i FROM d WHERE n >= 50)
),
low AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (
    SELECT doc_id, i, coalesce(i > 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS opens
    FROM win JOIN low USING (s) WHERE doc_id > m
),
run AS (SELECT doc_id, i, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, r),
gap AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS start FROM span
),
piece AS (
    SELECT doc_id, a, substr(h, 2 * start - 1, 2 * (a - start)) AS kept FROM gap JOIN d USING (doc_id)
    UNION ALL
    SELECT d.doc_id, n + 1, substr(h, 2 * coalesce(max(b), 1) - 1) FROM d LEFT JOIN span ON span.doc_id = d.doc_id GROUP BY d.doc_id, h, n
),
kept AS (SELECT doc_id, string_agg(kept, '' ORDER BY a) AS h FROM piece GROUP BY doc_id),
removed AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
""",
    "op13_prefix_trie": r"""
WITH own AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r,
           coalesce(role, '') AS role, coalesce(text, '') AS txt
    FROM conversations WHERE conv_id IS NOT NULL
),
conv AS (
    SELECT c, c - c % 20 AS base, xor(4294967295, list_reduce(
               list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda a, x: list_reduce(list_concat([xor(a, x)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda b, i: xor(b >> 1, 3988292384 * (b & 1))))) % 4 AS h
    FROM (SELECT DISTINCT c FROM own)
),
turn AS (
    SELECT conv.c, row_number() OVER (PARTITION BY conv.c ORDER BY own.c <> base OR conv.c = base AND r > h, r) AS d, role, txt
    FROM conv JOIN own ON own.c = base AND r <= h OR own.c = conv.c AND r > h
),
path AS (
    SELECT c, d, sum(1) OVER (PARTITION BY c) AS n, len(regexp_extract_all(txt, '[^\x20\x09-\x0D]+')) AS w,
           string_agg(sha256(strlen(role) || ':' || role || txt), '') OVER (PARTITION BY c ORDER BY d) AS k
    FROM turn
    UNION ALL
    SELECT c, 0, (SELECT count(*) FROM turn WHERE turn.c = conv.c), 0, '' FROM conv
),
node AS (
    SELECT d, k, min(c) AS rep, count(*) AS n_convs, any_value(w) AS w, max(n) = d AS childless,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends
    FROM path GROUP BY d, k
),
place AS (SELECT path.c, path.d, rep FROM path JOIN node USING (d, k)),
below AS (
    SELECT p.rep, p.d, sum(CAST(childless AS BIGINT)) AS n_leaves, sum((n_convs - 1) * w) AS saved
    FROM node JOIN place p ON p.c = node.rep AND p.d <= node.d GROUP BY p.rep, p.d
),
child AS (
    SELECT p.rep, p.d, count(*) AS n FROM node JOIN place p ON p.c = node.rep AND p.d = node.d - 1 GROUP BY p.rep, p.d
)
SELECT node.rep AS conv_id, CAST(node.d AS BIGINT) AS depth, up.rep AS parent_conv_id, n_convs, coalesce(child.n, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM node JOIN below ON below.rep = node.rep AND below.d = node.d
LEFT JOIN child ON child.rep = node.rep AND child.d = node.d
LEFT JOIN place up ON up.c = node.rep AND up.d = node.d - 1
""",
}
