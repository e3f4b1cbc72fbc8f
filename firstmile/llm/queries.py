"""One query an operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstmile.llm import ann, bpe, columns, decontam, fim, html, langid, lm, pii, quality, shard, simhash, tokenfile, trie


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """A public tokenizer's definition. Its place is a parameter, by default that of the installed files."""
    if folder is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    else:
        path = os.path.join(folder, name)
    with open(path, encoding="utf-8") as f:
        return f.read()


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.train_and_score(columns.table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.train_and_predict(columns.table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.link(columns.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.assess(columns.table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *(F.col(f"_quality.{c}").alias(c) for c in counts))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(columns.table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(columns.table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(columns.table(spark, sf_dir, "documents"), columns.table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(columns.table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(columns.table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(columns.table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(columns.table(spark, sf_dir, "conversations"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(columns.table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(columns.table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_lm_scoring,
        op2_language_id,
        op3_simhash,
        op4_quality_rules,
        op5_token_output,
        op6_pii,
        op7_decontamination,
        op8_bpe,
        op9_html,
        op10_sharding,
        op11_prefix_trie,
        op12_nearest,
        op13_fill_in_middle,
    )
    return {f.__name__: f for f in every}


def _op4_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    white = r"[\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(string_split_regex(text, '{white}'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{white}', '', 'g') <> '') AS ls FROM d),
p AS (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
t AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM p),
c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM t) WHERE n > 1),
m AS (SELECT r, count(DISTINCT i + k) AS n FROM c, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
x AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '{white}', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(m.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(ws, lambda x: rtrim(lower(x), '.,;:!?') IN ({stop})))::BIGINT AS n_stop
      FROM w LEFT JOIN m USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 14 AND n_symbols / greatest(n_words, 1) <= 0.25
       AND n_stop / greatest(n_words, 1) >= 0.06 AND n_dup_lines / greatest(n_lines, 1) <= 0.4 AS kept
FROM b"""


def _crc32_sql(text: str) -> str:
    """crc32 of ASCII text, bit by bit: a byte is taken in by exclusive or, -1 stands for one shift."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, x: {step}), 4294967295::BIGINT)"


def _op11_sql() -> str:
    return rf"""
WITH s AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, turn, sha256(strlen(role)::VARCHAR || ':' || role || text) AS t,
             len(regexp_extract_all(text, '[^ 	-]+')) AS w FROM s),
o AS (SELECT c, t, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, t) AS p FROM h),
f AS (SELECT c, c - c % {trie.FAMILY} AS b, {_crc32_sql('c::VARCHAR')} % {trie.HEADS} AS h FROM (SELECT DISTINCT c FROM s)),
r AS (SELECT f.c, 0 AS g, o.p, o.t, o.w FROM f JOIN o ON o.c = f.b AND o.p <= f.h
      UNION ALL SELECT f.c, 1, o.p, o.t, o.w FROM f JOIN o ON o.c = f.c AND o.p > f.h),
d AS (SELECT c, t, w, row_number() OVER (PARTITION BY c ORDER BY g, p) AS depth FROM r),
m AS (SELECT c, depth, w, sha256(string_agg(t, ',') OVER (PARTITION BY c ORDER BY depth)) AS node,
             coalesce(sha256(string_agg(t, ',') OVER (PARTITION BY c ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), '') AS up FROM d
      UNION ALL SELECT c, 0, 0, '', NULL FROM f),
e AS (SELECT c, max(depth) AS depth FROM m GROUP BY c),
n AS (SELECT depth, node, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, min(w) AS w FROM m GROUP BY depth, node),
k AS (SELECT up AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
q AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (node, depth)),
u AS (SELECT m.depth, m.node, sum((q.n_convs - 1) * q.w)::BIGINT AS saved_tokens, count(*) FILTER (q.n_children = 0) AS n_leaves
      FROM q JOIN m ON m.c = q.conv_id AND m.depth <= q.depth GROUP BY ALL),
z AS (SELECT m.depth, m.node, sha256(string_agg(m.c::VARCHAR, ',' ORDER BY m.c)) AS ends FROM m JOIN e USING (c, depth) GROUP BY ALL)
SELECT q.conv_id, q.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, q.n_convs, q.n_children, u.n_leaves, u.saved_tokens,
       coalesce(z.ends, sha256('')) AS ends_sha256
FROM q JOIN u USING (depth, node) LEFT JOIN z USING (depth, node) LEFT JOIN n p ON p.node = q.up AND p.depth = q.depth - 1"""


def _op13_sql() -> str:
    draw = lambda i: f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT"  # noqa: E731
    p, s, m = fim.PREFIX, fim.SUFFIX, fim.MIDDLE
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
l AS (SELECT *, regexp_extract_all(text, '[^
]*
|[^
]+') AS lines FROM d),
c AS (SELECT *, len(lines) AS n, {draw(0)} % (len(lines) + 1) AS i, {draw(1)} % (len(lines) + 1) AS j,
             CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}') OR {draw(2)} % 100 >= {fim.RATE} THEN 'plain'
                  WHEN {draw(3)} % 100 < {fim.SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM l),
x AS (SELECT *, array_to_string(lines[1:least(i, j)], '') AS a, array_to_string(lines[least(i, j) + 1:greatest(i, j)], '') AS b,
             array_to_string(lines[greatest(i, j) + 1:n], '') AS e FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(a)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '{p}' || a || '{s}' || e || '{m}' || b WHEN 'spm' THEN '{s}' || e || '{p}' || a || '{m}' || b ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM x"""


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": _op4_sql(), "op11_prefix_trie": _op11_sql(), "op13_fill_in_middle": _op13_sql()}
