"""The registered corpus queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import (
    covertree,
    decontamination,
    licenses,
    linededup,
    merkle,
    packing,
    periodicruns,
    quality,
    secrets,
    simhash,
    suffixdedup,
    tokencounts,
    warc,
)
from tickhouse.llm.common import prepare, saved, shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


@query("op9_quality_rules", sql=r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (
  SELECT *, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
l AS (
  SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
ll AS (SELECT r, sum(n) AS n_lines, sum(n) - count(*) AS n_dup_lines FROM l GROUP BY r),
g AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM m WHERE len(w) >= 8)),
gg AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
c AS (SELECT r, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM gg WHERE n > 1) GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
       coalesce(n_repeat_words, 0) AS n_repeat_words,
       (n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words
            OR 10 * n_symbols > n_words) AS kept,
       ((n_words < 20)::BIGINT + 2 * (100 * coalesce(n_repeat_words, 0) > 30 * n_words)::BIGINT
        + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (2 * coalesce(n_dup_lines, 0) > coalesce(n_lines, 0))::BIGINT
        + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT) AS fail_bits
FROM m LEFT JOIN ll USING (r) LEFT JOIN c USING (r)
""")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.write_ledger(table(spark, sf_dir, "documents"), shared_folder(spark, "quality"))
    return quality.apply_policy(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.rejects(quality.BASE).alias("base_failed"), "kept", "fail_bits",
    )


@query("op7_warc_revisits", sql=r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < original THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < original THEN original END AS refers_to
FROM g
""")
def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archive(pages, folder)
    kind = pages.schema["page_id"].dataType
    rows = warc.resolve_references(saved(warc.read_archive(spark, folder)))
    return rows.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query("op5_mixture_packing")
def op5_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


@query("op10_benchmark_decontamination", sql=r"""
WITH i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM (SELECT *, least(len(w), 13) AS k FROM i WHERE len(w) > 0))),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (
  SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
h AS (SELECT r, dw.k, p, item FROM dw JOIN iw USING (k, g)),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS j FROM h)
      GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
""")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = decontamination.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.report(scanned).drop("spans")


@query("op6_simhash_pivots")
def op6_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_credential_linking", sql=secrets.oracle())
def op2_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.token_counts(table(spark, sf_dir, "documents"))


@query("op3_license_windows", sql=licenses.oracle())
def op3_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op8_fuzzy_lines")
def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return deduped.select(
        "row.doc_id", F.size(F.split(F.coalesce("row.text", F.lit("")), "\n", -1)).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixdedup.digest(suffixdedup.remove_repeats(documents))


@query("op11_cover_tree", sql="""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (
  SELECT r, vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND list_dot_product(e, e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= 0.98),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, p.b FROM reach JOIN p ON p.a = reach.b),
c AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
n AS (SELECT a AS r, count(*) AS n_links FROM p GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN c USING (r) LEFT JOIN n USING (r)
""")
def op11_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = periodicruns.planted(table(spark, sf_dir, "documents"))
    return periodicruns.digest(periodicruns.periodic_runs(changed))


@query("op13_merkle_manifest", sql=r"""
WITH RECURSIVE
crc_step AS (
  SELECT range AS i, 0 AS k, range::BIGINT AS c FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_step WHERE k = 8),
base AS (
  SELECT doc_id, coalesce('=' || lang, '') AS key,
         coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS size,
         coalesce(octet_length(encode((n_chars + 1)::VARCHAR)) || ':' || (n_chars + 1), '-') AS false_size,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
         xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(range(1, length(doc_id::VARCHAR) + 1),
                                                    lambda k: ascii((doc_id::VARCHAR)[k])::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS code
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, key, sha256(head || size || body) AS leaf,
         CASE WHEN code % 7 = 0 THEN sha256(head || false_size || body) ELSE sha256(head || size || body) END AS claimed
  FROM base),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos,
         count(*) OVER (PARTITION BY key) AS n FROM leaves),
low AS (
  SELECT key, 0 AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT DISTINCT key, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos) OVER (
           PARTITION BY key, pos // 2 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM low WHERE n > 1),
subroots AS (SELECT key, digest AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n
             FROM low WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT DISTINCT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos) OVER (
           PARTITION BY pos // 2 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  FROM top WHERE n > 1),
steps AS (
  SELECT p.key, p.pos, c.level, c.pos & 1 AS side, s.digest AS sibling
  FROM placed p JOIN low c ON c.key = p.key AND c.pos = p.pos >> c.level AND c.n > 1
  LEFT JOIN low s ON s.key = c.key AND s.level = c.level AND s.pos = xor(c.pos, 1)
  UNION ALL
  SELECT p.key, p.pos, 100 + c.level, c.pos & 1, s.digest
  FROM placed p JOIN subroots r ON r.key = p.key JOIN top c ON c.pos = r.pos >> c.level AND c.n > 1
  LEFT JOIN top s ON s.level = c.level AND s.pos = xor(c.pos, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key, pos ORDER BY level) AS k FROM steps),
proofs AS (SELECT key, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256
           FROM numbered GROUP BY key, pos),
folding AS (
  SELECT key, pos, 0::BIGINT AS k, claimed AS digest FROM placed
  UNION ALL
  SELECT f.key, f.pos, f.k + 1, sha256(CASE WHEN s.side = 1 THEN coalesce(s.sibling, '') || f.digest
                                           ELSE f.digest || coalesce(s.sibling, '') END)
  FROM folding f JOIN numbered s ON s.key = f.key AND s.pos = f.pos AND s.k = f.k + 1),
ends AS (SELECT key, pos, arg_max(digest, k) AS folded_root FROM folding GROUP BY key, pos)
SELECT doc_id, leaf, subroot, (SELECT digest FROM top WHERE n = 1) AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = (SELECT digest FROM top WHERE n = 1) AS verified
FROM placed JOIN subroots USING (key) JOIN ends ON ends.key = placed.key AND ends.pos = placed.pos
LEFT JOIN proofs ON proofs.key = placed.key AND proofs.pos = placed.pos
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    fields = [F.col(name) for name in merkle.FIELDS]
    false_size = [F.col(n).cast("decimal(38,0)") + 1 if n == "n_chars" else F.col(n) for n in merkle.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = merkle.manifest(
        documents, merkle.leaf_digest(*fields), claimed=F.when(tampered, merkle.leaf_digest(*false_size)))
    found = merkle.folded(F.coalesce("claimed", "leaf"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", merkle.siblings_of(F.col("path"))), 256).alias("proof_sha256"),
        found.alias("folded_root"), (found == F.col("root")).alias("verified"))
