"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm import common, html_text, licenses, merkle, mixing, neighbours, packing, personal, quality_model, quality_rules, sharding, simhash, url_filters, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(url_filters.captures_of(pages), url_filters.entries_of(pages))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), radius=2, width=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id")


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    found = quality_model.scores(docs, model)
    return found.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "positions")
    return mixing.in_training_order(found)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"), merkle.case_changed())


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.find(table(spark, sf_dir, "documents")))


def schedule_sql(demand: str) -> str:
    """mixing.position() of ``demand`` in SQL: each phase adds the part of its length that the demand fills."""
    cases = []
    for k, plan in enumerate(mixing.PHASES):
        whole, done, parts = sum(plan), 0.0, []
        for weight in plan:
            parts.append(f"least(greatest(({demand} - {done / whole!r}e0) / {weight / whole!r}e0, 0e0), 1e0) / {len(plan)}e0")
            done += weight
        cases.append(f"WHEN {k} THEN {' + '.join(parts)}")
    return f"CASE turn % {len(mixing.PHASES)} {' '.join(cases)} END"


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5('10-' || doc_id::VARCHAR || '-' || coalesce(md5(text), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM s),
x AS (SELECT *, CAST(CASE turn % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS weight FROM w),
y AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
  CAST(coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lb,
  CAST(coalesce(sum(weight) OVER (ORDER BY 3.0 * source_size / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS wb FROM x),
z AS (SELECT *, 3 * source_size * (weights - wb) <= (total - lb) * weight AS filled FROM y),
t AS (SELECT source, source_size, turn, CASE WHEN filled THEN CAST(3 * source_size AS DOUBLE) ELSE
  CAST(weight * (total - CAST(coalesce(sum(CASE WHEN filled THEN 3 * source_size END) OVER (), 0) AS BIGINT)) AS DOUBLE)
  / CAST(weights - CAST(coalesce(sum(CASE WHEN filled THEN weight END) OVER (), 0) AS BIGINT) AS DOUBLE) END AS target FROM z),
p AS (SELECT d.*, source_size, target, turn, CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, begun + CAST(size AS DOUBLE) / 2 AS m1, begun + source_size + CAST(size AS DOUBLE) / 2 AS m2, begun + 2 * source_size + CAST(size AS DOUBLE) / 2 AS m3 FROM p),
e AS (SELECT *, (CASE WHEN m1 <= target THEN 1 ELSE 0 END) + (CASE WHEN size > 0 AND m2 <= target THEN 1 ELSE 0 END) + (CASE WHEN size > 0 AND m3 <= target THEN 1 ELSE 0 END) AS copies FROM c),
g AS (SELECT source, max(target) - CAST(sum(size * copies) AS BIGINT) AS gap FROM e GROUP BY source),
f AS (SELECT e.*, gap, size > 0 AND 2 * size <= abs(gap) AND CASE WHEN gap > 0 THEN copies < 3 ELSE copies > 0 END AS fits FROM e JOIN g ON e.source IS NOT DISTINCT FROM g.source),
r AS (SELECT *, CAST(coalesce(sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS passed FROM f),
m AS (SELECT *, greatest(target, 1e-9) AS whole, fits AND passed + size <= abs(gap) AS moved FROM r),
q AS (SELECT *, copies + CASE WHEN moved THEN CASE WHEN gap > 0 THEN 1 ELSE -1 END ELSE 0 END AS final,
  list_sort(list_filter([CASE WHEN copies >= 1 THEN {schedule_sql("m1 / whole")} END, CASE WHEN copies >= 2 THEN {schedule_sql("m2 / whole")} END, CASE WHEN copies >= 3 THEN {schedule_sql("m3 / whole")} END,
    CASE WHEN moved AND gap > 0 THEN {schedule_sql("((target - gap + passed + CAST(size AS DOUBLE) / 2) / whole)")} END], lambda x: x IS NOT NULL)) AS places FROM m)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * final AS BIGINT) AS taken, CAST(final AS INTEGER) AS copies,
  CASE WHEN final >= 1 THEN places[1] END AS position_1, CASE WHEN final >= 2 THEN places[2] END AS position_2, CASE WHEN final >= 3 THEN places[3] END AS position_3 FROM q
"""


def levels_sql(name: str, group: str, depth: int) -> str:
    """CTEs over {name}0 ({group}, i, h): runs of 16 of each level, and in {name}{depth} what remains of each group."""
    out = []
    for k in range(depth):
        out.append(f"{name}r{k} AS (SELECT {group}, i // 16 AS i, list(h ORDER BY i) AS hs, sum(count(*)) OVER (PARTITION BY {group}) > 1 AS more FROM {name}{k} GROUP BY {group}, i // 16)")
        out.append(f"{name}{k + 1} AS (SELECT {group}, i, CASE WHEN more THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{k})")
    return ", ".join(out)


def proof_sql(name: str, group: str, depth: int) -> str:
    """CTEs that carry rows of {name}p0 ({group}, i, f, proof, ...) up the same levels: siblings are added to proof, f is folded."""
    out = []
    for k in range(depth):
        before, after = "hs[1:p.i % 16]", "hs[p.i % 16 + 2:]"
        grown = f"p.proof || CASE WHEN more THEN array_to_string({before}, '') || array_to_string({after}, '') ELSE '' END"
        fold = f"CASE WHEN more THEN sha256(array_to_string({before}, '') || p.f || array_to_string({after}, '')) ELSE p.f END"
        out.append(f"{name}p{k + 1} AS (SELECT p.* REPLACE (p.i // 16 AS i, {fold} AS f, {grown} AS proof) FROM {name}p{k} p JOIN {name}r{k} r ON p.{group} IS NOT DISTINCT FROM r.{group} AND p.i // 16 = r.i)")
    return ", ".join(out)


def encoded_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


#: CRC32 of a decimal number: a byte is taken in by eight steps of a bit each.
CRC32_SQL = """xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], [ord(c)::UBIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [x::UBIGINT FOR x IN range(8)]), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))))"""
#: Trees of up to 16^6 leaves a group and as many groups.
OP11_SQL = f"""
WITH d AS (SELECT doc_id, source, {" || ".join(map(encoded_sql, ("doc_id", "source", "lang", "n_chars")))} AS head, text, {CRC32_SQL} % 5 = 0 AS hit FROM documents),
e AS (SELECT doc_id, source, sha256(head || {encoded_sql("text")}) AS leaf, CASE WHEN hit THEN sha256(head || {encoded_sql(f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')")}) END AS altered FROM d),
a0 AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM e),
{levels_sql("a", "source", 6)},
ap0 AS (SELECT doc_id, source, leaf, i, coalesce(altered, leaf) AS f, '' AS proof FROM a0), {proof_sql("a", "source", 6)},
b0 AS (SELECT 0 AS whole, source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM a6), {levels_sql("b", "whole", 6)},
bp0 AS (SELECT p.doc_id, p.leaf, b0.h AS subroot, 0 AS whole, b0.i, p.f, p.proof FROM ap6 p JOIN b0 ON p.source IS NOT DISTINCT FROM b0.source), {proof_sql("b", "whole", 6)}
SELECT doc_id, leaf, subroot, (SELECT h FROM b6) AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = (SELECT h FROM b6) AS verified FROM bp6
"""


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": url_filters.ORACLE, "op4_license_scans": licenses.oracle(), "op10_mixing": OP10_SQL, "op11_merkle_manifest": OP11_SQL}
