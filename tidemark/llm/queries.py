"""The queries of this subpackage, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    conversations,
    exact_dedup,
    licenses,
    packing,
    quality,
    repair,
    sharding,
    simhash,
    sketches,
    substrings,
    toxicity,
    whitening,
)
from tidemark.llm.common import prepare, scratch

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(prepare(spark), sf_dir))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(prepare(spark), "repair-tokens")
    repair.write_tokens(documents(spark, sf_dir), folder, WORD_BPE)
    return repair.read_tokens(spark.read.parquet(folder))


def op3_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(documents(prepare(spark), sf_dir), WORD_BPE)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(documents(prepare(spark), sf_dir), BYTE_BPE)


def op5_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(prepare(spark), sf_dir)).drop("votes")


def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(documents(prepare(spark), sf_dir))


def op7_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(documents(prepare(spark), sf_dir))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(prepare(spark), sf_dir), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digests(documents(prepare(spark), sf_dir))


def op10_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity_scores(documents(spark, sf_dir), labels)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(documents(prepare(spark), sf_dir)).drop("text_key")


def op12_suffix_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair(table, damage=True)


def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    found = whitening.whiten(vectors)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def _license_sql() -> str:
    """Every block against every template, without any filter."""

    def words(list_of: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in list_of) + "]"

    templates = []
    for label, text in licenses.TEMPLATES.values():
        spelled = licenses.plain_words(text)
        own = sorted(set(spelled))
        templates.append(
            f"('{label}', {words(own)}, {licenses.block_words(len(spelled))}, {licenses.least_shared(len(own))})"
        )
    phrases = []
    for phrase, label in licenses.PHRASES.items():
        spelled = phrase.split(" ")
        same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(spelled, 1))
        phrases.append(f"SELECT r, i, '{label}' AS label FROM positions WHERE {same}")
    return f"""
        WITH texts AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        positions AS (SELECT r, w, unnest(range(len(w))) AS i FROM texts),
        base AS ({" UNION ALL ".join(phrases)}),
        templates(label, own, length, least) AS (VALUES {", ".join(templates)}),
        places AS (
            SELECT r, label, own, least,
                   w[s + 1 : s + length] AS block
            FROM (SELECT r, w, label, own, least, length,
                         unnest(range(0, greatest(0, len(w) - length // 2 - 1) + 1, length // 2)) AS s
                  FROM texts, templates)
        ),
        met AS (
            SELECT r, label, len(list_intersect(own, block)) / len(own) AS containment
            FROM places WHERE len(list_intersect(own, block)) >= least
        ),
        b AS (SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word,
                     string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
        m AS (SELECT r, max(containment) AS best FROM met GROUP BY r),
        l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
              FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM met) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
               coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
               CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score
        FROM texts LEFT JOIN b USING (r) LEFT JOIN m USING (r) LEFT JOIN l USING (r)
    """


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_repair_tokens": op2_repair_tokens,
    "op3_best_two_fit": op3_best_two_fit,
    "op4_tree_bpe": op4_tree_bpe,
    "op5_weak_labels": op5_weak_labels,
    "op6_scaled_sketch": op6_scaled_sketch,
    "op7_pivot_simhash": op7_pivot_simhash,
    "op8_virtual_slots": op8_virtual_slots,
    "op9_suffix_trees": op9_suffix_trees,
    "op10_string_kernel": op10_string_kernel,
    "op11_license_scan": op11_license_scan,
    "op12_suffix_dawg": op12_suffix_dawg,
    "op13_lanczos_whitening": op13_lanczos_whitening,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        WITH rows AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM rows
    """,
    "op11_license_scan": _license_sql(),
}
