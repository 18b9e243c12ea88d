"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casona.llm import codes, decontamination, langid, licenses, merkle, mixing, pii, preferences, repeats, revisits, sharding, simhash, vafile
from casona.llm.shared import table


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), max_bits=4, shingle=4)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    return langid.predict(docs.withColumn("held_out", langid.held_out()), model, keep=["doc_id", "held_out"])


def op3_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allotments(table(spark, sf_dir, "documents"))


def op4_bounded_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"), shards=8)


def op5_line_hash_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents")).drop("row")


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolved(revisits.captures(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", revisits.header_text(F.col("headers")))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.digest(decontamination.contamination(docs, benchmark, n=10))


def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preferences.swapped_pairs(table(spark, sf_dir, "conversations"))
    return pairs.withColumns({c: preferences.mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_spans(table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op12_dictionary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(table(spark, sf_dir, "embeddings"))


def op13_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_near_duplicates": op1_simhash_near_duplicates,
        "op2_language_id": op2_language_id,
        "op3_weighted_fair_mix": op3_weighted_fair_mix,
        "op4_bounded_ring_shards": op4_bounded_ring_shards,
        "op5_line_hash_repeats": op5_line_hash_repeats,
        "op6_warc_revisits": op6_warc_revisits,
        "op7_benchmark_decontamination": op7_benchmark_decontamination,
        "op8_preference_pairs": op8_preference_pairs,
        "op9_license_scan": op9_license_scan,
        "op10_exact_top_k": op10_exact_top_k,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_dictionary_codes": op12_dictionary_codes,
        "op13_skip_chain_pii": op13_skip_chain_pii,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_weighted_fair_mix": mixing.MIX_SQL,
        "op5_line_hash_repeats": repeats.REPEATS_SQL,
        "op6_warc_revisits": revisits.REVISITS_SQL,
        "op7_benchmark_decontamination": decontamination.DECONTAMINATION_SQL,
        "op8_preference_pairs": preferences.PREFERENCES_SQL,
        "op10_exact_top_k": vafile.TOP_K_SQL,
        "op11_merkle_manifest": merkle.MERKLE_SQL,
        "op12_dictionary_codes": codes.CODES_SQL,
    }
