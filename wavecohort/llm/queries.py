"""One digest query per operator, with its production parameters.

``QUERIES``: name -> callable (spark, sf_dir) -> DataFrame. ``ORACLE``: DuckDB
SQL of those that SQL can express.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    attention_lm,
    centroids,
    html_text,
    importance,
    licenses,
    packing,
    quality_rules,
    sentencepiece_bpe,
    sharding,
    simhash,
    target_resampling,
    token_store,
    topk,
)
from .common import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where the public vocabulary files lie; part of the environment."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark, sf_dir):
    """Per document: pieces, a hash of their ids, and whether decoding them
    gives the text again (with marks as spaces)."""
    done = sentencepiece_bpe.round_trips(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    plain = F.translate(F.coalesce(F.col("text"), F.lit("")), sentencepiece_bpe.MARK, " ")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        (F.col("decoded") == plain).alias("round_trip"),
    )


def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op3_html_text(spark, sf_dir):
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op4_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_jump_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_importance_resampling(spark, sf_dir):
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "weight", "kept")


def op8_token_store(spark, sf_dir):
    folder = f"{shared_folder(spark)}/token-store-{uuid.uuid4().hex}"
    settings = token_store.StoreSettings(tokenizer=vocabulary("byte_bpe_50k.json"))
    token_store.write_store(table(spark, sf_dir, "documents"), folder, settings)
    stored = token_store.read_store(spark, folder)
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_quality_rules(spark, sf_dir):
    return quality_rules.document_verdicts(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark, sf_dir):
    settings = packing.PackSettings(tokenizer=vocabulary("byte_bpe_50k.json"))
    return packing.pack_documents(table(spark, sf_dir, "documents"), settings)


def op11_attention_lm(spark, sf_dir):
    settings = attention_lm.LmSettings(tokenizer=vocabulary("byte_bpe_50k.json"))
    return attention_lm.score_documents(table(spark, sf_dir, "documents"), settings)


def op12_target_resampling(spark, sf_dir):
    found = target_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return target_resampling.digest(found)


def op13_centroid_clustering(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_simhash": op2_simhash,
    "op3_html_text": op3_html_text,
    "op4_license_scan": op4_license_scan,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_jump_sharding": op6_jump_sharding,
    "op7_importance_resampling": op7_importance_resampling,
    "op8_token_store": op8_token_store,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_attention_lm": op11_attention_lm,
    "op12_target_resampling": op12_target_resampling,
    "op13_centroid_clustering": op13_centroid_clustering,
}

ORACLE = {
    "op4_license_scan": licenses.sql(),
    "op5_exact_top_k": topk.SQL,
    "op6_jump_sharding": sharding.SQL,
    "op9_quality_rules": quality_rules.SQL,
    "op12_target_resampling": target_resampling.SQL,
    "op13_centroid_clustering": centroids.sql(),
}
