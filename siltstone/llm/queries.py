"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import (
    chat,
    curriculum,
    divergence,
    interpolation,
    lshforest,
    outliers,
    pieces,
    pii,
    pulearn,
    resync,
    simple8b,
    vamana,
    whitening,
)
from siltstone.llm.common import read


def op1_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.nearest(read(spark, sf_dir, "embeddings"), every=100, k=10)


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(read(spark, sf_dir, "documents"))


def op3_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.classify(read(spark, sf_dir, "documents"), 0.8).select("doc_id", "class_id", "n_links")


def op5_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulearn.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_distinct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(read(spark, sf_dir, "documents"))


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"))


def op9_resynchronised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resync.count(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op10_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.deal(read(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.windows(rows.union(planted), public_tokenizers.path("piece_bpe_32k.model")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pruned_graph_search": op1_pruned_graph_search,
    "op2_robust_outliers": op2_robust_outliers,
    "op3_simple8b": op3_simple8b,
    "op4_lsh_forest": op4_lsh_forest,
    "op5_positive_unlabelled": op5_positive_unlabelled,
    "op6_distinct_chunks": op6_distinct_chunks,
    "op7_deleted_interpolation": op7_deleted_interpolation,
    "op8_weak_supervision": op8_weak_supervision,
    "op9_resynchronised_counts": op9_resynchronised_counts,
    "op10_curriculum_mix": op10_curriculum_mix,
    "op11_source_divergence": op11_source_divergence,
    "op12_chat_windows": op12_chat_windows,
    "op13_whitening": op13_whitening,
}
