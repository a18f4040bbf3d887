"""The thin queries over whole tables, one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from chargeplan.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.ngram_join import ngram_jaccard_join

    return ngram_jaccard_join(table(spark, sf_dir, "documents"), k=4, percent=85)


def op2_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.sharding import kd_tree_shards

    placed = kd_tree_shards(table(spark, sf_dir, "documents"), ["n_chars", "source", "lang"], shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from chargeplan.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=1)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.language import identify_language

    return identify_language(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.suffix_dedup import suffix_array_dedup

    return suffix_array_dedup(table(spark, sf_dir, "documents"), span=400, also=256)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.common import shared_path
    from chargeplan.llm.warc import round_trip

    return round_trip(spark, table(spark, sf_dir, "pages"), shared_path(spark, "warc"))


def op3_stable_projection_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chargeplan.llm.ann import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_kd_tree_sharding": op2_kd_tree_sharding,
    "op4_shortest_pack_first": op4_shortest_pack_first,
    "op5_language_id": op5_language_id,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_warc": op10_warc,
    "pipeline": pipeline,
    "op3_stable_projection_ann": op3_stable_projection_ann,
}

ORACLE_SQL: dict[str, str] = {}
