"""The registered queries of this subpackage: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), vocabulary(), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.suffix_dedup import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


RULES_ALLOW, RULES_BLOCK = ("org/", "com/fr/"), ("example.org/es/", "example.org/en/1", "com/de/")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm import url_filter

    weights = url_filter.fit(spark, url_filter.labelled_urls())
    return url_filter.judge(table(spark, sf_dir, "pages"), weights, RULES_ALLOW, RULES_BLOCK).drop("log_odds")


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.sharding import assign

    return assign(table(spark, sf_dir, "documents"), shards=24)


def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.decontamination import contaminated, scan

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), window=13)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), contaminated().alias("contaminated")
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.token_files import round_trip

    return round_trip(table(spark, sf_dir, "documents"), vocabulary(), length=2048, end_id=2)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", langid.held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


SITES = 10


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.line_dedup import remove_boilerplate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return remove_boilerplate(docs, sites=SITES).select("doc_id", "text", "n_lines", "n_removed")


def op10_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.llm.ann import nearest

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 50 == 0, k=5)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from contrail.llm import decontamination, line_dedup, url_filter

    weights = url_filter.plain_weights(url_filter.labelled_urls())
    return {"op2_url_filter": url_filter.oracle(weights, RULES_ALLOW, RULES_BLOCK), "op6_decontamination": decontamination.ORACLE, "op9_line_dedup": line_dedup.oracle(SITES)}
