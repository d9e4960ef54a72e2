"""The queries opN_<name> of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import split_of, table
from .centroids import cluster_rows, cluster_vectors, clustering_sql
from .decontaminate import find_leaks
from .embedding_dedup import link_embeddings
from .html_text import extract_main_text
from .language_id import fit_dictionaries, identify_language
from .lm_score import score_texts
from .minhash_dedup import near_duplicate_classes
from .mixture import PRODUCTION, mix_sources, mixture_sql
from .periodic_runs import find_runs, repeat_tail, runs_digest
from .sharding import Shard, equal_shards, shard_rows, sharding_sql
from .suffix_dedup import remove_repeats
from .token_counts import count_tokens
from .toxicity import fit_toxicity, score_toxicity


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = fit_dictionaries(docs.where(split_of("doc_id", 4) != 2).select("text", "lang"))
    found = identify_language(docs, known)
    return found.select("doc_id", (split_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(table(spark, sf_dir, "documents"), split_of("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", limit=2048)


def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), PRODUCTION)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), width=5, threshold=0.8)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit_toxicity(docs, labels.where(split_of("doc_id", 5) != 0))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (split_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "max_gain")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=50)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = find_runs(docs.select("doc_id", repeat_tail(F.col("text"), h).alias("text")), carry=("doc_id",))
    return found.select("doc_id", *runs_digest())


def op12_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), equal_shards(40), added=Shard(40))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_rows(cluster_vectors(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dim=64, scale=1024, seed="3"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_lm_score": op2_lm_score,
    "op3_token_counts": op3_token_counts,
    "op4_mixture": op4_mixture,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_repeated_strings": op8_repeated_strings,
    "op9_main_text": op9_main_text,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_rendezvous_shards": op12_rendezvous_shards,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLES: dict[str, str] = {
    "op4_mixture": mixture_sql(PRODUCTION),
    "op12_rendezvous_shards": sharding_sql(40),
    "op13_centroid_clusters": clustering_sql(k=8, rounds=10, dim=64, scale=1024, seed="3"),
}
