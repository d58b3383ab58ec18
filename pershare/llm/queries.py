"""The numbered queries: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language
from .collision_search import nearest
from .decontaminate import contaminations
from .divergence import audit
from .jaccard_join import near_components
from .line_dedup import dedup_lines
from .lm_score import score_documents
from .minhash import near_copies
from .mixing import mixed_sample, topic
from .quality import quality
from .resampling import resample
from .suffix_dedup import drop_repeats
from .wrappers import extract


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int):
    """Fold of a row by the checksum of its key as text; a null key is in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % n, F.lit(0))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 5) != 1).alias("train"))
    return score_documents(docs).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("topic", topic())
    kept = mixed_sample(docs, ["source", "lang", "topic"])
    return kept.select("doc_id", "topic", "n_tokens", F.round("keep_probability", 6).alias("keep_probability"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(fold("doc_id", 4) != 2))
    asked = docs.select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    return language.predict(asked, model).select("doc_id", "held_out", "lang_pred", "score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "edits", "first", "last")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"), 10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(table(spark, sf_dir, "documents"), links=False)
    return found.select("doc_id", "n_shingles", "component_id")



def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, least_words=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), least_docs=30, top=50)


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"), percent=85)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality": op2_quality,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_html_extraction": op4_html_extraction,
    "op5_mixing": op5_mixing,
    "op6_language_id": op6_language_id,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_source_divergence": op12_source_divergence,
    "op13_minhash_dedup": op13_minhash_dedup,
}
