"""Registered queries of the subpackage and their check SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import NULL_ID
from millrace.llm.decontaminate import benchmark_leaks
from millrace.llm.embedding_dedup import embedding_classes
from millrace.llm.jaccard_join import jaccard_classes
from millrace.llm.lattice_lm import lattice_scores
from millrace.llm.merkle import folded, merkle_manifest, sibling_text
from millrace.llm.oracles import ORACLES  # noqa: F401
from millrace.llm.packing import length_batches
from millrace.llm.pii import KINDS, pseudonymised
from millrace.llm.prefix_trie import conversation_trie
from millrace.llm.quality import quality_scores
from millrace.llm.quotes import linked_messages, reply_threads
from millrace.llm.substring_dedup import substring_deduped
from millrace.llm.suffix_dedup import repeats_removed
from millrace.llm.token_counts import token_counts

VOCABULARY = os.environ.get("MILLRACE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
PIECES = os.environ.get("MILLRACE_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
PII_KEY = os.environ.get("MILLRACE_PII_KEY", "millrace-demonstration-key")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_deduped(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_chunks", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(_table(spark, sf_dir, "documents"), words=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats_removed(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def _links(linked: DataFrame) -> DataFrame:
    """The originals as ``level:turn`` texts."""
    one = lambda o: F.concat(o["level"].cast("string"), F.lit(":"), F.coalesce(o["turn"].cast("string"), F.lit("-")))
    return linked.withColumn("originals", F.array_join(F.transform("originals", one), ","))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(linked_messages(_table(spark, sf_dir, "conversations")))


def _quoting(messages: DataFrame) -> DataFrame:
    """The table of conversations, each turn led by quotes of up to two earlier ones, at the levels two and one."""
    turn, near, far = F.col("turn"), F.col("turn") - 1 - F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3)), F.col("turn") - 2 - F.pmod(F.col("conv_id"), F.lit(3))
    said = messages.groupBy("conv_id", "turn").agg(F.max("text").alias("said"))
    quoted = lambda mark, c: F.coalesce(F.concat(F.lit(mark), F.replace(F.col(c), F.lit("\n"), F.lit("\n" + mark)), F.lit("\n")), F.lit(""))
    rows = messages.select("conv_id", turn, "role", "text", near.alias("near"), far.alias("far"))
    for c in ("near", "far"):
        rows = rows.join(said.select("conv_id", F.col("turn").alias(c), F.col("said").alias(f"{c}_text")), ["conv_id", c], "left")
    return rows.select("conv_id", "turn", "role", F.concat(quoted(">> ", "far_text"), quoted("> ", "near_text"), "text").alias("text"))


def quoted_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(linked_messages(_quoting(_table(spark, sf_dir, "conversations"))))


def quoted_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads of the same messages, in parts of three."""
    out = reply_threads(linked_messages(_quoting(_table(spark, sf_dir, "conversations"))), part_size=3)
    turns = F.array_join(F.transform("messages", lambda m: m["turn"].cast("string")), ",")
    return out.select("conv_id", "thread", "part", "n_messages", turns.alias("turns"), "formatted")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_classes(_table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "lcs_share", "answer_found")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_batches(_table(spark, sf_dir, "documents")).drop("_id", "_key")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), VOCABULARY)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymised(_table(spark, sf_dir, "documents"), PII_KEY)
    count = lambda kind: F.size(F.filter("pii_values", lambda v: v["kind"] == kind)).alias(f"n_{kind}")
    return out.select("doc_id", "text", *[count(k) for k in KINDS])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    # One more character, in a type that the largest long does not overflow.
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, more).otherwise(F.col("n_chars").cast("string"))
    claims = [tampered if c == "n_chars" else F.col(c) for c in fields]
    out = merkle_manifest(_table(spark, sf_dir, "documents"), fields, "lang", "doc_id", claims=claims)
    out = out.withColumn("folded_root", folded(F.col("claim"), F.col("proof")))
    proof = F.sha2(sibling_text(F.col("proof")), 256).alias("proof_sha256")
    return out.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    out = lattice_scores(_table(spark, sf_dir, "documents"), PIECES, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The null id is the smallest long inside; it is a conversation of its own, with no head.
    given = F.when(F.col("conv") != NULL_ID, F.col("conv"))
    h = F.coalesce(F.crc32(given.cast("string")) % 6, F.lit(0))
    return conversation_trie(_table(spark, sf_dir, "conversations"), given - given % 100, h, 5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_jaccard_join, op3_suffix_dedup, op4_quality_classifier, op5_chat_formatting,
        op6_embedding_dedup, op7_decontamination, op8_packing, op9_token_counts, op10_pii, op11_merkle_manifest, op12_lattice_scores,
        op13_prefix_trie, quoted_links, quoted_threads,
    )
}
