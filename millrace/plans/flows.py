"""The jobs users run end to end."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.operators import scoring as S
from millrace.operators.chunk import chunk_text
from millrace.operators.dedup import dedup_rows
from millrace.operators.index import limit_rows
from millrace.operators.split import train_test_split
from millrace.operators.tokens import VOCAB_SIZE, build_vocab, collate, encode
from millrace.session import stage
from millrace.sources.delimited import scan_csv
from millrace.sources.sinks import write_table


@dataclass(frozen=True)
class ExampleSettings:
    """How documents become training examples.

    Fixed values: the defaults of the fields are those users' configs rely on when they leave a
    field out. ``block_chars`` counts characters.
    """

    batch_size: int = 8
    test_size: float = 0.01
    block_chars: int = 1024
    seed: int = 41
    padding: str = "right"
    debug: bool = False
    vocab_size: int = VOCAB_SIZE


DEBUG_DOCUMENTS = 5


def csv_to_table(spark: SparkSession, path: str, out: str, **read_options) -> DataFrame:
    """Messy CSV to a table without repeated rows."""
    return write_table(dedup_rows(scan_csv(spark, path, **read_options)), out)


def documents_to_examples(
    docs: DataFrame, key: str, settings: ExampleSettings = ExampleSettings()
) -> tuple[DataFrame, DataFrame]:
    """Padded, labelled train and test batches of ``docs`` (``key`` and ``text``).

    Limit, then chunk, count the vocabulary, encode with an end marker, split and batch. The
    limit counts documents, so it stays before the chunking.
    """
    limited = limit_rows(docs.select(key, "text"), [key], DEBUG_DOCUMENTS if settings.debug else None)
    chunks = chunk_text(limited, "text", settings.block_chars, settings.block_chars)
    vocab = build_vocab(chunks, settings.vocab_size, "chunk")
    rows = [key, "chunk_no"]
    examples = stage(encode(chunks, vocab, rows, "chunk", eos=True), "examples")
    train, test = train_test_split(examples, rows, settings.test_size, settings.seed)
    return tuple(collate(side, rows, settings.batch_size, settings.padding) for side in (train, test))


def encode_requests(
    df: DataFrame, vocab: DataFrame, key: Sequence[str], text: str = "text", num_reqs: int = 1, length: int = A.REQUEST_LENGTH
) -> DataFrame:
    """Fixed-length ids and mask of each request, repeated ``num_reqs`` times after encoding once."""
    ids, mask = A.pad_truncate(F.col("ids"), length)
    encoded = encode(df, vocab, key, text, max_tokens=length).select(*key, ids.alias("input_ids"), mask.alias("attention_mask"))
    return S.request_fanout(encoded, num_reqs)


def compare_precisions(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """One model on full and on 8-bit inputs, compared input by input."""
    model = S.fit_centroid_model(df, vector, label)
    exact = S.batch_score(df, model, vector)
    rough = S.batch_score(df.withColumn(vector, A.quantise(F.col(vector))), model, vector)
    return S.compare_backends(exact, rough, key)


def chunks_per_source(docs: DataFrame) -> DataFrame:
    """Distinct documents of each source and the blocks they are cut into."""
    chunks = chunk_text(dedup_rows(docs.select("text", "lang", "source")), "text", 1024, 1024)
    first = F.count(F.when(F.col("chunk_no") == 0, 1))
    return chunks.groupBy("source").agg(first.alias("n_docs"), F.count(F.lit(1)).alias("n_chunks"))
