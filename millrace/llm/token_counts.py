"""Token counts of fields and sections from one encoding of each whole document.

A document is its fields, one after the other, with a line end between them; the last field is the
text, whose lines are sections. The whole is encoded once with a byte-level vocabulary. Every
token is a known string of bytes, so running sums of their lengths are the tokens' spans; spans
are put in characters (a token that begins inside a character begins where that character does).
Tokens and sections are both in order, so the interval join is a search of one in the other,
inside the task that encoded the document: nothing is shuffled.

A token that crosses boundaries goes to one section, by ``rule``:

* ``start``: the section of its first character,
* ``end``: the section of its last character,
* ``most``: the section that holds most of its characters, the first of equal ones.

The line end after a field or a line belongs to it. Counts of the sections of a document add up to its
tokens. Null fields and texts are empty; an empty text is one empty section; an empty section is
given a token by no rule. Rows that repeat an id are counted one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import NULL_ID, plain_id

# Fixed value: how the public byte-level vocabularies cut text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("start", "end", "most")
_ENCODERS: dict[bytes, tuple] = {}


def read_vocabulary(spark: SparkSession, path: str) -> bytes:
    """The vocabulary file, read by Spark from wherever the path points."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


def encoder(vocabulary: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder and the bytes in each token; built once a Python worker."""
    key = vocabulary[:64] + len(vocabulary).to_bytes(8, "big")
    if key not in _ENCODERS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _ENCODERS[key] = tiktoken.Encoding("given", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}), sizes
    return _ENCODERS[key]


def token_spans(text: str, vocabulary: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of every token of ``text``."""
    coder, sizes = encoder(vocabulary)
    ends = np.cumsum(sizes[np.asarray(coder.encode_ordinary(text), np.int64)])
    data = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    return char[starts], char[ends - 1]


def allocated(first: np.ndarray, last: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token; section ``k`` is the characters from ``bounds[k]`` to before ``bounds[k + 1]``."""
    a = np.searchsorted(bounds, first, "right") - 1
    if rule == "start":
        return a
    b = np.searchsorted(bounds, last, "right") - 1
    if rule == "end":
        return b
    out = a.copy()
    for t in np.flatnonzero(a != b):
        share = np.minimum(bounds[a[t] + 1 : b[t] + 2], last[t] + 1) - np.maximum(bounds[a[t] : b[t] + 1], first[t])
        out[t] = a[t] + int(np.argmax(share))
    return out


def _counted(vocabulary, fields: list[str], rule: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[f"f{k}"] for k in range(len(fields))]
            totals, by_field, by_section = [], [], []
            for i in range(batch.num_rows):
                parts = [c[i].as_py() or "" for c in columns]
                lines = parts[-1].split("\n")
                pieces = [p + "\n" for p in parts[:-1]] + [s + "\n" for s in lines[:-1]] + [lines[-1]]
                bounds = np.cumsum([0] + [len(p) for p in pieces])
                first, last = token_spans("".join(pieces), vocabulary.value)
                counts = np.bincount(allocated(first, last, bounds, rule), minlength=len(pieces)) if len(first) else np.zeros(len(pieces), np.int64)
                k = len(parts) - 1
                totals.append(int(counts.sum()))
                by_field.append(counts[:k].tolist() + [int(counts[k:].sum())])
                by_section.append(counts[k:].tolist())
            out = [batch["_id"], pa.array(totals, pa.int64()), pa.array(by_field, pa.list_(pa.int64())), pa.array(by_section, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(out, ["_id", "n_tokens", "field_tokens", "section_tokens"])

    return run


def token_counts(
    docs: DataFrame, vocabulary_path: str, fields: list[str] | None = None, rule: str = "start", id_col: str = "doc_id"
) -> DataFrame:
    """``(doc_id, n_tokens, field_tokens, section_tokens)``: one row a document.

    ``fields`` names the columns of a document in order, the text last; ``field_tokens`` has the
    tokens given to each, ``section_tokens`` those given to each line of the text.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    fields = fields or ["lang", "source", "text"]
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary_path))
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NULL_ID)).alias("_id"), *[F.col(f"`{c}`").cast("string").alias(f"f{k}") for k, c in enumerate(fields)]
    )
    schema = "_id bigint, n_tokens bigint, field_tokens array<bigint>, section_tokens array<bigint>"
    return rows.mapInArrow(_counted(vocabulary, fields, rule), schema).select(plain_id(id_col), "n_tokens", "field_tokens", "section_tokens")
