"""Registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import arrays as A
from millrace.functions import paths as P
from millrace.functions import records as R
from millrace.operators import card, chunk, context, dedup, index, leakage, scoring, split, tokens
from millrace.operators import perplexity as ppl
from millrace.plans import flows
from millrace.session import new_path, stage
from millrace.sources import delimited, manifest, sinks, text_tree
from millrace.streaming import delta, run, stamp

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

QUERY_VOCAB = 2000
HELD_SOURCES = ["src1", "src7"]
REPO_BASE = "https://repos.example/"
PAGE_SUFFIXES = [".html", "5.html", "/"]
PAGE_INCLUDE = ["8.html"]
PAGE_EXCLUDE = ["25", "328.html"]
PAGE_GLOBS = ["m.*/**", "*/fr/*", "www.*/en/[0-4]*"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _page_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pages seen as files: ``page_id, full, repo_name, path, size``."""
    pages = _read(spark, folder, "pages").select("page_id", P.url_path(F.col("url")).alias("full"), F.octet_length("html").alias("size"))
    return pages.select(
        "page_id",
        "full",
        P.top_component(F.col("full")).alias("repo_name"),
        F.regexp_replace("full", r"^[^/]*/", "").alias("path"),
        "size",
    )


def _repos(names: DataFrame, column: str) -> DataFrame:
    """A repository table: name, address and commit."""
    distinct = names.select(F.col(column).alias("repo_name")).distinct()
    repos = distinct.select("repo_name", F.concat(F.lit(REPO_BASE), "repo_name").alias("url"), F.md5("repo_name").alias("sha"))
    return stage(repos, "repos")


def _vocab(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.build_vocab(_read(spark, folder, "documents"), QUERY_VOCAB)


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode(_read(spark, folder, "documents"), _vocab(spark, folder), ["doc_id"])


def _rounded(scores: str, pos: str = "pos"):
    return F.posexplode(F.transform(scores, lambda x: F.round(x, 6))).alias(pos, "score")


# Sources


@query
def scan_csv_skip_bad(spark, folder):
    # German lines get one field too many, French ones lose their last.
    line = delimited.csv_line("doc_id", "source", "lang", "text", "n_chars")
    short = delimited.csv_line("doc_id", "source", "lang", "text")
    broken = F.when(F.col("lang") == "de", F.concat(line, F.lit(',"extra, field"'))).when(F.col("lang") == "fr", short).otherwise(line)
    root = new_path(spark, "csv")
    docs = _read(spark, folder, "documents").select(broken.alias("line"))
    text_tree.write_line_files(docs, root, "line", "doc_id,source,lang,text,n_chars")
    rows = delimited.scan_csv(spark, root, ["doc_id", "source", "lang", "text", "n_chars"])
    return delimited.cast_columns(rows, {"doc_id": "bigint", "n_chars": "bigint"})


@query
def corpus_manifest(spark, folder):
    files = _page_files(spark, folder)
    return manifest.corpus_manifest(
        files.select("repo_name", "path", "size"),
        _repos(files, "repo_name"),
        extensions=PAGE_SUFFIXES,
        include=PAGE_INCLUDE,
        exclude=PAGE_EXCLUDE,
        globs=["fr/*"],
    )


@query
def scan_text_tree(spark, folder):
    root = new_path(spark, "tree")
    docs = _read(spark, folder, "documents").select(F.format_string("%s/_%d.txt", "source", "doc_id").alias("path"), "text")
    sidecars = _read(spark, folder, "labels").select(
        F.format_string("metadata/%d.json", "doc_id").alias("path"), F.to_json(F.struct("quality", "toxic")).alias("text")
    )
    text_tree.write_text_tree(docs.unionByName(sidecars), root)
    return text_tree.scan_text_tree(spark, text_tree.list_tree(spark, root))


@query
def parse_json_defaults(spark, folder):
    limits = T.StructType().add("low", T.IntegerType()).add("high", T.IntegerType())
    schema = T.StructType().add("k", T.IntegerType()).add("unit", T.StringType()).add("limits", limits)
    record = R.parse_json_record(F.col("props"), schema, {"k": 0, "unit": "ms", "limits": {"low": 0}})
    rows = _read(spark, folder, "events").select("event_id", record.alias("r"))
    return rows.select("event_id", "r.k", "r.unit", F.col("r.limits.low").alias("low"))


@query
def corpus_file_inventory(spark, folder):
    return manifest.file_inventory(_page_files(spark, folder), "full")


# Sinks


@query
def write_corpus(spark, folder):
    docs = _read(spark, folder, "documents").select(
        F.col("source").alias("repo_name"), F.format_string("%s/%d.txt", "lang", "n_chars").alias("path"), "doc_id", "text"
    )
    return sinks.write_corpus(docs, new_path(spark, "corpus"), order="doc_id").select("repo_name", "file_name", "doc_id", "text")


@query
def write_metadata(spark, folder):
    files = _page_files(spark, folder)
    linked = manifest.with_repo_columns(
        files.withColumns({"url": F.concat(F.lit(REPO_BASE), "repo_name"), "sha": F.md5("repo_name")})
    )
    return sinks.write_metadata(linked, new_path(spark, "metadata"))


@query
def write_deduped(spark, folder):
    docs = dedup.dedup_rows(_read(spark, folder, "documents").drop("doc_id"))
    return sinks.write_table(docs, new_path(spark, "deduped"))


@query
def corpus_card(spark, folder):
    return card.corpus_card(manifest.file_inventory(_page_files(spark, folder), "full"))


# Projections and filters


@query
def drop_empty_files(spark, folder):
    return manifest.drop_empty(_read(spark, folder, "documents"), F.length("text")).select("doc_id", "source")


@query
def filter_extensions(spark, folder):
    return manifest.filter_extensions(_page_files(spark, folder), "full", PAGE_SUFFIXES).select("page_id", "full")


@query
def include_over_exclude(spark, folder):
    files = _page_files(spark, folder)
    return manifest.include_over_exclude(files, "full", PAGE_INCLUDE, PAGE_EXCLUDE, PAGE_GLOBS).select("page_id", "full")


@query
def exclude_globs(spark, folder):
    return manifest.exclude_globs(_page_files(spark, folder), "full", PAGE_GLOBS).select("page_id", "full")


@query
def exclude_component(spark, folder):
    return manifest.exclude_component(_page_files(spark, folder), "full", "en").select("page_id", "full")


@query
def repo_path_columns(spark, folder):
    files = _page_files(spark, folder).select(
        "page_id", "path", F.concat(F.lit(REPO_BASE), "repo_name").alias("url"), F.md5("repo_name").alias("sha")
    )
    return manifest.with_repo_columns(files).select("page_id", "repo_name", "blob_url")


@query
def flatten_file_name(spark, folder):
    full = F.concat(F.lit(P.ROOT_URL), "full")
    return _page_files(spark, folder).select("page_id", P.flatten_name(full).alias("file_name"))


@query
def sidecar_name(spark, folder):
    return _page_files(spark, folder).select("page_id", P.sidecar_name(P.flatten_name(F.col("full"))).alias("file_name"))


@query
def file_extension(spark, folder):
    return _page_files(spark, folder).select("page_id", P.file_extension(F.col("path")).alias("extension"))


@query
def append_eos(spark, folder):
    return chunk.append_eos(_read(spark, folder, "documents").select("doc_id", "text"))


@query
def elapsed_ms(spark, folder):
    ms = R.elapsed_ms(F.date_trunc("hour", "ts").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    return _read(spark, folder, "events").select("event_id", ms.alias("elapsed_ms")).withColumn(
        "shown", R.render_ms(F.col("elapsed_ms"))
    )


@query
def scale_vectors(spark, folder):
    scaled = scoring.scale_vectors(_read(spark, folder, "embeddings"), "embedding", 255.0)
    return scoring.matrix_long(scaled, "batch", ["vec_id"]).withColumn("value", F.round("value", 9))


# Joins


@query
def files_join_repos(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", F.col("source").alias("repo_name"))
    return manifest.files_join_repos(docs, _repos(docs, "repo_name")).select("doc_id", "repo_name", "url", "sha")


@query
def anti_exclusions(spark, folder):
    toxic = _read(spark, folder, "labels").where("toxic = 1")
    return manifest.anti_exclusions(_read(spark, folder, "documents").select("doc_id", "source"), toxic, "doc_id")


@query
def docs_join_metadata(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return manifest.docs_join_metadata(docs, _read(spark, folder, "labels"), "doc_id")


@query
def request_fanout(spark, folder):
    return scoring.request_fanout(_read(spark, folder, "conversations").select("conv_id", "turn", "text"), 3)


@query
def compare_backends(spark, folder):
    compared = flows.compare_precisions(_read(spark, folder, "embeddings"), "vec_id", "embedding", "label")
    return compared.withColumn("max_abs_diff", F.round("max_abs_diff", 6))


# Aggregates


@query
def dedup_rows(spark, folder):
    return dedup.dedup_rows(_read(spark, folder, "documents").drop("doc_id"))


@query
def files_per_repo(spark, folder):
    return card.files_per_repo(_read(spark, folder, "documents"), "source", "text")


@query
def extension_counts(spark, folder):
    return card.extension_counts(_page_files(spark, folder), "path")


@query
def perplexity(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", "source", "text")
    train, test = split.train_test_split(docs, ["doc_id"], 0.1)
    return ppl.perplexity(train, test, ["source"]).withColumn("perplexity", F.round("perplexity", 4))


@query
def dataset_size(spark, folder):
    return card.dataset_size(chunk.chunk_text(_read(spark, folder, "documents").select("doc_id", "text"), "text", 1024, 1024))


@query
def sequence_shape_profile(spark, folder):
    words = _read(spark, folder, "documents").select(tokens.words(F.col("text")).alias("words"))
    profiles = manifest.union_sources(
        card.shape_profile(_read(spark, folder, "embeddings"), ["embedding"]), card.shape_profile(words, ["words"])
    )
    return profiles.withColumn("avg_len", F.round("avg_len", 6))


@query
def backend_timing(spark, folder):
    # Event types stand for backends and values for seconds, so that the times can be checked.
    times = scoring.backend_timing(_read(spark, folder, "events"), "view", "event_type", "value", accuracy=None)
    rounded = ("total_s", "mean_s", "p50_s", "p95_s", "speedup")
    return times.select("backend", "n", "min_s", "max_s", *[F.round(c, 6).alias(c) for c in rounded])


@query
def name_collisions(spark, folder):
    files = _page_files(spark, folder).withColumn("file_name", P.flatten_name(F.col("full")))
    return card.name_collisions(files, ["repo_name", "file_name"])


@query
def confusion_matrix(spark, folder):
    vectors = _read(spark, folder, "embeddings")
    return scoring.confusion(scoring.batch_score(vectors, scoring.fit_centroid_model(vectors)), "label", "predicted")


@query
def collect_group_files(spark, folder):
    files = _read(spark, folder, "documents").select("source", F.format_string("%s/%d.txt", "lang", "doc_id").alias("file"))
    return card.collect_group_files(files, "source", "file", 20).withColumn("files", F.array_join("files", ","))


@query
def build_vocab(spark, folder):
    return _vocab(spark, folder)


# Order


@query
def dedup_keep_first(spark, folder):
    return dedup.dedup_keep_first(_read(spark, folder, "documents"), ["text", "lang"], ["doc_id"])


@query
def transcript_delta(spark, folder):
    return context.transcript_delta(_read(spark, folder, "conversations"), "conv_id", "turn").select("conv_id", "turn", "delta")


@query
def context_tail(spark, folder):
    turns = _read(spark, folder, "conversations").select("conv_id", "turn", tokens.words(F.col("text")).alias("words"))
    tails = context.context_tail(turns, "conv_id", "turn", "words", 32)
    return tails.select("conv_id", "turn", F.array_join("context", " ").alias("context"))


@query
def batch_ids(spark, folder):
    return index.with_batch_id(_read(spark, folder, "documents").select("doc_id", "source"), ["doc_id"], 8)


@query
def row_index(spark, folder):
    return index.with_row_index(_read(spark, folder, "documents").select("doc_id", "source"), ["source", "doc_id"])


@query
def limit_docs(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return chunk.chunk_text(index.limit_rows(docs, ["doc_id"], flows.DEBUG_DOCUMENTS), "text", 1024, 1024)


@query
def head_rows(spark, folder):
    return index.head_rows(_read(spark, folder, "documents").select("doc_id", "source", "lang"), ["doc_id"])


@query
def first_result(spark, folder):
    replies = _read(spark, folder, "conversations").where("role = 'assistant'")
    return index.first_result(replies, "conv_id", "turn", "text")


# Sets and splits


@query
def union_sources(spark, folder):
    tagged = [
        _read(spark, folder, name).select(F.lit(name).alias("origin"), "text")
        for name in ("documents", "benchmark", "conversations")
    ]
    return manifest.union_sources(*tagged)


@query
def distinct_names(spark, folder):
    return manifest.distinct_names(_read(spark, folder, "documents"), "source")


@query
def train_test_split(spark, folder):
    flagged = split.with_split(_read(spark, folder, "documents").select("doc_id", "source"), ["doc_id"])
    return flagged.select("doc_id", "source", "is_test")


# Text and tokens


@query
def chunk_text(spark, folder):
    return chunk.chunk_text(_read(spark, folder, "documents").select("doc_id", "text"))


@query
def tokenize(spark, folder):
    return _encoded(spark, folder).select("doc_id", A.joined(F.col("ids")).alias("ids"))


@query
def pad_truncate(spark, folder):
    ids, mask = A.pad_truncate(F.col("ids"), side="left")
    docs = _read(spark, folder, "documents")
    encoded = tokens.encode(docs, _vocab(spark, folder), ["doc_id"], max_tokens=A.REQUEST_LENGTH)
    return encoded.select("doc_id", A.joined(ids).alias("input_ids"), A.joined(mask).alias("attention_mask"))


@query
def batch_pad_labels(spark, folder):
    batches = tokens.collate(stage(_encoded(spark, folder), "encoded"), ["doc_id"], 8, "right")
    arrays = ("input_ids", "attention_mask", "labels")
    return batches.select("doc_id", "batch_id", *[A.joined(F.col(c)).alias(c) for c in arrays])


@query
def decode_ids(spark, folder):
    vocab = _vocab(spark, folder)
    return tokens.decode(tokens.encode(_read(spark, folder, "documents"), vocab, ["doc_id"], eos=True), vocab, ["doc_id"])


@query
def matrix_long(spark, folder):
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))
    square = _read(spark, folder, "embeddings").select("vec_id", rows.alias("matrix"))
    return scoring.matrix_long(square, "matrix", ["vec_id"]).withColumn("value", F.round(F.col("value").cast("double"), 9))


@query
def clm_examples(spark, folder):
    examples = tokens.clm_examples(_encoded(spark, folder))
    return examples.select("doc_id", A.joined(F.col("ids")).alias("ids"), A.joined(F.col("labels")).alias("labels"))


@query
def metadata_prefix(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    return chunk.metadata_prefix(docs, ["source", "lang"]).select("doc_id", "text")


@query
def group_holdout(spark, folder):
    return split.group_holdout(_read(spark, folder, "documents").select("doc_id", "source"), "source", HELD_SOURCES)


@query
def split_leakage(spark, folder):
    return split.split_leakage(*split.train_test_split(_read(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], 0.1))


@query
def passage_leakage(spark, folder):
    return leakage.passage_leakage(*split.train_test_split(_read(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], 0.1))


@query
def fim_transform(spark, folder):
    return tokens.fim_transform(_read(spark, folder, "documents").select("doc_id", "text"), ["doc_id"])


@query
def mlm_mask(spark, folder):
    masked = tokens.mlm_mask(_encoded(spark, folder), ["doc_id"])
    return masked.select("doc_id", A.joined(F.col("input_ids")).alias("input_ids"), A.joined(F.col("labels")).alias("labels"))


# Python batches and table functions


@query
def batch_score(spark, folder):
    vectors = _read(spark, folder, "embeddings")
    scored = scoring.batch_score(vectors, scoring.fit_centroid_model(vectors))
    return scored.select("vec_id", "predicted", _rounded("scores"))


@query
def best_labels(spark, folder):
    # A model that grows with the table: one label for each four vectors.
    vectors = _read(spark, folder, "embeddings").select("vec_id", "embedding", F.floor(F.col("vec_id") / 4).alias("label"))
    scored = scoring.best_labels(vectors, scoring.class_centroids(vectors), block_labels=1024)
    return scored.select("vec_id", "predicted", F.round("best_score", 6).alias("best_score"))


@query
def timed_batch_score(spark, folder):
    vectors = _read(spark, folder, "embeddings")
    timed = scoring.timed_batch_score(vectors, scoring.fit_centroid_model(vectors), "worker")
    return timed.select("vec_id", "backend", "predicted", (F.col("elapsed_s") >= 0).alias("timed"))


@query
def map_batches(spark, folder):
    return chunk.map_batches(
        _read(spark, folder, "documents").select("doc_id", "text"),
        chunk.column_chunker(),
        "doc_id bigint, chunk_no bigint, chunk string",
        text="text",
        block_size=1024,
        skip_by=512,
    )


@query
def chunk_udtf(spark, folder):
    return chunk.chunk_lateral(_read(spark, folder, "documents"), ["doc_id"], "text", 1024, 512)


# Streams


@query
def stream_stamp(spark, folder):
    events = run.read_table(spark, f"{folder}/events.parquet", _read(spark, folder, "events"))
    named = events.select("event_id", F.col("event_type").alias("name"))
    stamped = run.drain(stamp.stamp_stream(named), "stamped")
    # The stamp itself differs from run to run; that it is epoch seconds does not.
    return stamped.select("event_id", "name", F.col("timestamp").rlike(r"^[0-9]{10}\.[0-9]{6}$").alias("stamped"))


@query
def stream_delta(spark, folder):
    turns = run.read_table(spark, f"{folder}/conversations.parquet", _read(spark, folder, "conversations"), files_per_trigger=1)
    return delta.stream_delta(turns, "conv_id", "turn")


# Flagship


@query
def chunks_per_source(spark, folder):
    return flows.chunks_per_source(_read(spark, folder, "documents"))
