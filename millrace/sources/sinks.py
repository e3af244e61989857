"""Corpus, sidecar and table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import paths as P
from millrace.session import stage
from millrace.sizing import lookup_join

# A folder name can't hold an empty value, and one name of its own stands for null.
MARK, NULL_FOLDER = "~", "__HIVE_DEFAULT_PARTITION__"


def _texts(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]


def _to_folder(value: Column) -> Column:
    """An injective name for a folder value: a mark goes before the empty value, the name for null and marked values."""
    odd = (value == "") | (value == NULL_FOLDER) | value.startswith(MARK)
    return F.when(odd, F.concat(F.lit(MARK), value)).otherwise(value)


def _from_folder(value: Column) -> Column:
    return F.when(value.startswith(MARK), F.substring(value, len(MARK) + 1, 2**31 - 1)).otherwise(value)


def _marked(spark: SparkSession, out: str, partition_by: list[str], column: str) -> bool:
    """Whether a folder of ``column`` has a mark: one look at folder names."""
    upper = "".join(f"/{c}=*" for c in partition_by[: partition_by.index(column)])
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}{upper}/{column}={MARK}*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def _write_folders(df: DataFrame, out: str, partition_by: list[str], kind: str) -> DataFrame:
    """Write ``df`` in folders and read it back; nulls, empty texts and other types come back as they went in."""
    texts = _texts(df, partition_by)
    coded = df.withColumns({c: _to_folder(F.col(c)) for c in texts}) if texts else df
    coded.hint("rebalance", *partition_by).write.partitionBy(*partition_by).mode("overwrite").format(kind).save(out)
    spark = df.sparkSession
    back = spark.read.schema(df.schema).format(kind).load(out)
    odd = [c for c in texts if _marked(spark, out, partition_by, c)]
    return back.withColumns({c: _from_folder(F.col(c)) for c in odd}).select(*df.columns) if odd else back.select(*df.columns)


def last_of_same_name(df: DataFrame, repo: str, name: str, order: str) -> DataFrame:
    """Of documents that share a file name in a repository keep the one last in ``order``.

    Ties in ``order`` go by a hash of the row; equal rows are kept once. Null names and repositories
    count as equal. Names are counted without their text, and only names used twice become a
    side table, one row each. The text is shuffled only if that table does not fit a broadcast.
    """
    keys = {"_repo": F.to_json(F.array(repo)), "_name": F.to_json(F.array(name))}  # null and empty differ
    rank = F.struct(F.col(order).alias("o"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("h"))
    named = df.withColumns(keys | {"_rank": rank})
    used = named.groupBy("_repo", "_name").agg(F.max("_rank").alias("_last"), F.count(F.lit(1)).alias("_n"))
    clashes = stage(used.where("_n > 1").drop("_n"), "same-name")
    joined = lookup_join(named, clashes, ["_repo", "_name"], "left")
    single = joined.where(F.col("_last").isNull()).select(*df.columns)
    if clashes.isEmpty():
        return single
    return single.unionByName(joined.where(F.col("_rank") == F.col("_last")).select(*df.columns).dropDuplicates())


def write_table(df: DataFrame, out: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write Parquet and read it back.

    With ``partition_by`` rows are first rebalanced on those columns: small folders get one
    file each, and adaptive execution splits a folder that holds a large share of the rows.
    The input is read once, whatever values it has.
    """
    if partition_by:
        return _write_folders(df, out, partition_by, "parquet")
    df.write.mode("overwrite").parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out).select(*df.columns)


def write_corpus(df: DataFrame, out: str, repo: str = "repo_name", path: str = "path", order: str = "path") -> DataFrame:
    """Each document under its repository with a flat file name; of equal names the last wins."""
    named = df.withColumn("file_name", P.flatten_name(F.col(path)))
    return write_table(last_of_same_name(named, repo, "file_name", order), out, [repo])


def write_metadata(df: DataFrame, out: str, repo: str = "repo_name", path: str = "path", url: str = "blob_url") -> DataFrame:
    """A JSON record a document: sidecar name and source address, in a folder a repository.

    Records keep the full path as key, so two files whose sidecar names agree keep both.
    """
    records = df.select(
        repo,
        F.col(path).alias("path"),
        P.sidecar_name(P.flatten_name(F.col(path))).alias("file_name"),
        F.col(url).alias("github_url"),
    )
    return _write_folders(records, out, [repo], "json")
