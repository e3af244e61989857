"""Folders of text files on shared storage: listing, whole-file reads and one-file-per-row writes.

Spark's own file sources pass over names that start with a dot or an underscore, which a code
corpus is full of, so files are listed and opened inside tasks instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import paths as P
from millrace.session import stage
from millrace.sources.manifest import exclude_component, union_sources

READ_BATCH_BYTES = 32 * 1024 * 1024
_LISTING = "uri string, size bigint, is_dir boolean"


def _locator():
    """A function from an address to its file system and path; names are taken as they are.

    Made inside a function so that it travels to workers by value.
    """
    import re

    stores = {}

    def locate(uri: str):
        from pyarrow import fs

        scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(//[^/]*)?", uri)
        if scheme is None or scheme[1] == "file":
            return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
        head = scheme[0]
        if head not in stores:
            stores[head] = fs.FileSystem.from_uri(f"{head}/")
        store, base = stores[head]
        return store, f"{base.rstrip('/')}/{uri[len(head):].lstrip('/')}"

    return locate


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` as ``path, uri, size``, hidden ones included.

    Each pass lists one level of folders in parallel and stages it; only the number of folders
    of a level reaches the driver.
    """

    locate = _locator()

    def children(batches):
        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            for uri in batch["uri"]:
                store, path = locate(uri)
                infos = store.get_file_info(fs.FileSelector(path))
                for i in range(0, len(infos), 10000):
                    part = infos[i : i + 10000]
                    yield pd.DataFrame(
                        {
                            "uri": [f"{uri}/{x.base_name}" for x in part],
                            "size": [x.size or 0 for x in part],
                            "is_dir": [x.type == fs.FileType.Directory for x in part],
                        }
                    )

    root = root.rstrip("/")
    folders = spark.createDataFrame([(root,)], "uri string")
    levels = []
    while True:
        level = stage(folders.repartition("uri").mapInPandas(children, _LISTING), "listing")
        levels.append(level.where(~F.col("is_dir")))
        folders = level.where("is_dir").select("uri")
        if folders.isEmpty():
            break
    return union_sources(*levels).select(F.substring("uri", len(root) + 2, 2**31 - 1).alias("path"), "uri", "size")


def scan_text_tree(spark: SparkSession, manifest: DataFrame, skip_component: str = P.METADATA_DIR) -> DataFrame:
    """Whole text of each listed file as ``path, text``.

    ``manifest`` holds ``path, uri``. Line ends become newlines; bytes that are not UTF-8 fail
    the job. Files below a folder named ``skip_component`` are left out.
    """
    limit, locate = READ_BATCH_BYTES, _locator()

    def read(batches):
        import pandas as pd

        for batch in batches:
            paths, texts, held = [], [], 0
            for path, uri in zip(batch["path"], batch["uri"]):
                store, name = locate(uri)
                with store.open_input_stream(name) as f:
                    data = f.read()
                paths.append(path)
                texts.append(data.decode("utf-8"))
                held += len(data)
                if held >= limit:
                    yield pd.DataFrame({"path": paths, "text": texts})
                    paths, texts, held = [], [], 0
            if paths:
                yield pd.DataFrame({"path": paths, "text": texts})

    wanted = exclude_component(manifest.select("path", "uri"), "path", skip_component)
    raw = wanted.repartition("path").mapInPandas(read, "path string, text string")
    return raw.select("path", F.regexp_replace("text", r"\r\n?", "\n").alias("text"))


def write_text_tree(df: DataFrame, root: str, path: str = "path", text: str = "text") -> DataFrame:
    """Write each row's text to ``root/path`` and return ``path, n_bytes`` of what was written.

    A task that is run again rewrites the same bytes under the same name.
    """
    base, locate = root.rstrip("/"), _locator()

    def write(batches):
        import pandas as pd

        made = set()
        for batch in batches:
            sizes = []
            for rel, body in zip(batch["path"], batch["text"]):
                store, name = locate(f"{base}/{rel}")
                folder = name.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                data = body.encode("utf-8")
                with store.open_output_stream(name) as f:
                    f.write(data)
                sizes.append(len(data))
            yield pd.DataFrame({"path": batch["path"], "n_bytes": sizes})

    rows = df.select(F.col(path).alias("path"), F.col(text).alias("text"))
    return stage(rows.mapInPandas(write, "path string, n_bytes bigint"), "written")


def write_line_files(df: DataFrame, root: str, line: str, header: str) -> DataFrame:
    """Write the text column ``line`` as one file a partition, each starting with ``header``."""
    base, locate = root.rstrip("/"), _locator()

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext

        store, folder = locate(base)
        store.create_dir(folder, recursive=True)
        name, n = f"{folder}/lines-{TaskContext.get().partitionId():06d}.csv", 0
        with store.open_output_stream(name) as f:
            f.write(f"{header}\n".encode())
            for batch in batches:
                for text in batch["line"]:
                    f.write(f"{text}\n".encode())
                n += len(batch)
        yield pd.DataFrame({"file": [name], "n_lines": [n]})

    return stage(df.select(F.col(line).alias("line")).mapInPandas(write, "file string, n_lines bigint"), "written")
