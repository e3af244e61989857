import pytest
from pyspark.sql import functions as F

from millrace.sources import manifest as M
from millrace.sources import text_tree as TT

TREE = {
    "repo/a/b.py": b"l1\r\nl2\n",
    "repo/a/old.py": b"l1\rl2",
    "repo/a/e.py": b"",
    "repo/__init__.py": b"x = 1\n",
    "repo/.hidden.py": b"y",
    "repo/.git/config": b"z",
    "repo/Dockerfile": b"FROM",
    "repo/odd name%20#1.txt": "é😀".encode(),
    "metadata/repo/x.metadata.json": b"{}",
    "repo/metadata_notes/y.md": b"kept",
    "top.txt": b"t",
}


@pytest.fixture
def root(tmp_path):
    for path, data in TREE.items():
        file = tmp_path / "tree" / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(data)
    (tmp_path / "tree" / "empty_dir").mkdir()
    return str(tmp_path / "tree")


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_listing_sees_every_file(spark, root, scheme):
    got = {r["path"]: r["size"] for r in TT.list_tree(spark, scheme + root).collect()}
    assert got == {p: len(d) for p, d in TREE.items()}


def test_whole_texts_with_plain_line_ends(spark, root):
    got = {r["path"]: r["text"] for r in TT.scan_text_tree(spark, TT.list_tree(spark, root)).collect()}
    want = {
        p: d.decode().replace("\r\n", "\n").replace("\r", "\n") for p, d in TREE.items() if "metadata" not in p.split("/")
    }
    assert got == want


def test_bad_bytes_fail(spark, root):
    with open(f"{root}/bad.txt", "wb") as f:
        f.write(b"\xff\xfe")
    with pytest.raises(Exception, match="codec can't decode"):
        TT.scan_text_tree(spark, TT.list_tree(spark, root)).collect()


def test_small_batches_lose_nothing(spark, root, monkeypatch):
    monkeypatch.setattr(TT, "READ_BATCH_BYTES", 1)
    assert TT.scan_text_tree(spark, TT.list_tree(spark, root)).count() == len(TREE) - 1


def test_write_then_read(spark, tmp_path):
    docs = spark.createDataFrame([("a/_1.txt", "één"), ("b/2.txt", ""), ("b/c/3.txt", "x\ny")], "path string, text string")
    written = TT.write_text_tree(docs, str(tmp_path / "out"))
    assert {(r["path"], r["n_bytes"]) for r in written.collect()} == {("a/_1.txt", 5), ("b/2.txt", 0), ("b/c/3.txt", 3)}
    back = TT.scan_text_tree(spark, TT.list_tree(spark, str(tmp_path / "out")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, docs.collect()))


def test_line_files_each_have_a_header(spark, tmp_path):
    lines = spark.range(100).select(F.col("id").cast("string").alias("l")).repartition(4)
    TT.write_line_files(lines, str(tmp_path / "csv"), "l", "id")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 100


def test_tree_to_manifest(spark, root):
    files = TT.list_tree(spark, root).select(
        F.split("path", "/")[0].alias("repo_name"), F.regexp_replace("path", "^[^/]*/", "").alias("path"), "size"
    )
    repos = spark.createDataFrame([("repo", "https://h/repo", "s")], "repo_name string, url string, sha string")
    got = {r["path"] for r in M.corpus_manifest(files, repos).collect()}
    assert got == {"a/b.py", "a/old.py", "__init__.py", ".hidden.py", "odd name%20#1.txt", "metadata_notes/y.md"}
