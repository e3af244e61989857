from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from millrace.functions import paths as P
from millrace.sources import manifest as M

PATHS = [
    "repo/a/b.py", "repo/a/b.md", "repo/a/m.tsx", "repo/a/m.ts", "repo/__init__.py", "repo/.hidden.py", "repo/Dockerfile",
    "repo/a/b-c.py", "repo/a-b/c.py", "metadata/repo/x.metadata.json", "repo/metadata_notes/y.md", "top.txt", "repo/a.b.c.go",
    "repo/.hidden", "repo/ends.", "repo/sp ace/é.sh", "repo/a/docs/deep/er/z.rst", "repo/[x].py",
]


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([(p,) for p in PATHS], "path string")


def column(files, expr):
    return {r[0]: r[1] for r in files.select("path", expr).collect()}


def test_sidecar_matches_with_suffix(files):
    got = column(files, P.sidecar_name(P.flatten_name(F.col("path"))))
    for p in PATHS:
        flat = p.replace("/", "-")
        if flat.endswith("."):
            assert got[p] == flat + ".metadata.json"
        else:
            assert got[p] == str(PurePosixPath(flat).with_suffix(".metadata.json"))


def test_names_and_parents(files):
    assert column(files, P.base_name(F.col("path"))) == {p: PurePosixPath(p).name for p in PATHS}
    assert column(files, P.file_extension(F.col("path"))) == {p: p.split(".")[-1] for p in PATHS}
    assert column(files, P.parent_dir(F.col("path"))) == {p: p.rpartition("/")[0] for p in PATHS}
    assert column(files, P.has_component(F.col("path"), "metadata")) == {p: "metadata" in p.split("/") for p in PATHS}


def test_flatten_drops_root_address(spark):
    df = spark.createDataFrame([(P.ROOT_URL + "o/r/a.py",)], "p string")
    assert df.select(P.flatten_name(F.col("p"))).first()[0] == "o-r-a.py"


@pytest.mark.parametrize("globs", [["repo/*.py"], ["**/*.py"], ["repo/**"], ["repo/a/?.md", "top.*"], ["repo/[a-b]/m.t?"], ["**/deep/**"], ["repo/[[]x].py"]])
def test_globs_match_like_paths(files, globs):
    got = {r[0] for r in M.exclude_globs(files, "path", globs).collect()}
    assert got == {p for p in PATHS if not any(PurePosixPath(p).full_match(g) for g in globs)}


def test_upload_globs_cross_folders(files):
    got = {r[0] for r in M.exclude_globs(files, "path", ["repo*", "metadata*"], across_dirs=True).collect()}
    assert got == {"top.txt"}


def test_no_globs_keeps_all(files):
    assert M.exclude_globs(files, "path", []).count() == len(PATHS)


def test_include_wins_and_never_adds(files):
    kept = {r[0] for r in M.include_over_exclude(files, "path", ["b.py"], ["b.py", "b.md"], ["repo/a/*"]).collect()}
    gone = {"repo/a/b.md", "repo/a/m.tsx", "repo/a/m.ts", "repo/a/b-c.py"}
    assert kept == set(PATHS) - gone


def test_suffix_lists(files):
    kept = {r[0] for r in M.filter_extensions(files, "path").collect()}
    assert kept == {p for p in PATHS if p.endswith(tuple(P.DEFAULT_EXTENSIONS))}
    assert "repo/Dockerfile" not in kept


def test_manifest(spark):
    files = spark.createDataFrame(
        [("r", "a/x.py", 3), ("r", "a/x.py", 3), ("r", "empty.py", 0), ("r", "Dockerfile", 5), ("q", "y.go", 1), ("none", "z.py", 1)],
        "repo_name string, path string, size bigint",
    )
    repos = spark.createDataFrame([("r", "https://h/r", "s1"), ("q", "https://h/q", "s2")], "repo_name string, url string, sha string")
    want = {("r", "a/x.py", "https://h/r/blob/s1/a/x.py"), ("q", "y.go", "https://h/q/blob/s2/y.go")}
    got = [tuple(r) for r in M.corpus_manifest(files, repos).collect()]
    assert len(got) == 2 and set(got) == want
    more = {tuple(r) for r in M.corpus_manifest(files, repos, add_included=True).collect()}
    assert more - want == {("r", "Dockerfile", "https://h/r/blob/s1/Dockerfile")}
    assert {r[0] for r in M.with_repo_columns(repos.withColumn("path", F.lit("p"))).select("repo_name").collect()} == {"r", "q"}


def test_url_path(spark):
    urls = {"https://h.org/a/b.html?x=1#y": "h.org/a/b.html", "http://h.org/a/#t": "h.org/a/", "h.org": "h.org"}
    df = spark.createDataFrame([(u,) for u in urls], "path string")
    assert column(df, P.url_path(F.col("path"))) == urls
