import time

from millrace.operators.context import transcript_delta
from millrace.streaming.delta import stream_delta
from millrace.streaming.run import drain, read_files
from millrace.streaming.stamp import stamp_stream


def write_turns(spark, folder, turns, n):
    df = spark.createDataFrame(turns, "k bigint, t bigint, text string")
    df.coalesce(1).write.parquet(f"{folder}/part{n}")


def test_stamp(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",)], "name string").write.parquet(str(tmp_path / "in"))
    like = spark.read.parquet(str(tmp_path / "in"))
    start = time.time()
    out = drain(stamp_stream(read_files(spark, str(tmp_path / "in"), like)), "s").collect()
    assert {r["name"] for r in out} == {"a", "b"}
    assert all(start - 1 <= float(r["timestamp"]) <= time.time() + 1 for r in out)
    assert not spark.streams.active


def test_delta_over_triggers_and_restart(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    text = "abcdefghijklmnop"
    parts = [[(k, t, text[: (t + 1) * (k + 1)]) for t in range(n * 2, n * 2 + 2) for k in range(3)] for n in range(3)]
    like = spark.createDataFrame([], "k bigint, t bigint, text string")
    # Files are taken in order of their age, one a trigger.
    for n in range(2):
        write_turns(spark, source, parts[n][::-1], n)
        time.sleep(1.1)

    def run():
        turns = read_files(spark, f"{source}/*", like, files_per_trigger=1)
        return {(r["k"], r["t"]): r["delta"] for r in stream_delta(turns, "k", "t", out=out).collect()}

    first = run()
    assert len(first) == 12
    write_turns(spark, source, parts[2], 2)
    assert len(run()) == 18
    table = spark.createDataFrame(sum(parts, []), like.schema)
    want = {(r["k"], r["t"]): r["delta"] for r in transcript_delta(table, "k", "t").collect()}
    assert run() == want


def test_delta_with_nulls_many_triggers_and_a_repeated_batch(spark, tmp_path, monkeypatch):
    import shutil

    from millrace.streaming import delta

    monkeypatch.setattr(delta, "FULL_EVERY", 3)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    like = spark.createDataFrame([], "k bigint, t bigint, text string")
    rows = []
    for n in range(7):
        part = [(k, n * 2 * 10**6 + t, None if (n + t + k) % 4 == 0 else "é😀xyz"[: (n + t) % 6]) for t in (1, 0) for k in (1, 2)]
        part += [(None, n, "n" * n)] + ([(9, n, "late" * n)] if n > 3 else [])
        rows += part
        write_turns(spark, source, part, n)
        time.sleep(0.05)
    turns = lambda: read_files(spark, f"{source}/*", like, files_per_trigger=1)
    got = sorted(map(str, stream_delta(turns(), "k", "t", out=out, block=2).collect()))
    want = transcript_delta(spark.createDataFrame(rows, like.schema).coalesce(1), "k", "t", block=2)
    assert got == sorted(map(str, want.select("k", "t", "delta").collect())) and len(got) == len(rows)
    # The last micro-batch is not marked as done: it is done again, with the same result.
    for name in ("6", ".6.crc"):
        (tmp_path / "out" / "progress" / "commits" / name).unlink()
    shutil.rmtree(tmp_path / "out" / "deltas" / "batch=6")
    assert sorted(map(str, stream_delta(turns(), "k", "t", out=out, block=2).collect())) == got


def test_the_registered_stream_is_bounded_and_has_no_python(spark):
    import inspect

    from millrace.plans import catalog

    out = catalog.QUERIES["stream_delta"](spark, "/root/testdata/sf0.001")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert "files_per_trigger" in inspect.getsource(catalog.QUERIES["stream_delta"])


def test_registered_streams_read_a_table_of_many_files_in_any_order(spark, tmp_path):
    from millrace.plans import catalog

    small = "/root/testdata/sf0.001"
    spark.read.parquet(f"{small}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    # The last turns come first, some of a conversation's turns in each file; written so that ages differ.
    for part in ("turn % 2 = 1", "turn % 4 = 0", "turn % 4 = 2"):
        turns.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "conversations.parquet"))
        time.sleep(0.05)
    for name in ("stream_delta", "stream_stamp"):
        got, want = (sorted(map(str, catalog.QUERIES[name](spark, str(folder)).collect())) for folder in (tmp_path, small))
        assert got == want and got


def test_delta_without_input_and_with_late_messages_over_restarts(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    like = spark.createDataFrame([], "k bigint, t bigint, text string")
    (tmp_path / "in" / "none").mkdir(parents=True)

    def run():
        turns = read_files(spark, f"{source}/*", like, files_per_trigger=1)
        return sorted(map(str, stream_delta(turns, "k", "t", out=out).collect()))

    assert run() == []
    rows = []
    parts = [[(1, 5, "abcdefgh"), (None, 3, "xyz")], [(1, 2, "abc"), (2, 1, "q")], [(1, None, "a"), (None, 1, "x"), (1, 9, "abcdefghij")], [(1, 7, None), (2, 2, "qr")]]
    for n, part in enumerate(parts):
        rows += part
        write_turns(spark, source, part, n)
        want = transcript_delta(spark.createDataFrame(rows, like.schema).coalesce(1), "k", "t").select("k", "t", "delta")
        want = {(r["k"], r["t"]): r["delta"] for r in want.collect()}
        if n == 3:
            # In a stream a null text counts as empty for the message after it.
            want[1, 9] = "abcdefghij"
        assert run() == sorted(str(r) for r in spark.createDataFrame([(*k, v) for k, v in want.items()], "k bigint, t bigint, delta string").collect())
