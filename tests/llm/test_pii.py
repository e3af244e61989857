import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.pii import check_sum, permuted_codes, permuted_pair, pseudonymised

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("pii_values", T.StringType())])


def luhn(s):
    digits = [int(c) for c in s if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def run(spark, texts, key="k"):
    rows = [(i, t, "old") for i, t in enumerate(texts)]
    return [r for r in pseudonymised(spark.createDataFrame(rows, SCHEMA), key).orderBy("doc_id").collect()]


CASES = [
    ("card", "4539578763621486", r"\d{16}"), ("card", "4539 5787 6362 1486", r"\d{4} \d{4} \d{4} \d{4}"), ("date", "1987-03-12", r"\d{4}-\d\d-\d\d"),
    ("date", "12/03/1987", r"\d\d/\d\d/\d{4}"), ("date", "12.03.1987", r"\d\d\.\d\d\.\d{4}"), ("ip", "193.7.1.22", r"\d+\.\d+\.\d+\.\d+"),
    ("phone", "+1 (743) 555-3824", r"\+1 \(\d{3}\) \d{3}-\d{4}"), ("phone", "743-555-3824", r"\d{3}-\d{3}-\d{4}"), ("ssn", "219-09-9999", r"\d{3}-\d\d-\d{4}"),
    ("email", "Jo.Doe7@mail3.example.com", r"[A-Z][a-z]\.[A-Z][a-z]{2}\d@mail3\.example\.com"), ("secret", "11acdfb36bb72224148e6160f674b4be45601bff", r"\d\d[a-f]{5}\d.*"),
]


def test_formats_stay_and_equal_values_stay_linked(spark):
    texts = [f"é. Call {v}, then ({v})!! and {v}" for _, v, _ in CASES] + [v for _, v, _ in CASES]
    got = run(spark, texts)
    for (kind, value, shape), r, alone in zip(CASES, got, got[len(CASES) :]):
        assert [x.kind for x in r.pii_values] == [kind] * 3, value
        new = r.pii_values[0].value
        assert new != value and re.fullmatch(shape, new) and r.text == f"é. Call {new}, then ({new})!! and {new}"
        assert alone.text == new
        if kind == "card":
            assert luhn(new)
        if kind == "ip":
            assert all(int(o) < 256 for o in new.split("."))
    same = [r.pii_values[0].value for r in got[:2]]
    assert same[0] == same[1].replace(" ", "")
    assert run(spark, [CASES[0][1]], key="other")[0].text != got[len(CASES)].text


def test_what_is_not_valid_stays(spark):
    texts = [
        "", None, "no numbers", "4539578763621487 12345", "Version 2.0. and 3.", "999.1.1.1 and 1.2.3.4.5", "1987-13-12 and 1850-01-01 and 31/02/1999",
        "000-12-1234", "a@b", "12345678901234567890123", "x" * 5000 + "@" + "9" * 5000,
    ]
    for t, r in zip(texts, run(spark, texts)):
        assert r.text == t and r.pii_values == []


def test_permutations_are_one_to_one(spark):
    codes = spark.range(1000).select(
        F.array_join(permuted_codes(F.array(F.floor(F.col("id") / 100), F.floor(F.col("id") / 10) % 10, F.col("id") % 10), F.array(*[F.lit(10).cast("bigint")] * 3), "k", "t"), ",").alias("c")
    )
    assert codes.distinct().count() == 1000
    days = spark.range(17 * 4297).select(permuted_pair(F.col("id") % 17, F.floor(F.col("id") / 17), (17, 4297), "k", "date").alias("p"))
    row = days.agg(F.count_distinct("p"), F.max(F.col("p")[0]), F.max(F.col("p")[1])).first()
    assert tuple(row) == (17 * 4297, 16, 4296)
    assert spark.range(1).select(check_sum(F.lit("4539578763621486")) % 10).first()[0] == 0


def test_plan_is_narrow_and_python_free(spark):
    df = pseudonymised(spark.createDataFrame([(1, "x", "y")], SCHEMA).where("doc_id > 0"), "k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert run(spark, []) == []
