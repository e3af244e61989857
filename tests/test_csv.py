import pandas as pd
import pytest

from millrace.operators.dedup import dedup_rows
from millrace.plans.flows import csv_to_table
from millrace.sources.delimited import cast_columns, infer_types, scan_csv

MESSY = '''a,b,c
1,x,2.5
1,x,2.5
2,y
3,z,1,EXTRA
4,t,1,
7,u,1,,
5,"q ""d"" ,
nl",NA
8,"p, q"
6,,

9,"x, y",3,"e, f"
'''


@pytest.fixture
def messy(tmp_path):
    path = tmp_path / "messy.csv"
    path.write_text(MESSY)
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def none(value):
    return None if pd.isna(value) else value


def test_keeps_what_a_data_frame_reader_keeps(spark, messy):
    got = rows(cast_columns(scan_csv(spark, messy), {"a": "int", "c": "double"}).na.fill({"b": "", "c": -1.0}))
    want = pd.read_csv(messy, on_bad_lines="skip")
    assert got == sorted((int(a), none(b) or "", -1.0 if none(c) is None else c) for a, b, c in want.itertuples(index=False))
    assert len(got) == 6


def test_dedup_leaves_five(spark, messy):
    assert dedup_rows(scan_csv(spark, messy)).count() == 5


@pytest.mark.parametrize("multi_line", [True, False])
def test_counts_and_single_columns_are_right(spark, tmp_path, multi_line):
    path = tmp_path / "flat.csv"
    path.write_text("a,b,c\n1,x,2\n2,y\n3,z,1,EXTRA\n4,t,1,\n5,,\n")
    df = scan_csv(spark, str(path), multi_line=multi_line)
    assert df.count() == 3
    assert [r["a"] for r in df.select("a").orderBy("a").collect()] == ["1", "2", "5"]
    assert df.where("b = 'y'").select("c").collect()[0]["c"] is None


def test_count_of_the_messy_file(spark, messy):
    assert scan_csv(spark, messy).count() == 6


def test_given_columns_and_error_mode(spark, messy):
    assert scan_csv(spark, messy, ["x", "y", "z"]).columns == ["x", "y", "z"]
    with pytest.raises(Exception, match="too many fields"):
        scan_csv(spark, messy, on_bad_lines="error").collect()
    with pytest.raises(ValueError):
        scan_csv(spark, messy, on_bad_lines="warn")


def test_infers_types_like_a_data_frame_reader(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,f,holes,flag,mixed,none,big\n1,1.5,1,True,1,NA,9223372036854775808\n-2,1e3,,False,x,,1\n")
    df = scan_csv(spark, str(path), infer=True)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert kinds == {
        "i": "bigint", "f": "double", "holes": "double", "flag": "boolean", "mixed": "string", "none": "double", "big": "double",
    }
    want = pd.read_csv(path)
    assert [r["f"] for r in df.collect()] == want["f"].tolist()
    assert infer_types(scan_csv(spark, str(path)))["i"] == "bigint"


def test_long_quoted_field_on_a_long_line(spark, tmp_path):
    path = tmp_path / "long.csv"
    body = 'word ""q"", ' * 20000
    path.write_text(f'a,b\n"{body}",1\n"{body}",1,2\n')
    assert [len(r["a"]) for r in scan_csv(spark, str(path)).collect()] == [len(body.replace('""', '"'))]


def test_single_line_mode_splits_files(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n" + "".join(f"{i},{i % 3}\n" for i in range(5000)) + "1,2,3\n")
    df = scan_csv(spark, str(path), multi_line=False)
    assert df.count() == 5000


def test_csv_to_table(spark, messy, tmp_path):
    out = csv_to_table(spark, messy, str(tmp_path / "out"), infer=True)
    assert out.count() == 5
    assert dict(out.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
