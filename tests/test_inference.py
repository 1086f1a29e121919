"""Column types from the narrowest type that holds every value."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.sources import inference as I
from salesflow.sources.readers import read_csv


def inferred(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(3)
    return I.inferred_schema(I.type_profile(df), ["c"])["c"].dataType.simpleString()


@pytest.mark.parametrize(("values", "want"), [
    (["1", "-2", None, "007", " 5 "], "bigint"),
    (["9223372036854775807"], "bigint"),
    (["9223372036854775808", "1"], "decimal(19,0)"),
    (["1", "2.50", "-.125"], "decimal(4,3)"),
    (["12345", "0.001"], "decimal(8,3)"),
    (["0", "0.0", "000.5"], "decimal(1,1)"),
    (["0", "00.", "1."], "decimal(1,0)"),
    (["1" * 39, "2"], "double"),
    (["1" * 30, "0." + "1" * 9], "double"),
    (["1", "2.5", "1e3"], "double"),
    (["-1E-400", "+.5e+2"], "double"),
    (["2024-01-31", "1/2/2024", None], "date"),
    (["2024-01-31", "2024-02-31"], "string"),
    (["2024-01-31", "7"], "string"),
    (["1", "x"], "string"),
    (["1d", "2f"], "string"),
    (["1,5"], "string"),
    (["Infinity"], "string"),
    (["", "1"], "string"),
    ([None, None], "string"),
    ([], "string"),
])
def test_types(spark, values, want):
    assert inferred(spark, values) == want


def test_profiles_merge(spark):
    """The profile of all rows is that of its parts put together, whatever the parts."""
    rows = [(str(i), f"{i}.5" if i % 50 == 49 else str(i), None, "2024-05-01" if i % 2 else "x") for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    parts = [I.type_profile(df.where(F.col("a").cast("int") % 3 == k)) for k in range(3)]
    whole = I.type_profile(df)
    merged = I.merged_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2])).select(*whole.columns)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert I.inferred_schema(merged, df.columns).simpleString() == "struct<a:bigint,b:decimal(4,1),c:string,d:string>"


def test_one_pass(spark):
    """A single aggregate over one scan, with one row behind its shuffle."""
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    plan = I.type_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1


def test_csv_without_a_schema(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('id,amount,day,name,"odd name",none\n1,2,2024-01-05,"x, ""y""",NA,\n2,,1/6/2024,z,3,\n')
    (folder / "b.csv").write_text("id,amount,day,name,odd name,none\n3,4.75,NULL,w,1e2,\n")
    df = read_csv(spark, str(folder), infer=True)
    assert df.schema.simpleString() == "struct<id:bigint,amount:decimal(3,2),day:date,name:string,odd name:double,none:string>"
    got = {r["id"]: (r["amount"], str(r["day"]), r["name"], r["odd name"], r["none"]) for r in df.collect()}
    assert got == {1: (Decimal("2.00"), "2024-01-05", 'x, "y"', None, None), 2: (None, "2024-01-06", "z", 3.0, None),
                   3: (Decimal("4.75"), "None", "w", 100.0, None)}
    assert isinstance(read_csv(spark, str(folder)).schema["id"].dataType, T.StringType)


def test_a_file_with_a_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount\n")
    df = read_csv(spark, str(tmp_path), infer=True)
    assert df.count() == 0 and df.schema.simpleString() == "struct<id:string,amount:string>"
