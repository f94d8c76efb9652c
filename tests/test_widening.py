from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T
from util import plan, rows

from acreage.sources.widening import NotWider, common_layout, read_widened, widest
from acreage.sources.writers import Lake


def kind(text):
    return T.DataType.fromDDL(text)


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"), ("tinyint", "double", "double"), ("float", "int", "double"), ("float", "double", "double"),
        ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("decimal(9,2)", "decimal(5,4)", "decimal(11,4)"),
        ("int", "decimal(5,2)", "decimal(12,2)"), ("void", "string", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<a:int,b:string>", "struct<a:double,c:date>", "struct<a:double,b:string,c:date>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
    ],
)
def test_the_wider_type(spark, a, b, want):
    assert sorted(widest(kind(a), kind(b), "c").simpleString()) == sorted(widest(kind(b), kind(a), "c").simpleString())
    assert widest(kind(a), kind(b), "c").simpleString() == want


@pytest.mark.parametrize("a, b", [("int", "string"), ("date", "int"), ("timestamp", "timestamp_ntz"), ("boolean", "int"), ("decimal(38,0)", "decimal(38,10)")])
def test_what_has_no_common_type_fails_with_the_column(spark, a, b):
    layouts = [T.StructType([T.StructField("price", kind(t))]) for t in (a, b)]
    with pytest.raises(NotWider, match="price"):
        common_layout(layouts)


def batches(spark, lake):
    for rows_of, ddl in (
        ([(1, 2, date(2020, 1, 1), Decimal("1.5"))], "k int, n int, d date, p decimal(5,1)"),
        ([(2, 2**40, date(2020, 1, 2), Decimal("1.25"))], "k int, n bigint, d date, p decimal(5,2)"),
        ([(3, 0.5, datetime(2020, 1, 3, 4, 5), None, "x")], "k int, n double, d timestamp, p decimal(5,2), more string"),
    ):
        df = spark.createDataFrame(rows_of, ddl)
        lake.append("t", df, df.schema, {"etl_nr": df.first()["k"]})


def test_batches_are_one_table_and_filters_reach_each_scan(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.read_widened("t", T.StructType([T.StructField("k", T.IntegerType())])).isEmpty()
    batches(spark, lake)
    table = lake.read_widened("t")
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [
        ("k", "int"), ("n", "double"), ("d", "timestamp"), ("p", "decimal(6,2)"), ("more", "string"),
    ]
    assert rows(table) == {
        (1, 2.0, datetime(2020, 1, 1), Decimal("1.50"), None): 1,
        (2, float(2**40), datetime(2020, 1, 2), Decimal("1.25"), None): 1,
        (3, 0.5, datetime(2020, 1, 3, 4, 5), None, "x"): 1,
    }
    text = plan(table.where("k = 2").select("n"))
    assert text.count("EqualTo(k,2)") == 3 and "p#" not in text.split("ReadSchema")[1]


def test_a_narrowing_fails_with_the_column(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    batches(spark, lake)
    wanted = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])
    with pytest.raises(NotWider, match="column n of .*batch=000003"):
        lake.read_widened("t", wanted)
    # What is not wanted may have any type, and a wider type than any batch has is fine.
    assert dict(lake.read_widened("t", T.StructType([T.StructField("k", T.LongType())])).dtypes) == {"k": "bigint"}
    assert read_widened(spark, [], wanted).isEmpty()
