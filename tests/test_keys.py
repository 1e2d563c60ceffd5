from datetime import datetime

from pyspark.sql import functions as F

from roadloom.operators.keys import current_rows, is_blank, read_decimal, read_id, read_word
from roadloom.operators.skew import relay_join
from tests.conftest import rows


def test_reading_texts(spark):
    texts = ["7", " 007 ", "\t12\n", "", "  ", None, "-3", "1.0", "12a", "9" * 30, "0" * 30 + "5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(read_id(F.col("t")), is_blank(F.col("t"))).collect()]
    assert [g[0] for g in got] == [7, 7, 12, None, None, None, None, None, None, None, 5]
    assert [g[1] for g in got] == [False, False, False, True, True, True, False, False, False, False, False]
    numbers = ["1.5", " -2e1 ", ".5", "5.", "nan", "inf", "1,5", "1.2.3", "3 m", "1d", None, "", "1e999"]
    df = spark.createDataFrame([(t,) for t in numbers], "t string")
    assert [r[0] for r in df.select(read_decimal(F.col("t"))).collect()] == [1.5, -20.0, 0.5, 5.0] + [None] * 9
    df = spark.createDataFrame([(" Way ",), ("",), (None,), ("NODE",)], "t string")
    assert [r[0] for r in df.select(read_word(F.col("t"))).collect()] == ["way", None, None, "node"]


def test_current_rows(spark):
    a, b = datetime(2024, 1, 1), datetime(2024, 2, 1)
    df = spark.createDataFrame([(1, "x", a), (1, "y", b), (1, "y", b), (2, "z", None), (None, "n", a), (None, "m", b)], "k long, v string, loaded_at timestamp_ntz")
    assert rows(current_rows(df, ["k"]).select("k", "v")) == [(1, "y"), (2, "z"), (None, "m")]
    assert current_rows(df.limit(0), ["k"]).count() == 0


def test_relay_join_is_a_left_join_with_a_hot_key(spark):
    left = spark.range(1000).select(F.col("id").alias("v"), F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    left = left.union(spark.createDataFrame([(5000, None)], "v long, k long"))
    right = spark.createDataFrame([(1, "a"), (3, "b"), (77, "c")], "k long, r string")
    assert rows(relay_join(left, right, ["k"], F.col("v")).select("k", "v", "r")) == rows(left.join(right, "k", "left").select("k", "v", "r"))
