"""Running numbers and nearest times keep rows without a key or a time."""

from datetime import datetime

from pyspark.sql import functions as F

from sluice.operators.dictionary_build import master_rows
from sluice.operators.ranking import nearest_times, running_number


def test_running_number_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 1), ("a", 5), ("b", None)], "k string, v int")
    got = running_number(df, ["k"], F.col("v") % 2, [F.col("v")])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", 1, 1), ("a", 5, 2), (None, 2, 1), (None, 1, 2), ("b", None, 1)], key=str)


def test_nearest_times_keeps_null_keys_and_times(spark):
    at = lambda d: datetime(2026, 2, d, 9)
    left = spark.createDataFrame([("a", at(4)), ("a", None), (None, at(4))], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", at(2)), ("a", at(7)), ("a", None), (None, at(3))], "k string, u timestamp_ntz")
    got = nearest_times(left, right, ["k"], "t", "u")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", at(4), at(2), at(7)), ("a", None, None, None), (None, at(4), None, None)], key=str)


def test_datasets_without_a_place_come_last(spark):
    rows = spark.createDataFrame([("X", "weight", d, 1, 1, d) for d in ("other", "late", "early")],
                                 "country string, variable_name string, dataset string, screen_idx int, field_idx int, question_key string")
    assert [r["dataset"] for r in master_rows(rows, ["early", "late"]).collect()] == ["early"]
    assert [r["dataset"] for r in master_rows(rows.where("dataset != 'early'"), ["early", "late"]).collect()] == ["late"]
