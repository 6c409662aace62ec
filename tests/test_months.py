import re

import pytest
from pyspark.sql import functions as F

from spanlake.functions.months import (
    MONTH_PATTERN,
    is_month,
    month_index,
    month_label,
    month_of,
    month_text,
    whole_number,
)

TEXTS = [
    "202001",
    "202012",
    "202013",
    "202000",
    "000001",
    "999912",
    "202001\n",
    "\t202001",
    " 202001",
    "20201",
    "2020011",
    "",
    "   ",
    "abcdef",
    "+20201",
    "٢٠٢٠٠١",
    None,
]


def test_pattern_and_index_agree_with_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    rows = df.select("t", is_month("t").alias("ok"), month_index("t").alias("i")).collect()
    pattern = re.compile(MONTH_PATTERN.replace("\\z", "\\Z"))
    for t, ok, i in rows:
        if t is None:
            assert ok is None and i is None
            continue
        assert ok == bool(pattern.search(t)), repr(t)
        assert i == (int(t[:4]) * 12 + int(t[4:]) - 1 if ok else None)


def test_text_is_the_inverse_of_index_for_all_months(spark):
    df = spark.range(0, 120_000, 1).select(F.col("id").cast("int").alias("i"))
    df = df.withColumn("t", month_text("i"))
    wrong = df.where((month_index("t") != F.col("i")) | month_index("t").isNull())
    assert wrong.count() == 0


def test_labels_and_numbers(spark):
    df = spark.sql("SELECT '202003' m, date'2020-03-31' d, 0.5D a, 1.5D b, 1234567.5D c")
    row = df.select(
        month_label("m"), month_of("d"), whole_number("a"), whole_number("b"), whole_number("c")
    ).first()
    assert tuple(row) == ("2020-03", "202003", "0", "2", "1,234,568")


@pytest.mark.parametrize("python_value", [0.5, 1.5, 2.5, 999.5, -1234.4, 0.0, 1e12])
def test_whole_number_rounds_like_python(spark, python_value):
    df = spark.createDataFrame([(python_value,)], "x double")
    assert df.select(whole_number("x")).first()[0] == f"{python_value:,.0f}"
