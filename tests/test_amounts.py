"""Sums of doubles against exact fractions."""

import math
import random
from fractions import Fraction

import pytest

from spanlake.functions.amounts import band, total, units

DIGITS = "CAST(x.units AS decimal(38,0))"


def summed(spark, lists):
    """The totals of lists of doubles, by bands."""
    rows = [(i, v) for i, values in enumerate(lists) for v in values]
    df = spark.createDataFrame(rows, "i int, v double")
    per_band = df.selectExpr("i", f"{band('v')} AS band", f"{units('v')} AS units").where("band IS NOT NULL")
    per_band = per_band.groupBy("i", "band").agg({"units": "sum"}).withColumnRenamed("sum(units)", "units")
    listed = per_band.groupBy("i").agg({"band": "count"}).drop("count(band)").join(
        per_band.selectExpr("i", "struct(band, units) AS b").groupBy("i").agg({"b": "collect_list"})
        .withColumnRenamed("collect_list(b)", "bands"), "i")
    made = {r.i: r.t for r in listed.selectExpr("i", f"{total('bands', DIGITS)} AS t").collect()}
    return [made.get(i, 0.0) for i in range(len(lists))]


def exact(values):
    """The double nearest to the exact sum; integer division rounds to nearest, ties to even."""
    found = sum(map(Fraction, values), Fraction(0))
    try:
        return found.numerator / found.denominator
    except OverflowError:
        return math.inf if found > 0 else -math.inf


def any_double(rng):
    return math.ldexp(rng.choice([-1, 1]) * rng.random(), rng.randint(-1080, 1000))


@pytest.mark.parametrize("seed", range(3))
def test_random_sums_are_rounded_once(spark, seed):
    rng = random.Random(seed)
    lists = []
    for _ in range(300):
        near = rng.randint(-1000, 900)
        values = [any_double(rng) for _ in range(rng.randint(0, 4))]
        values += [math.ldexp(rng.uniform(-1, 1), near + rng.randint(0, 130)) for _ in range(rng.randint(0, 6))]
        values += [-v for v in values if rng.random() < 0.4]  # cancellation
        lists.append(values)
    assert summed(spark, lists) == [exact(v) for v in lists]


def test_hard_cases(spark):
    tiny, huge = 5e-324, 1.7976931348623157e308
    lists = [
        [2.0**53, 1.0, 2.0**-60], [2.0**53, 1.0], [2.0**53, 1.0, -(2.0**-60)], [-(2.0**53), -1.0, -(2.0**-60)],
        [2.0**53 + 2, 1.0], [1.0, 2.0**-53], [1.0, 2.0**-53, tiny], [1.0, -(2.0**-54)], [1.0, -(2.0**-54), -tiny],
        [huge, huge], [huge, huge, -huge], [tiny, tiny, -tiny], [tiny], [-tiny] * 3, [2.0**-1022, -tiny],
        [1e300, 1.0, -1e300], [0.1] * 10, [0.0, -0.0], [1e16, 1.0, 1.0, -1e16], [huge, 2.0**970], [huge, 2.0**969],
    ]
    assert summed(spark, lists) == [exact(v) for v in lists]
