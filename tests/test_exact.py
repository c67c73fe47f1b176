"""Exact half-up ratio rounding."""

from pyspark.sql import functions as F

from ludolake.functions.exact import ratio2


def test_ties_round_half_up(spark):
    df = spark.createDataFrame([(1005, 1000), (2675, 1000), (1, 3), (2, 3), (29999999, 10000000)],
                               "n long, d long")
    got = [r[0] for r in df.select(ratio2("n", "d")).collect()]
    assert got == [1.01, 2.68, 0.33, 0.67, 3.0]


def test_zero_or_null_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0), (5, None), (None, 4)], "n long, d long")
    assert [r[0] for r in df.select(ratio2("n", "d")).collect()] == [None, None, None]


def test_large_values_do_not_overflow(spark):
    df = spark.createDataFrame([(4 * 10**17, 3)], "n long, d long")
    got = df.select(ratio2(F.col("n"), F.col("d"))).first()[0]
    assert abs(got - 4 * 10**17 / 3) / got < 1e-12
