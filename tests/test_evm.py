"""Amounts in token units: which of them fit, and their digits."""

from decimal import Decimal, localcontext

from pyspark.sql import functions as F

from tidemark.functions import evm


def test_what_fits_token_units_is_told_by_size(spark):
    rows = [(Decimal(sign * (10 ** (20 + d) + off)), d) for d in (0, 6, 14, 17) for off in (-1, 0, 1) for sign in (1, -1)]
    rows += [(Decimal(10**38 - 1), d) for d in (17, 18, 24)] + [(None, 6), (Decimal(10**30), None)]
    amounts = spark.createDataFrame(rows, "amount DECIMAL(38,0), decimals INT")
    fits = amounts.withColumn("fits", evm.fits_scaled(F.col("amount"), F.col("decimals")))
    plan = fits._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "lpad" not in plan  # no text is made to compare two numbers
    for r in fits.collect():
        assert r.fits == (r.amount is None or r.decimals is None or abs(int(r.amount)) < 10 ** (20 + r.decimals)), r
    shown = fits.filter("fits AND decimals <= 18").withColumn("units", evm.scaled(F.col("amount"), F.col("decimals")))
    with localcontext() as exact:
        exact.prec = 60
        assert all(r.units is None or r.units * 10**r.decimals == r.amount for r in shown.collect())
