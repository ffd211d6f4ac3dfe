"""Forecast error expressions. The four percentage errors differ on purpose and keep own names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.functions.numeric import ratio


def error(pred: Column, actual: Column) -> Column:
    return pred - actual


def pct_error(pred: Column, actual: Column) -> Column:
    """Percentage error where the actual is positive, else null."""
    return F.when(actual > 0, F.abs(pred - actual) / actual * 100)


def mae(pred: Column, actual: Column) -> Column:
    return F.avg(F.abs(pred - actual))


def rmse(pred: Column, actual: Column) -> Column:
    return F.sqrt(F.avg((pred - actual) * (pred - actual)))


def mape_positive(pred: Column, actual: Column) -> Column:
    """Mean percentage error over rows with actual > 0."""
    return F.avg(pct_error(pred, actual))


def mape_nonzero(pred: Column, actual: Column) -> Column:
    """Mean percentage error over rows with actual != 0; null if there is none."""
    return F.avg(F.when(actual != 0, F.abs((actual - pred) / actual) * 100))


def mape_floored(pred: Column, actual: Column, floor: float = 1e-8) -> Column:
    """Mean relative error as a fraction, with |actual| held above ``floor``."""
    return F.avg(F.abs((actual - pred) / F.greatest(F.abs(actual), F.lit(floor))))


def wape(pred: Column, actual: Column) -> Column:
    """Mean absolute error over the mean actual, in percent."""
    return ratio(F.sum(F.abs(pred - actual)), F.sum(actual)) * 100


def accuracy_from(mape: Column) -> Column:
    return F.when(mape.isNotNull(), F.greatest(F.lit(0.0), F.lit(100.0) - mape))


def r_squared(pred: Column, actual: Column) -> Column:
    """1 - SSE/SST; SST from the population variance, which avoids a second pass."""
    sse = F.sum((actual - pred) * (actual - pred))
    sst = F.var_pop(actual) * F.count(actual)
    return F.lit(1.0) - ratio(sse, sst)
