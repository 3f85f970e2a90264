"""Regular daily series, hold-out splits, differences and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tessera.session import written


def trailing_year(df: DataFrame, day: str) -> DataFrame:
    """Rows of the last year of the data, counted back from its own newest day."""
    newest = df.agg(F.max(day)).scalar()
    return df.filter(F.col(day) >= F.add_months(newest, -12))


def daily_totals(df: DataFrame, day: str, amount: Column, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(day).alias("date")).agg(F.sum(amount).alias("total_amount"))


def fill_gaps(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per day between the first and the last day of the data; missing totals are 0.

    The totals are written once; limits, keys and the join read that table.
    """
    daily = written(daily, "daily")
    if by:
        first, last = daily.agg(F.min("date")).scalar(), daily.agg(F.max("date")).scalar()
        days = F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date")
        calendar = daily.select(*by).distinct().select(*by, days)
    else:
        limits = daily.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        calendar = limits.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"))
    return calendar.join(daily, [*by, "date"], "left").fillna(0, ["total_amount"])


def regular_daily_series(df: DataFrame, day: str, amount: Column, by: Sequence[str] = ()) -> DataFrame:
    return fill_gaps(daily_totals(trailing_year(df, day), day, amount, by), by)


def future_dates(daily: DataFrame, periods: int, by: Sequence[str] = ()) -> DataFrame:
    last = daily.groupBy(*by).agg(F.max("date").alias("last"))
    return last.select(*by, F.explode(F.sequence(
        F.date_add("last", 1), F.date_add("last", periods), F.expr("interval 1 day"))).alias("date"))


def with_future_rows(daily: DataFrame, periods: int, by: Sequence[str] = ()) -> DataFrame:
    """The series followed by its future days with a total of 0."""
    zero = F.lit(0).cast(daily.schema["total_amount"].dataType).alias("total_amount")
    return daily.unionByName(future_dates(daily, periods, by).select(*by, "date", zero))


def holdout_split(daily: DataFrame, periods: int, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(all but the last ``periods`` days, the last ``periods`` days) of each series.

    The input has one row per day, so the last days are found from the newest date.
    """
    last = daily.groupBy(*by).agg(F.max("date").alias("_last"))
    joined = daily.join(last, list(by)) if by else daily.withColumn("_last", daily.agg(F.max("date")).scalar())
    late = F.col("date") > F.date_sub("_last", periods)
    return joined.filter(~late).drop("_last"), joined.filter(late).drop("_last")


def differences(daily: DataFrame, by: Sequence[str], season: int = 7) -> DataFrame:
    """First and seasonal differences. A series has one row per day, so a window holds it."""
    window = W.partitionBy(*by).orderBy("date")
    value = F.col("total_amount")
    return daily.withColumn("difference", value - F.lag(value, 1).over(window)).withColumn(
        "seasonal_difference", value - F.lag(value, season).over(window))


def seasonal_naive(daily: DataFrame, periods: int, by: Sequence[str] = (), season: int = 7) -> DataFrame:
    """Each future day repeats the value one or more whole seasons earlier."""
    last = daily.groupBy(*by).agg(F.max("date").alias("_last"))
    ahead = last.select(*by, "_last", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("_h"))
    wanted = ahead.select(
        *by, F.date_add("_last", F.col("_h")).alias("date"),
        F.date_sub(F.date_add("_last", F.col("_h")), (F.ceil(F.col("_h") / season) * season).cast("int")).alias("_source"))
    known = daily.select(*by, F.col("date").alias("_source"), F.col("total_amount").alias("predicted_sales"))
    return wanted.join(known, [*by, "_source"], "left").drop("_source")


# --- seasonal ARIMA of one short series, inside a task --------------------------------------


def _lags(x: np.ndarray, steps: Sequence[int]) -> np.ndarray:
    return np.column_stack([np.concatenate([np.zeros(k), x[:-k]]) for k in steps]) if steps else np.empty((len(x), 0))


def _seen(x: np.ndarray, coefficients: Sequence[float], step: int) -> np.ndarray:
    """The sum of ``x`` at ``step``, ``2 step``, ... earlier, weighted."""
    steps = [step * (i + 1) for i in range(len(coefficients))]
    return _lags(x, steps) @ np.asarray(coefficients, dtype=float) if steps else np.zeros(len(x))


def _half(w, shocks, other_ar, other_ma, other_step, counts, step):
    """Least squares of one pair of polynomials (plain or seasonal) while the other pair is fixed."""
    past_w = w - _seen(w, other_ar, other_step)
    past_shocks = shocks + _seen(shocks, other_ma, other_step)
    lags = [[step * (i + 1) for i in range(n)] for n in counts]
    design = np.hstack([_lags(past_w, lags[0]), _lags(past_shocks, lags[1])])
    if not design.shape[1]:
        return np.zeros(0), np.zeros(0)
    beta = np.linalg.lstsq(design, past_w - (past_shocks - shocks), rcond=None)[0]
    return beta[:counts[0]], beta[counts[0]:]


def _product(plain: np.ndarray, seasonal: np.ndarray, season: int) -> np.ndarray:
    """Coefficients by lag, from lag 0, of ``(1 + plain)(1 + seasonal)``."""
    second = np.zeros(season * len(seasonal) + 1)
    second[0], second[season::season] = 1.0, seasonal
    return np.convolve(np.concatenate([[1.0], plain]), second)


def _least_squares(w, shocks, order, season, rounds: int = 8):
    """Fit ``(1 - ar)(1 - seasonal ar) w = (1 + ma)(1 + seasonal ma) e`` by alternating least squares."""
    p, q, seasonal_p, seasonal_q = order
    ar, ma, seasonal_ar, seasonal_ma = (np.zeros(n) for n in order)
    both = p + q > 0 and seasonal_p + seasonal_q > 0
    for _ in range(rounds if both else 1):
        ar, ma = _half(w, shocks, seasonal_ar, seasonal_ma, season, (p, q), 1)
        seasonal_ar, seasonal_ma = _half(w, shocks, ar, ma, 1, (seasonal_p, seasonal_q), season)
    on_w = -_product(-ar, -seasonal_ar, season)[1:]
    on_shocks = _product(ma, seasonal_ma, season)[1:]
    residual = w - _seen(w, on_w, 1) - _seen(shocks, on_shocks, 1)
    n = len(w)
    aic = n * np.log(max(residual @ residual / n, 1e-12)) + 2 * (sum(order) + 1)
    return aic, on_w, on_shocks, residual


def seasonal_arima_forecast(
    values: np.ndarray, periods: int, season: int = 7, largest: int = 7,
) -> tuple[np.ndarray, str]:
    """Forecast with one plain and one seasonal difference, and the method used.

    Plain and seasonal polynomials are multiplied; their orders are chosen stepwise by AIC among those that leave
    degrees of freedom. Shocks come from a long autoregression, coefficients from least squares on lagged
    values and shocks. The method is ``seasonal arima``, or ``seasonal naive`` (the last season again) for a series
    with fewer than three differences or a fitted recursion that diverges.
    """
    y = np.asarray(values, dtype=float)
    naive = np.array([y[len(y) - season + h % season] if len(y) >= season else y[-1] for h in range(periods)]), "seasonal naive"
    if len(y) < season + 4:
        return naive
    once = np.diff(y)
    w = once[season:] - once[:-season]
    long_design = _lags(w, list(range(1, min(2 * season + 1, len(w) // 4) + 1)))
    shocks = w - long_design @ np.linalg.lstsq(long_design, w, rcond=None)[0] if long_design.shape[1] else w
    order = (0, 0, 0, 0)
    best = _least_squares(w, shocks, order, season)
    tried, improved = {order}, True
    while improved:
        improved = False
        for position in range(4):
            for change in (1, -1):
                candidate = tuple(o + change * (i == position) for i, o in enumerate(order))
                reach = max(candidate[0] + season * candidate[2], candidate[1] + season * candidate[3])
                if candidate in tried or min(candidate) < 0 or max(candidate) > largest or reach + sum(candidate) >= len(w) // 2:
                    continue
                tried.add(candidate)
                fit = _least_squares(w, shocks, candidate, season)
                if fit[0] < best[0] - 1e-9:
                    order, best, improved = candidate, fit, True
    _, on_w, on_shocks, residual = best
    path, errors, levels = list(w), list(residual), list(y)
    for _ in range(periods):
        step = sum(c * path[-k] for k, c in enumerate(on_w, 1)) + sum(c * errors[-k] for k, c in enumerate(on_shocks, 1))
        path.append(float(step))
        errors.append(0.0)
        levels.append(step + levels[-1] + levels[-season] - levels[-season - 1])
    out = np.array(levels[-periods:])
    reach = np.abs(y).max() * 10 + 1
    return (out, "seasonal arima") if np.isfinite(out).all() and np.abs(out).max() <= reach else naive


def forecast(daily: DataFrame, periods: int, by: Sequence[str], season: int = 7) -> DataFrame:
    """Seasonal ARIMA forecast of every series: ``by..., date, predicted_sales, method``.

    A series is at most one row per day of the trailing year, so one task can hold it;
    many series run in parallel.
    """
    by = list(by)
    schema = T.StructType([*[daily.schema[b] for b in by], T.StructField("date", T.DateType()),
                           T.StructField("predicted_sales", T.DoubleType()), T.StructField("method", T.StringType())])

    def one_series(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("date")
        predicted, method = seasonal_arima_forecast(rows["total_amount"].to_numpy(dtype=float), periods, season)
        start = pd.Timestamp(rows["date"].iloc[-1])
        out = pd.DataFrame({"date": [(start + pd.Timedelta(days=h + 1)).date() for h in range(periods)],
                            "predicted_sales": predicted, "method": method})
        for name, value in zip(by, key):
            out[name] = value
        return out[[*by, "date", "predicted_sales", "method"]]

    numeric = daily.withColumn("total_amount", F.col("total_amount").cast("double"))
    return numeric.select(*by, "date", "total_amount").groupBy(*by).applyInPandas(one_series, schema)
