"""Hypothesis tests and linear regression on the line table."""

import math

from pyspark.sql import functions as F

from tessera.operators import hypothesis, regression
from tessera.plans.registry import query, rounded
from tessera.session import load

X, Y = "l_quantity", "l_extendedprice"


def lines(spark, d):
    return load(spark, d, "lineitem")


@query("chi_square_independence", """
with c as (select l_returnflag as a, l_linestatus as b, count(*) as o from lineitem group by 1, 2),
e as (select o, sum(o) over (partition by a) * sum(o) over (partition by b) / sum(o) over () as e from c)
select round(sum((o - e) ** 2 / e), 6) as statistic,
  (select (count(distinct a) - 1) * (count(distinct b) - 1) from c) as df from e""")
def chi_square_independence(spark, d):
    return rounded(hypothesis.chi_square(lines(spark, d), "l_returnflag", "l_linestatus"))


@query("one_sample_t", f"""
select count({X}) as n, round(avg({X}), 6) as mean, round((avg({X}) - 25) / (stddev_samp({X}) / sqrt(count({X}))), 6) as t,
  cast(count({X}) - 1 as double) as df, round(stddev_samp({X}) / sqrt(count({X})), 6) as standard_error from lineitem""")
def one_sample_t(spark, d):
    return rounded(hypothesis.t_one_sample(lines(spark, d), X, 25.0))


@query("welch_t", f"""
with g as (select l_linestatus, avg({Y}) as m, var_samp({Y}) / count(*) as s, count(*) as n from lineitem group by 1),
a as (select * from g where l_linestatus = 'F'), b as (select * from g where l_linestatus = 'O')
select round(a.m, 6) as mean_a, round(b.m, 6) as mean_b, round((a.m - b.m) / sqrt(a.s + b.s), 6) as t,
  round((a.s + b.s) ** 2 / (a.s ** 2 / (a.n - 1) + b.s ** 2 / (b.n - 1)), 4) as df,
  round(sqrt(a.s + b.s), 6) as standard_error from a, b""")
def welch_t(spark, d):
    out = rounded(hypothesis.t_welch(lines(spark, d), Y, "l_linestatus"))
    return out.withColumn("df", F.round("df", 4))


def _t_tail(name: str) -> str:
    """Two-sided p-value of ``t`` and ``df`` in a one-row table, by Simpson's rule on the density up to 12."""
    return f"""(select 1 - 2 * sum(case when i in (0, 4000) then 1 when i % 2 = 1 then 4 else 2 end
  * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi() * df) * (1 + (w * i) ** 2 / df) ** (-(df + 1) / 2)) * any_value(w) / 3
  from (select i, df, least(abs(t), 12) / 4000 as w from {name}, range(0, 4001) as r(i)))"""


@query("test_p_values", f"""
with one as (select (avg({X}) - 25) / (stddev_samp({X}) / sqrt(count({X}))) as t, cast(count({X}) - 1 as double) as df from lineitem),
g as (select l_linestatus, avg({Y}) as m, var_samp({Y}) / count(*) as s, count(*) as n from lineitem group by 1),
two as (select (a.m - b.m) / sqrt(a.s + b.s) as t, (a.s + b.s) ** 2 / (a.s ** 2 / (a.n - 1) + b.s ** 2 / (b.n - 1)) as df
  from (select * from g where l_linestatus = 'F') a, (select * from g where l_linestatus = 'O') b),
c as (select l_returnflag as a, l_linestatus as b, count(*) as o from lineitem group by 1, 2),
e as (select o, sum(o) over (partition by a) * sum(o) over (partition by b) / sum(o) over () as e from c)
select 'one_sample' as test, round({_t_tail("one")}, 6) as p_value
union all select 'welch', round({_t_tail("two")}, 6)
union all select 'chi_square', round((select exp(-sum((o - e) ** 2 / e) / 2) from e), 6)""")
def test_p_values(spark, d):
    """Three by two classes leave two degrees of freedom, whose upper tail is exp(-x / 2)."""
    data = lines(spark, d)
    one = hypothesis.with_t_p_value(hypothesis.t_one_sample(data, X, 25.0), "mean")
    two = hypothesis.with_t_p_value(hypothesis.t_welch(data, Y, "l_linestatus"), ("mean_a", "mean_b"))
    chi = hypothesis.with_chi_square_p_value(hypothesis.chi_square(data, "l_returnflag", "l_linestatus"))
    return rounded(one.select(F.lit("one_sample").alias("test"), "p_value")
                   .unionByName(two.select(F.lit("welch").alias("test"), "p_value"))
                   .unionByName(chi.select(F.lit("chi_square").alias("test"), "p_value")))


@query("normality_shape", """
with m as (select avg(value) as m, stddev_pop(value) as s from events),
k as (select count(*) as n, avg((value - m) ** 3) / any_value(s) ** 3 as skewness, avg((value - m) ** 4) / any_value(s) ** 4 - 3 as kurtosis
  from events, m)
select n, round(skewness, 6) as skewness, round(kurtosis, 6) as kurtosis,
  round(n / 6 * (skewness ** 2 + kurtosis ** 2 / 4), 2) as jarque_bera from k""")
def normality_shape(spark, d):
    out = rounded(hypothesis.shape(load(spark, d, "events"), "value"))
    return out.withColumn("jarque_bera", F.round("jarque_bera", 2))


@query("shapiro_wilk", f"""
with r as (select value as x, row_number() over (order by value, event_id) as i, count(*) over () as n from events),
q as (select *, {hypothesis.normal_quantile_sql('((i - 375e-3) / (n + 25e-2))')} as m from r),
s as (select sum(m * m) as mm, max(m) filter (where i = n) as m1, max(m) filter (where i = n - 1) as m2, 1 / sqrt(any_value(n)) as u from q),
w as (select *, m1 / sqrt(mm) + 0.221157 * u - 0.147981 * u**2 - 2.071190 * u**3 + 4.434685 * u**4 - 2.706056 * u**5 as a1,
  m2 / sqrt(mm) + 0.042981 * u - 0.293762 * u**2 - 1.752461 * u**3 + 5.682633 * u**4 - 3.582633 * u**5 as a2 from s),
f as (select *, (mm - 2 * m1**2 - 2 * m2**2) / (1 - 2 * a1**2 - 2 * a2**2) as f from w)
select any_value(n) as n, round(sum(x * case when i = n then a1 when i = n - 1 then a2 when i = 1 then -a1 when i = 2 then -a2
  else m / sqrt(f) end) ** 2 / (var_pop(x) * any_value(n)), 6) as w from q, f""")
def shapiro_wilk(spark, d):
    return rounded(hypothesis.shapiro_wilk(load(spark, d, "events"), "value", "event_id").select("n", "w"))


def simple_fit(spark, d):
    return regression.moments(lines(spark, d), F.col(Y), {X: F.col(X)}).fit()


BASE = f"""b as (select regr_slope({Y}, {X}) as slope, regr_intercept({Y}, {X}) as start, regr_sxx({Y}, {X}) as sxx,
  regr_syy({Y}, {X}) as syy, regr_avgx({Y}, {X}) as mx, cast(count(*) as double) as n, regr_r2({Y}, {X}) as r2 from lineitem),
s as (select *, syy * (1 - r2) as rss, syy * (1 - r2) / (n - 2) as v from b)"""
ROWS = f"""e as (select {X}, {Y}, start + slope * {X} as predicted, {Y} - start - slope * {X} as residual,
  1 / n + ({X} - mx) ** 2 / sxx as leverage, rss, v, n from lineitem, s)"""


@query("simple_regression", f"""with {BASE}
select '(intercept)' as term, round(start, 4) as estimate, round(sqrt(v * (1 / n + mx ** 2 / sxx)), 4) as standard_error,
  round(start / sqrt(v * (1 / n + mx ** 2 / sxx)), 4) as t from s
union all select '{X}', round(slope, 4), round(sqrt(v / sxx), 4), round(slope / sqrt(v / sxx), 4) from s""")
def simple_regression(spark, d):
    return rounded(simple_fit(spark, d).table(spark).drop("p_value"), 4)


@query("regression_summary", f"""with {BASE}
select cast(n as bigint) as n, round(r2, 6) as r2, round(1 - (rss / (n - 2)) / (syy / (n - 1)), 6) as adjusted_r2,
  round(n * (ln(2 * pi()) + ln(rss / n) + 1) + 2 * 3, 3) as aic, round(n * (ln(2 * pi()) + ln(rss / n) + 1) + ln(n) * 3, 3) as bic from s""")
def regression_summary(spark, d):
    out = simple_fit(spark, d).summary(spark).select("n", "r2", "adjusted_r2", "aic", "bic")
    return out.select("n", F.round("r2", 6).alias("r2"), F.round("adjusted_r2", 6).alias("adjusted_r2"),
                      F.round("aic", 3).alias("aic"), F.round("bic", 3).alias("bic"))


def _two_terms(first, second):
    """Closed form of a regression on two terms."""
    return f"""with c as (select covar_pop({first}, {first}) as s11, covar_pop({second}, {second}) as s22,
  covar_pop({first}, {second}) as s12, covar_pop({first}, {Y}) as s1, covar_pop({second}, {Y}) as s2,
  avg({first}) as m1, avg({second}) as m2, avg({Y}) as m from lineitem),
b as (select *, (s22 * s1 - s12 * s2) / (s11 * s22 - s12 ** 2) as b1, (s11 * s2 - s12 * s1) / (s11 * s22 - s12 ** 2) as b2 from c)
select '(intercept)' as term, round(m - b1 * m1 - b2 * m2, 4) as estimate from b"""


@query("regression_without_terms", _two_terms(X, "l_discount") + f"""
union all select '{X}', round(b1, 4) from b union all select 'l_discount', round(b2, 4) from b""")
def regression_without_terms(spark, d):
    names = [X, "l_discount", "l_tax"]
    full = regression.moments(lines(spark, d), F.col(Y), {n: F.col(n) for n in names})
    return rounded(full.without("l_tax").table(spark).select("term", "estimate"), 4)


IS_R = "(case when l_returnflag = 'R' then 1.0::double else 0 end)"


@query("regression_with_interaction", _two_terms(X, f"({IS_R} * {X})") + f"""
union all select '{X}', round(b1, 4) from b union all select 'returned:quantity', round(b2, 4) from b""")
def regression_with_interaction(spark, d):
    returned = regression.dummies("l_returnflag", ["N", "R"])["l_returnflag=R"]
    terms = {X: F.col(X), "returned:quantity": returned * F.col(X)}
    return rounded(regression.moments(lines(spark, d), F.col(Y), terms).fit().table(spark).select("term", "estimate"), 4)


@query("quadratic_regression", _two_terms(X, f"({X} * {X})") + f"""
union all select '{X}', round(b1, 4) from b union all select 'quantity^2', round(b2, 4) from b""")
def quadratic_regression(spark, d):
    terms = {X: F.col(X), "quantity^2": F.col(X) * F.col(X)}
    return rounded(regression.moments(lines(spark, d), F.col(Y), terms).fit().table(spark).select("term", "estimate"), 4)


@query("variance_inflation", f"""
select '{X}' as term, round(1 / (1 - corr({X}, l_tax * {X}) ** 2), 6) as inflation from lineitem
union all select 'tax:quantity', round(1 / (1 - corr({X}, l_tax * {X}) ** 2), 6) from lineitem""")
def variance_inflation(spark, d):
    found = regression.moments(
        lines(spark, d), F.col(Y), {X: F.col(X), "tax:quantity": F.col("l_tax") * F.col(X)}).inflation()
    return rounded(spark.createDataFrame(list(found.items()), "term string, inflation double"))


def candidates(spark, d):
    terms = {X: F.col(X), "l_discount": F.col("l_discount"), "l_tax": F.col("l_tax"), "quantity^2": F.col(X) * F.col(X)}
    terms |= regression.dummies("l_returnflag", ["A", "N", "R"])
    return regression.moments(lines(spark, d), F.col(Y), terms)


@query("model_comparison", f"""with {BASE}
select 'quantity' as model, cast(2 as integer) as parameters, round(r2, 6) as r2,
  round(n * (ln(2 * pi()) + ln(rss / n) + 1) + 2 * 3, 3) as aic, round(n * (ln(2 * pi()) + ln(rss / n) + 1) + ln(n) * 3, 3) as bic from s
union all select 'discount', 2, round(regr_r2({Y}, l_discount), 6),
  round(count(*) * (ln(2 * pi()) + ln(regr_syy({Y}, l_discount) * (1 - regr_r2({Y}, l_discount)) / count(*)) + 1) + 2 * 3, 3),
  round(count(*) * (ln(2 * pi()) + ln(regr_syy({Y}, l_discount) * (1 - regr_r2({Y}, l_discount)) / count(*)) + 1) + ln(count(*)) * 3, 3) from lineitem""")
def model_comparison(spark, d):
    out = candidates(spark, d).compare(spark, {"quantity": [X], "discount": ["l_discount"]})
    return out.select("model", "parameters", F.round("r2", 6).alias("r2"), F.round("aic", 3).alias("aic"), F.round("bic", 3).alias("bic"))


@query("stepwise_of_two", f"""
with m as (select count(*) as n, regr_syy({Y}, {X}) as tss, corr({Y}, {X}) as a, corr({Y}, l_tax) as b, corr({X}, l_tax) as c from lineitem),
e as (select *, (a * a + b * b - 2 * a * b * c) / (1 - c * c) as ab from m),
s as (select n, unnest([
  {{'model': '', 'r2': 0.0, 'parameters': 1}}, {{'model': '{X}', 'r2': a * a, 'parameters': 2}},
  {{'model': 'l_tax', 'r2': b * b, 'parameters': 2}}, {{'model': '{X} + l_tax', 'r2': ab, 'parameters': 3}}], recursive := true), tss from e),
v as (select model, r2, parameters, n * ln(tss * (1 - r2) / n) + ln(n) * parameters as score from s),
one as (select * from v where parameters = 2 order by score limit 1),
last as (select v.* from v, one where v.parameters = 3 and v.score <= one.score
  union all select one.* from one, v where v.parameters = 3 and v.score > one.score and one.score <= (select score from v where parameters = 1)
  union all select w.* from v w, one, v where v.parameters = 3 and v.score > one.score and w.parameters = 1 and one.score > w.score)
select model, cast(parameters as integer) as parameters, round(r2, 8) as r2, round(score, 3) as score from last""")
def stepwise_of_two(spark, d):
    """Two candidate terms, so that every model the steps can reach has a closed form."""
    fit = regression.moments(lines(spark, d), F.col(Y), {X: F.col(X), "l_tax": F.col("l_tax")}).step()
    score = fit.n * math.log(fit.rss / fit.n) + math.log(fit.n) * fit.parameters
    return spark.createDataFrame(
        [(" + ".join(fit.terms), fit.parameters, round(fit.r2, 8), round(score, 3))], "model string, parameters int, r2 double, score double")


@query("stepwise_selection")
def stepwise_selection(spark, d):
    return rounded(candidates(spark, d).step().table(spark))


@query("breusch_pagan", f"""with {BASE}, {ROWS}
select round(count(*) * regr_r2(residual * residual, {X}), 4) as statistic, cast(1 as integer) as df from e""")
def breusch_pagan(spark, d):
    out = regression.breusch_pagan(lines(spark, d), simple_fit(spark, d))
    return out.select(F.round("statistic", 4).alias("statistic"), "df")


@query("durbin_watson", """
with b as (select regr_slope(o_totalprice, o_custkey) as slope, regr_intercept(o_totalprice, o_custkey) as start from orders),
e as (select o_orderkey, o_totalprice - start - slope * o_custkey as e from orders, b),
l as (select e, e - lag(e) over (order by o_orderkey) as step from e)
select round(sum(step * step) / sum(e * e), 6) as d from l""")
def durbin_watson(spark, d):
    orders = load(spark, d, "orders")
    fit = regression.moments(orders, F.col("o_totalprice"), {"o_custkey": F.col("o_custkey")}).fit()
    return rounded(regression.durbin_watson(orders, fit, ["o_orderkey"]).select("d"))


@query("durbin_watson_law", """
with b as (select regr_sxx(o_totalprice, o_custkey) as sxx, avg(o_custkey) as m, count(*) as n from orders),
z as (select o_orderkey, (o_custkey - m) / sqrt(sxx) as z, n from orders, b),
w as (select z, n, lag(z) over o as before, lead(z) over o as behind from z window o as (order by o_orderkey)),
t as (select any_value(n) as n, sum((z - before) ** 2) as a,
  sum((coalesce(z - before, 0) + coalesce(z - behind, 0)) ** 2) as b from w),
m as (select n, a, b, (2 * (n - 1) - a) / (n - 2) as mean from t)
select round(mean, 8) as mean,
  round(sqrt(2 * (2 * (3 * n - 4) - 2 * b + a * a - (2 * (n - 1) - a) * mean) / ((n - 2) * n)), 8) as sd from m""")
def durbin_watson_law(spark, d):
    """Mean and deviation of the statistic under independence."""
    orders = load(spark, d, "orders")
    fit = regression.moments(orders, F.col("o_totalprice"), {"o_custkey": F.col("o_custkey")}).fit()
    return rounded(regression.durbin_watson(orders, fit, ["o_orderkey"]).select("mean", "sd"), 8)


@query("residual_diagnostics", """
with g as (select o_orderkey, o_totalprice as y, cast(o_custkey as double) as x from orders),
f as (select regr_slope(y, x) as slope, regr_intercept(y, x) as start, regr_sxx(y, x) as sxx, regr_avgx(y, x) as mx,
  cast(count(*) as double) as n, regr_syy(y, x) * (1 - regr_r2(y, x)) as rss from g),
h as (select o_orderkey, start + slope * x as predicted, y - start - slope * x as residual, 1 / n + (x - mx) ** 2 / sxx as leverage,
  rss / (n - 2) as v, rss, n from g, f)
select o_orderkey, round(predicted, 4) as predicted, round(residual, 4) as residual, round(leverage, 8) as leverage,
  round(residual / sqrt((rss - residual ** 2 / (1 - leverage)) / (n - 3) * (1 - leverage)), 6) as studentised,
  round(residual ** 2 * leverage / (2 * v * (1 - leverage) ** 2), 8) as cook, leverage > 4 / n as high_leverage from h""")
def residual_diagnostics(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    fit = regression.moments(orders, F.col("o_totalprice"), {"o_custkey": F.col("o_custkey")}).fit()
    out = fit.diagnostics(orders).withColumn("high_leverage", F.col("leverage") > fit.leverage_threshold)
    return out.select(
        "o_orderkey", F.round("predicted", 4).alias("predicted"), F.round("residual", 4).alias("residual"),
        F.round("leverage", 8).alias("leverage"), F.round("studentised", 6).alias("studentised"),
        F.round("cook", 8).alias("cook"), "high_leverage")


@query("influential_rows", f"""with {BASE}, {ROWS}, c as (select residual ** 2 * leverage / (2 * v * (1 - leverage) ** 2) as cook from e)
select count(*) filter (where cook > 0.5) as influential, round(max(cook), 8) as largest_cook from c""")
def influential_rows(spark, d):
    out = simple_fit(spark, d).diagnostics(lines(spark, d).select(X, Y))
    return out.agg(F.count_if(F.col("cook") > 0.5).alias("influential"), F.round(F.max("cook"), 8).alias("largest_cook"))


@query("mean_filled_prediction", f"""with {BASE} select round(start + slope * mx, 4) as predicted from s""")
def mean_filled_prediction(spark, d):
    data = lines(spark, d)
    row = regression.mean_filled(data, [X], {})
    return row.select(F.round(simple_fit(spark, d).predicted(), 4).alias("predicted"))


@query("effect_curve", f"""
with v as (select {X} as x, {X} * {X} as q, l_tax as t, {Y} as y from lineitem),
s as (select count(*) as n, avg(x) as mx, avg(q) as mq, avg(y) as my, count(*) * covar_pop(x, x) as a11, count(*) * covar_pop(x, q) as a12,
  count(*) * covar_pop(x, t) as a13, count(*) * covar_pop(q, q) as a22, count(*) * covar_pop(q, t) as a23, count(*) * covar_pop(t, t) as a33,
  count(*) * covar_pop(x, y) as b1, count(*) * covar_pop(q, y) as b2, count(*) * covar_pop(t, y) as b3, count(*) * covar_pop(y, y) as yy from v),
i as (select *, a11 * (a22 * a33 - a23 ** 2) - a12 * (a12 * a33 - a13 * a23) + a13 * (a12 * a23 - a13 * a22) as det from s),
c as (select *, (a22 * a33 - a23 ** 2) / det as c11, (a13 * a23 - a12 * a33) / det as c12, (a12 * a23 - a13 * a22) / det as c13,
  (a11 * a33 - a13 ** 2) / det as c22, (a12 * a13 - a11 * a23) / det as c23, (a11 * a22 - a12 ** 2) / det as c33 from i),
k as (select *, c11 * b1 + c12 * b2 + c13 * b3 as k1, c12 * b1 + c22 * b2 + c23 * b3 as k2, c13 * b1 + c23 * b2 + c33 * b3 as k3 from c),
f as (select *, (yy - k1 * b1 - k2 * b2 - k3 * b3) / (n - 4) as variance, 1.959963984540054 as z from k),
p as (select cast(r.x as double) as x, my + k1 * (r.x - mx) + k2 * (r.x * r.x - mq) as predicted,
  sqrt(variance * (1 / n + c11 * (r.x - mx) ** 2 + 2 * c12 * (r.x - mx) * (r.x * r.x - mq) + c22 * (r.x * r.x - mq) ** 2)) as error,
  z + (z ** 3 + z) / (4 * (n - 4)) + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * (n - 4) ** 2) as reach
  from f, range(1, 51) as r(x))
select x as {X}, round(predicted, 3) as predicted, round(error, 3) as standard_error, round(predicted - error * reach, 3) as low,
  round(predicted + error * reach, 3) as high from p""")
def effect_curve(spark, d):
    """The reach of the band in SQL is the expansion of the t quantile for many degrees of freedom."""
    terms = {X: F.col(X), "quantity^2": F.col(X) * F.col(X), "l_tax": F.col("l_tax")}
    data = lines(spark, d)
    fit = regression.moments(data, F.col(Y), terms).fit()
    return rounded(regression.effect_curve(data, fit, [X, "l_tax"], X, range(1, 51)), 3)


@query("factor_effect_curve", f"""
with g as (select l_returnflag, avg({X}) as mx, avg({Y}) as my, regr_sxx({Y}, {X}) as sxx, regr_sxy({Y}, {X}) as sxy
  from lineitem group by 1),
b as (select sum(sxy) / sum(sxx) as slope from g)
select l_returnflag, cast(x as double) as {X}, round(my + slope * (x - mx), 4) as predicted
from g, b, range(1, 51) as r(x) where l_returnflag in ('A', 'R')""")
def factor_effect_curve(spark, d):
    """The curve at the baseline level and at a given one."""
    data, factors = lines(spark, d), {"l_returnflag": ["A", "N", "R"]}
    terms = {X: F.col(X), **regression.dummies("l_returnflag", factors["l_returnflag"])}
    fit = regression.moments(data, F.col(Y), terms).fit()
    curves = [
        regression.effect_curve(data, fit, [X, "l_returnflag"], X, range(1, 51), given, factors).select(
            F.lit(level).alias("l_returnflag"), X, "predicted")
        for level, given in (("A", {}), ("R", {"l_returnflag": "R"}))]
    return rounded(curves[0].unionByName(curves[1]), 4)


@query("simple_effect_curve", f"""with {BASE}
select cast(x as double) as {X}, round(start + slope * x, 4) as predicted, round(sqrt(v * (1 / n + (x - mx) ** 2 / sxx)), 4) as standard_error
from s, range(1, 51) as r(x)""")
def simple_effect_curve(spark, d):
    data = lines(spark, d)
    curve = regression.effect_curve(data, simple_fit(spark, d), [X], X, range(1, 51))
    return rounded(curve.select(X, "predicted", "standard_error"), 4)
