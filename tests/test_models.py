"""Model formulas against series, direct integration and simulation."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loyalspan.functions import clv, gamma_gamma, mbg, pareto, registered, sqltext
from loyalspan.operators.outlook import purchase_outlook, with_purchases

MBG = {"r": 0.9, "alpha": 40.0, "a": 0.8, "b": 2.5}
PARETO = {"r": 0.9, "alpha": 40.0, "s": 0.7, "beta": 60.0}
SPEND = {"p": 3.0, "q": 4.0, "v": 60.0}
HISTORIES = [(0, 0, 0), (0, 0, 400), (0, 0, 2500), (3, 30, 40), (10, 300, 400), (49, 390, 400), (49, 2000, 2500)]


@pytest.fixture(scope="module")
def histories(spark):
    rows = [(float(x), float(t_x), float(T), 50.0) for x, t_x, T in HISTORIES]
    schema = "frequency double, recency double, T double, monetary_value double"
    return spark.createDataFrame(rows, schema).coalesce(1)


def hyp2f1(a, b, c, z):
    term = total = np.longdouble(1)
    for n in range(200_000):
        term *= (a + n) * (b + n) / ((c + n) * (n + 1)) * np.longdouble(z)
        total += term
        if abs(term) < 1e-21 * abs(total):
            break
    return total


def series_purchases(params, t, x, T):
    r, alpha, a, b = (params[k] for k in mbg.NAMES)
    z = np.longdouble(t) / (alpha + T + t)
    f = hyp2f1(a + b - r, a - 1, a + b + x, z)
    return float((a + b + x) / (a - 1) * (1 - (1 - z) ** (np.longdouble(a) - 1) * f))


@pytest.mark.parametrize(
    "params",
    [MBG, {"r": 2.5, "alpha": 5.0, "a": 0.3, "b": 0.5}, {"r": 0.3, "alpha": 60.0, "a": 1.6, "b": 2.5}],
)
@pytest.mark.parametrize("t", [30, 365, 1080])
def test_purchases_if_alive_match_the_series(histories, params, t):
    rows = histories.withColumn("h", F.expr(mbg.purchases_if_alive(params, t))).collect()
    for row in rows:
        expected = series_purchases(params, t, row["frequency"], row["T"])
        assert row["h"] == pytest.approx(expected, rel=1e-8)


def test_no_singularity_at_a_equal_one(histories):
    values = [
        histories.select(F.expr(mbg.purchases_if_alive({**MBG, "a": a}, 365)).alias("h")).collect()
        for a in (1 - 1e-7, 1.0, 1 + 1e-7)
    ]
    for low, mid, high in zip(*values):
        assert low["h"] == pytest.approx(mid["h"], rel=1e-6)
        assert high["h"] == pytest.approx(mid["h"], rel=1e-6)


def test_probability_alive_bounds_and_formula(histories):
    rows = histories.withColumn("p", F.expr(mbg.probability_alive(MBG))).collect()
    for row in rows:
        x, t_x, T = row["frequency"], row["recency"], row["T"]
        odds = 0.8 / (2.5 + x) * ((40 + T) / (40 + t_x)) ** (0.9 + x)
        assert 0 < row["p"] <= 1
        assert row["p"] == pytest.approx(1 / (1 + odds))


def test_expected_purchases_grow_with_the_horizon(histories):
    row_wise = [F.expr(mbg.expected_purchases(MBG, t)).alias(f"t{t}") for t in (30, 365, 730)]
    for row in histories.select(*row_wise).collect():
        assert 0 <= row["t30"] <= row["t365"] <= row["t730"]


def simulate_future(rng, n, window, horizon):
    """Simulate MBG customers: purchases and last purchase in a window, purchases after it."""
    rate = rng.gamma(MBG["r"], 1 / MBG["alpha"], n)
    leave = rng.beta(MBG["a"], MBG["b"], n)
    alive = rng.random(n) >= leave
    now, x, t_x, later = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    while alive.any():
        now = np.where(alive, now + rng.exponential(1 / rate), np.inf)
        inside, after = alive & (now <= window), alive & (now > window) & (now <= window + horizon)
        x[inside] += 1
        t_x[inside] = now[inside]
        later[after] += 1
        alive &= (now <= window + horizon) & (rng.random(n) >= leave)
    return x, t_x, later


def test_expected_purchases_match_simulation(spark):
    x, t_x, later = simulate_future(np.random.default_rng(5), 200_000, 200, 365)
    for count in (0, 2):
        chosen = x == count
        sample = spark.createDataFrame(
            [(float(a), float(b), 200.0) for a, b in zip(x[chosen][:4000], t_x[chosen][:4000])],
            "frequency double, recency double, T double",
        )
        expected = sample.agg(F.avg(F.expr(mbg.expected_purchases(MBG, 365)))).first()[0]
        assert expected == pytest.approx(later[chosen].mean(), rel=0.04)


def numeric_leaving_odds(x, t_x, T):
    """Direct integration over the time of leaving."""
    r, alpha, s, beta = (PARETO[k] for k in pareto.NAMES)
    if T <= t_x:
        return 0.0
    nodes, weights = np.polynomial.legendre.leggauss(30)
    edges = np.concatenate([[t_x], t_x + (T - t_x) * np.logspace(-6, 0, 200)])
    total = 0.0
    for low, high in zip(edges[:-1], edges[1:]):
        u = low + (high - low) * (nodes + 1) / 2
        log = (r + x) * np.log((alpha + T) / (alpha + u)) + s * np.log((beta + T) / (beta + u))
        total += ((high - low) / 2 * weights * np.exp(log) * s / (beta + u)).sum()
    return total


@pytest.mark.parametrize("swap", [False, True])
def test_pareto_alive_matches_direct_integration(histories, swap, monkeypatch):
    params = {**PARETO, "alpha": 60.0, "beta": 40.0} if swap else PARETO
    monkeypatch.setitem(PARETO, "alpha", params["alpha"])
    monkeypatch.setitem(PARETO, "beta", params["beta"])
    for row in histories.withColumn("p", F.expr(pareto.probability_alive(params))).collect():
        odds = numeric_leaving_odds(row["frequency"], row["recency"], row["T"])
        assert row["p"] == pytest.approx(1 / (1 + odds), rel=1e-7)


def test_pareto_purchases_near_s_equal_one(histories):
    near, at = (
        histories.select(F.expr(pareto.expected_purchases({**PARETO, "s": s}, 365)).alias("e")).collect()
        for s in (1 + 1e-8, 1.0)
    )
    for a, b in zip(near, at):
        assert a["e"] == pytest.approx(b["e"], rel=1e-6)


def test_expected_spend_between_population_and_own_mean(histories):
    rows = histories.withColumn("e", F.expr(gamma_gamma.expected_spend(SPEND))).collect()
    assert rows[0]["e"] == pytest.approx(3 * 60 / (4 - 1))
    assert 50 <= rows[-1]["e"] <= 60


def test_lifetime_value_is_the_discounted_sum(histories):
    months, rate = 12, 0.0072
    value = F.expr(clv.lifetime_value(MBG, SPEND, months, rate)).alias("value")
    steps = [F.expr(mbg.expected_purchases(MBG, 30 * i)).alias(f"e{i}") for i in range(1, months + 1)]
    spend = F.expr(gamma_gamma.expected_spend(SPEND)).alias("spend")
    for row in histories.select(value, spend, *steps).collect():
        e = [0.0] + [row[f"e{i}"] for i in range(1, months + 1)]
        total = sum((e[i] - e[i - 1]) / (1 + rate) ** i for i in range(1, months + 1))
        assert row["value"] == pytest.approx(row["spend"] * total, rel=1e-9)


def test_table_form_equals_row_form(histories):
    table = with_purchases(histories, MBG, {"h": 365}, {"d": (36, 0.01)}).select(
        "h",
        F.expr(mbg.expected_purchases(MBG, 365)).alias("row_h"),
        "d",
        F.expr(f"{mbg.probability_alive(MBG)} * {mbg.discounted_if_alive(MBG, 36, 0.01)}").alias("row_d"),
    )
    rows = table.collect()
    assert len(rows) == len(HISTORIES)
    for row in rows:
        assert row["h"] == pytest.approx(row["row_h"], rel=1e-10)
        assert row["d"] == pytest.approx(row["row_d"], rel=1e-10)


def test_outlook_has_one_row_per_pair(spark):
    pairs = spark.createDataFrame([(1.0, 100.0)] * 500 + [(2.0, 100.0)], "x double, T double")
    assert purchase_outlook(pairs, MBG, {"h": 30}).count() == 2


def test_ln_gamma(spark):
    zs = [0.05, 0.5, 1.0, 3.3, 40.0, 1e4]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for row in df.select("z", F.expr(sqltext.ln_gamma("z")).alias("g")).collect():
        assert row["g"] == pytest.approx(math.lgamma(row["z"]), rel=1e-11, abs=1e-9)


def test_registered_functions(spark, histories):
    assert set(registered.register_functions(spark, MBG, SPEND, replace=True)) == {
        "clv",
        "probability_alive",
    }
    assert registered.register_functions(spark, MBG, SPEND) == []
    histories.createOrReplaceTempView("histories")
    rows = spark.sql(
        "SELECT clv(frequency, recency, T, monetary_value, 12, 0.0072) AS value,"
        " probability_alive(frequency, recency, T) AS scores FROM histories"
    )
    assert dict(rows.dtypes) == {"value": "double", "scores": "array<float>"}
    direct = histories.select(F.expr(clv.lifetime_value(MBG, SPEND, 12, 0.0072)).alias("v")).collect()
    for row, expected in zip(rows.collect(), direct):
        assert row["value"] == pytest.approx(expected["v"], rel=1e-12)
        assert len(row["scores"]) == 4


def _purchases_by_integral(r, alpha, a, b, x, T, t):
    """With p = exp(-s): Simpson up to s = 60, and what is left in closed form."""
    s = np.linspace(1e-12, 60.0, 600_001)
    p = np.exp(-s)
    k, c = r + x, b + x + 1
    f = -np.expm1(-k * np.log1p(p * t / (alpha + T))) / p
    value = f * np.exp(-a * s + (c - 1) * np.log(-np.expm1(-s)))
    weights = np.full(len(s), 2.0)
    weights[1::2] = 4.0
    weights[[0, -1]] = 1.0
    body = (weights * value).sum() * (s[1] - s[0]) / 3
    tail = k * t / (alpha + T) * math.exp(-60.0 * a) / a
    beta = math.exp(math.lgamma(a) + math.lgamma(c) - math.lgamma(a + c))
    return (body + tail) / beta


@pytest.mark.parametrize("a", [0.8, 0.1, 0.01, 1e-4, 6.14421235e-6, 1e-9])
def test_expected_purchases_for_hardly_any_leaving(spark, a):
    params = {"r": 1.5, "alpha": 300.0, "a": a, "b": 2.5}
    for x, T, t in ((0.0, 10.0, 1080.0), (3.0, 700.0, 365.0), (40.0, 2000.0, 730.0)):
        text = mbg.purchases_if_alive(params, t, f"{x}D", f"{T}D")
        got = spark.sql(f"SELECT {text}").first()[0]
        assert got == pytest.approx(_purchases_by_integral(**params, x=x, T=T, t=t), rel=1e-8)
        if a < 1e-5:
            assert got == pytest.approx((1.5 + x) * t / (300.0 + T), rel=1e-3)


def test_no_months_are_worth_nothing(histories):
    table = with_purchases(histories, MBG, {"h": 365}, {"none": (0, 0.01), "some": (7, 0.01)})
    expected = F.expr(f"{mbg.probability_alive(MBG)} * {mbg.discounted_if_alive(MBG, 7, 0.01)}")
    for row in table.withColumn("row_some", expected).collect():
        assert row["none"] == 0
        assert row["some"] == pytest.approx(row["row_some"], rel=1e-10)


def test_code_for_many_months_stays_compilable(spark, histories):
    sizes = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for months in (12, 120):
            table = with_purchases(histories, MBG, {"h": 365}, {"d": (months, 0.01)})
            plan = table._jdf.queryExecution()
            text = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
            sizes.append(max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(sizes) < 8000  # the JVM does not compile larger methods
    assert sizes[0] == sizes[1]


def test_nobody_leaves_at_the_limit(histories):
    stay = {**MBG, "a": 0.0}
    days = {"h": 365}
    kept = F.expr(mbg.stayer_purchases(stay, 365, "frequency", "T")).alias("kept")
    row_form = F.expr(mbg.expected_purchases(stay, 365)).alias("row_h")
    rows = with_purchases(histories, stay, days, {"d": (12, 0.01)}).select("alive", "h", "d", kept, row_form)
    for row in rows.collect():
        assert row["alive"] == 1
        assert row["h"] == pytest.approx(row["kept"], rel=1e-12) == pytest.approx(row["row_h"], rel=1e-12)
        assert row["d"] > 0


def test_all_spend_alike_at_the_limit(spark):
    limit, near = {"p": 3.0, "q": math.inf, "v": 20.0}, {"p": 3.0, "q": 1e9, "v": 20e9}
    columns = spark.createDataFrame([(2.0, 10.0, 3.0, math.inf, 20.0)], "x double, m double, p double, q double, v double")
    named = {name: name for name in gamma_gamma.NAMES}
    row = columns.select(
        *[F.expr(gamma_gamma.expected_spend(params, "x", "m")) for params in (limit, near, named)]
    ).first()
    assert row[0] == row[2] == 60.0
    assert row[1] == pytest.approx(60.0, rel=1e-6)
    assert spark.sql(f"SELECT {gamma_gamma.expected_spend(limit, 'double(NULL)', '1D')}").first()[0] is None
