"""Rates, rankings, sketches and the rate model against plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmill.plans.analysis import (
    distinct_by_level,
    distinct_sketches,
    poisson_regression,
    sketch_error,
    standardised_rate,
    top_groups,
)


def test_standardised_rate(spark):
    rows = [("a", 0, 5, 1000), ("a", 0, 5, 1000), ("a", 60, 90, 3000), ("b", 0, 1, 5000), ("b", 60, 40, 500),
            ("c", 0, 0, 0), ("d", 60, 0, 10), ("d", 99, 7, 10), (None, 0, 3, 100)]
    cells = spark.createDataFrame(rows, "place string, age int, deaths int, people int")
    weights = spark.createDataFrame([(0, 70.0), (60, 30.0)], "age int, w double")
    found = {r.place: r for r in standardised_rate(cells, ["place"], "age", "deaths", "people", weights, "w", 1000).collect()}
    assert set(found) == {"a", "b", "d", None}  # c has no base, the stratum 99 no weight
    rate = (70 * 10 / 2000 + 30 * 90 / 3000) / 100 * 1000
    spread = 1.959964 * math.sqrt((70 / 2000) ** 2 * 10 + (30 / 3000) ** 2 * 90) / 100 * 1000
    assert found["a"].rate == pytest.approx(rate) and found["a"].crude == pytest.approx(20)
    assert (found["a"].low, found["a"].high) == (pytest.approx(rate - spread), pytest.approx(rate + spread))
    assert (found["d"].rate, found["d"].low, found["d"].high, found["d"].events) == (0, 0, 0, 0)
    assert found["b"].low >= 0


def test_top_groups(spark):
    draw = random.Random(1)
    rows = [(draw.choice("ab"), draw.choice("xyz"), draw.choice(["p", "q", "r", "s", None]), draw.randint(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "l0 string, l1 string, g string, n int")
    totals = Counter()
    for a, b, g, n in rows:
        for key in ((0, a, b, g), (1, a, None, g), (2, None, None, g)):
            totals[key] += n
    cells = defaultdict(list)
    for (level, a, b, g), n in totals.items():
        if n >= 15:
            cells[level, a, b].append((-n, g is None, g or "", g))
    expected = {
        (*key, rank, g, -n) for key, own in cells.items() for rank, (n, _, _, g) in enumerate(sorted(own)[:2], 1)
    }
    found = top_groups(df, ["l0", "l1"], "g", "n", "total", 2, 15)
    assert {tuple(r) for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1 or "AdaptiveSparkPlan" in plan


def test_distinct_persons_by_level(spark):
    df = spark.range(200_000).selectExpr("id % 7 AS a", "id % 3 AS b", "id % 50000 AS person")
    sketches = distinct_sketches(df, ["a", "b"], "person")
    found = distinct_by_level(sketches, ["a", "b"], "n").collect()
    exact = {r.level: {} for r in found}
    rows = [(i % 7, i % 3, i % 50_000) for i in range(200_000)]
    for a, b, person in rows:
        for level, key in ((0, (a, b)), (1, (a, None)), (3, (None, None))):
            exact[level].setdefault(key, set()).add(person)
    assert {(r.level, r.a, r.b) for r in found} == {(level, *key) for level, own in exact.items() for key in own}
    for r in found:
        number = len(exact[r.level][r.a, r.b])
        assert abs(r.n - number) <= max(1, 4 * sketch_error(14) * number)


def test_poisson_regression(spark):
    draw = np.random.default_rng(3)
    rows = []
    for a in "abc":
        for b in (1, 2):
            for _ in range(4):
                people = int(draw.integers(500, 5000))
                rate = 0.01 * {"a": 1, "b": 2, "c": 0.5}[a] * {1: 1, 2: 3}[b]
                rows.append((a, b, int(draw.poisson(people * rate)), people))
    rows += [("a", 1, 5, 0), (None, 1, 5, 5)]
    cells = spark.createDataFrame(rows, "a string, b int, d int, n int")
    fit = poisson_regression(cells, ["a", "b"], "d", "n")
    x = np.array([[1, a == "b", a == "c", b == 2] for a, b, _, n in rows if a and n], float)
    d = np.array([d for a, b, d, n in rows if a and n], float)
    n = np.array([n for a, b, d, n in rows if a and n], float)
    # The empty cell's deaths are summed with its combination, whose base is positive.
    d[0] += 5
    beta = np.zeros(4)
    beta[0] = math.log(d.sum() / n.sum())
    for _ in range(60):
        mu = n * np.exp(x @ beta)
        beta += np.linalg.solve(x.T @ (x * mu[:, None]), x.T @ (d - mu))
    assert list(fit.coefficients) == ["intercept", "a=b", "a=c", "b=2"]
    assert list(fit.coefficients.values()) == pytest.approx(beta.tolist(), abs=1e-6)
    mu = n * np.exp(x @ beta)
    errors = np.sqrt(np.diag(np.linalg.inv(x.T @ (x * mu[:, None]))))
    assert list(fit.errors.values()) == pytest.approx(errors.tolist(), rel=1e-5)
    assert fit.steps < 20
    with pytest.raises(ValueError, match="events and a base"):
        poisson_regression(cells.filter("n < 0"), ["a"], "d", "n")
