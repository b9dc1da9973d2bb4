"""Top-k, pivots, statistics, densities and profiles against numpy and pandas."""

import random
from collections import Counter
import math
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commerce_lens.operators import density, frequent, profiling, reshape, select, stats
from commerce_lens.operators.quantiles import exact_quantiles, quantile_columns
from commerce_lens.operators.reshape import CATEGORY, CITY
from tests.conftest import plan, rows

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def quantiles_of(df, probs=PROBS):
    got = exact_quantiles(df, ["g"], "v", probs).collect()
    return {(r["g"], r["prob"]): r["quantile"] for r in got}


DISTRIBUTIONS = {
    "uniform": lambda r, n: r.random(n),
    "heavy tail": lambda r, n: np.exp(r.normal(0, 20, n)),
    "hot value": lambda r, n: np.where(r.random(n) < 0.4, 3.5, r.normal(0, 1, n)),
    "few values": lambda r, n: r.integers(-4, 5, n) / 4,
    "constant": lambda r, n: np.full(n, 7.0),
    "one outlier": lambda r, n: np.append(r.random(n - 1), 1e300),
    "both signs": lambda r, n: r.normal(0, 1e9, n) * r.choice([1e-9, 1], n),
}


@pytest.mark.parametrize("name", DISTRIBUTIONS)
@pytest.mark.parametrize("in_order", [True, False])
def test_quantiles_of_distributions(spark, name, in_order):
    data = DISTRIBUTIONS[name](np.random.default_rng(1), 20_000)
    frame = spark.createDataFrame(pd.DataFrame({"g": "x", "v": data}))
    df = frame.repartitionByRange(40, "v") if in_order else frame.repartition(40)
    got = quantiles_of(df)
    for p in PROBS:
        want = np.quantile(data, p)
        assert got[("x", p)] == pytest.approx(want, rel=1e-9, abs=1e-300), p


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, width=32), min_size=1, max_size=40))
def test_quantiles_of_any_small_group(spark, data):
    df = spark.createDataFrame([("x", float(v)) for v in data] + [("x", None), (None, 1.5)], "g string, v double")
    got = quantiles_of(df, [0.25, 0.5, 0.9])
    for p in (0.25, 0.5, 0.9):
        assert got[("x", p)] == pytest.approx(float(np.quantile(data, p)), rel=1e-9, abs=1e-9)
        assert got[(None, p)] == 1.5


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 10.0, -3.5], "b": [1, 1, 1, 1, 1], "c": list("vwxyz")})
    got = {r["column"]: r for r in stats.describe(spark.createDataFrame(pdf)).collect()}
    want = pdf.describe()
    assert set(got) == {"a", "b"}
    for c in got:
        for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}.items():
            assert got[c][ours] == pytest.approx(want[c][theirs]), (c, ours)


@pytest.mark.parametrize("name", ["uniform", "few values", "constant", "hot value"])
def test_histogram_matches_numpy(spark, name):
    data = DISTRIBUTIONS[name](np.random.default_rng(2), 3000)
    counts, edges = np.histogram(data, bins=20)
    got = stats.histogram(spark.createDataFrame(pd.DataFrame({"v": data})), "v").orderBy("bin").collect()
    assert [r["count"] for r in got] == counts.tolist()
    assert [r["bin_start"] for r in got] + [got[-1]["bin_end"]] == pytest.approx(edges.tolist())


def test_histogram_edges_at_decimal_scores(spark):
    data = [x / 10 for x in range(-10, 11)] * 3
    counts, _ = np.histogram(data, bins=20)
    got = stats.histogram(spark.createDataFrame([(x,) for x in data], "v double"), "v").orderBy("bin").collect()
    assert [r["count"] for r in got] == counts.tolist()


def test_histogram_of_nothing_is_empty(frame):
    assert stats.histogram(frame("v double", (None,)), "v").count() == 0


def gaussian_1d(data, grid, cut, adjust=1.0):
    h = data.std(ddof=1) * len(data) ** -0.2 * adjust
    x = np.linspace(data.min() - cut * h, data.max() + cut * h, grid)
    z = (x[:, None] - data[None, :]) / h
    return x, np.exp(-0.5 * z * z).sum(axis=1) / (len(data) * h * math.sqrt(2 * math.pi))


@pytest.mark.parametrize("cut", [0.0, 3.0])
def test_kde_1d(spark, cut):
    data = np.random.default_rng(3).integers(-4, 5, 500) / 4
    got = density.kde_1d(spark.createDataFrame(pd.DataFrame({"v": data})), "v", cut=cut).orderBy("i").collect()
    x, d = gaussian_1d(data, 200, cut)
    assert [r["x"] for r in got] == pytest.approx(x.tolist())
    assert [r["density"] for r in got] == pytest.approx(d.tolist())
    if cut:
        assert sum(d) * (x[1] - x[0]) == pytest.approx(1, abs=0.01)


def gaussian_2d(px, py, grid, adjust):
    n = len(px)
    cov = np.cov(px, py) * (n ** (-1 / 6) * adjust) ** 2
    x = np.linspace(px.min() - 3 * math.sqrt(cov[0, 0]), px.max() + 3 * math.sqrt(cov[0, 0]), grid)
    y = np.linspace(py.min() - 3 * math.sqrt(cov[1, 1]), py.max() + 3 * math.sqrt(cov[1, 1]), grid)
    inverse = np.linalg.inv(cov)
    out = np.zeros((grid, grid))
    for a, b in zip(px, py):
        dx, dy = np.meshgrid(x - a, y - b, indexing="ij")
        out += np.exp(-0.5 * (inverse[0, 0] * dx * dx + 2 * inverse[0, 1] * dx * dy + inverse[1, 1] * dy * dy))
    return x, y, out / (n * 2 * math.pi * math.sqrt(np.linalg.det(cov)))


def test_kde_2d_and_levels(spark):
    rng = np.random.default_rng(4)
    px = rng.integers(-4, 5, 300) / 4
    py = np.clip(px * 0.5 + rng.integers(-2, 3, 300) / 4, -1, 1)
    df = spark.createDataFrame(pd.DataFrame({"a": px, "b": py}))
    grid = density.kde_2d(df, [("a", "b")], grid=40)
    x, y, want = gaussian_2d(px, py, 40, 0.5)
    cells = grid.collect()
    got = np.zeros((40, 40))
    for r in cells:
        got[r["i"], r["j"]] = r["density"]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12)
    assert got.sum() * (x[1] - x[0]) * (y[1] - y[0]) == pytest.approx(1, abs=0.02)
    levels = [r["density"] for r in density.kde_levels(grid, 10).orderBy("level").collect()]
    flat = np.sort(want.ravel())[::-1]
    mass = np.cumsum(flat) / flat.sum()
    iso = np.linspace(0.05, 1, 10)
    assert levels == pytest.approx([flat[min(np.searchsorted(mass, 1 - q), len(flat) - 1)] for q in iso])


def test_no_density_without_spread(frame):
    same = frame("a double, b double", (1.0, 2.0), (1.0, 2.0))
    assert density.kde_1d(same, ["a", "b"]).count() == 0
    assert density.kde_1d(frame("a double", (1.0,)), "a").count() == 0
    line = frame("a double, b double", *[(float(x), 2.0 * x) for x in range(9)])
    assert density.kde_2d(line, [("a", "b")], grid=5).count() == 0


def test_pair_grid_panels(frame):
    df = frame("a double, b double, c double", (1.0, 2.0, 0.0), (2.0, 1.0, 1.0), (2.0, 1.0, 1.0), (3.0, None, 1.0))
    out = density.pair_grid(df, ["a", "b", "c"])
    panels = {(r["y_column"], r["x_column"], r["panel"]) for r in out.collect()}
    assert panels == {
        ("a", "a", "diagonal"), ("b", "b", "diagonal"), ("c", "c", "diagonal"),
        ("b", "a", "scatter"), ("c", "a", "scatter"), ("c", "b", "scatter"),
    }
    assert rows(out.where("y_column = 'b' AND panel = 'scatter'"), "x", "y", "value") == [(1.0, 2.0, 1.0), (2.0, 1.0, 2.0)]


def test_box_stats(frame):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0, None]
    df = frame("g string, v double", *[("x", v) for v in values], ("y", 7.0), (None, 1.0))
    got = {r["g"]: r for r in stats.box_stats(df, "g", "v").collect()}
    data = [v for v in values if v is not None]
    q1, q2, q3 = np.quantile(data, [0.25, 0.5, 0.75])
    x = got["x"]
    assert (x["q1"], x["median"], x["q3"]) == pytest.approx((q1, q2, q3))
    assert (x["whisker_low"], x["whisker_high"], x["outliers"], x["count"]) == (1.0, 5.0, 2, 7)
    assert (got["y"]["q1"], got["y"]["outliers"]) == (7.0, 0)
    assert rows(stats.box_outliers(df, "g", "v")) == [("x", -50.0, 1), ("x", 100.0, 1)]


MATRIX = f"{CATEGORY} string, {CITY} string, s double"


def test_matrix_masks_cells_without_enough_reviews(frame):
    df = frame(
        MATRIX,
        *[("a", "x", 1.0)] * 6,
        *[("a", "y", 1.0)] * 5,
        *[("b", "x", None)] * 7,
        (None, "x", 1.0),
        ("a", None, 1.0),
        ("lonely", "far", 0.5),
    )
    cells = {(r[CATEGORY], r[CITY]): r for r in reshape.category_city_cells(df, "s", 2, min_reviews=5).collect()}
    assert cells[("a", "x")]["avg_score"] == 1.0
    assert cells[("a", "y")]["avg_score"] is None and cells[("a", "y")]["reviews_count"] == 5
    assert cells[("b", "x")]["avg_score"] is None
    assert cells[("a", "x")]["city_rank"] == 1
    wide = reshape.category_city_matrix(df, "s", 2)
    assert wide.columns == [CATEGORY, "x", "y"]
    assert [tuple(r) for r in wide.collect()] == [("a", 1.0, 1.0), ("b", None, None), ("lonely", None, None)]
    both = reshape.category_city_matrix(df, "s", 2, min_reviews=5, top_categories=1)
    assert [tuple(r) for r in both.collect()] == [("a", 1.0, None)]


def test_top_values_ties_and_nulls(frame):
    df = frame("v string", *[(x,) for x in ["c", "b", "b", "a", None, None, None, "c", "d"]])
    assert [tuple(r) for r in select.top_values(df, "v", 3).collect()] == [("b", 2), ("c", 2), ("a", 1)]
    assert rows(select.keep_top(df, "v", 2)) == [("b",), ("b",), ("c",), ("c",)]


def test_melt_then_pivot_returns_the_input(frame):
    df = frame("m int, a double, b double", (1, 0.5, None), (2, -1.0, 2.0))
    long = reshape.melt(df, ["m"], ["a", "b"], "k", "v")
    assert rows(long.groupBy("m").pivot("k", ["a", "b"]).agg(F.first("v"))) == rows(df)


def test_pivot_counts(frame):
    df = frame("a double, b double", (0.5, 1.0), (0.5, 1.0), (0.25, 1.0), (None, 1.0), (0.5, None))
    out = reshape.pivot_counts(df, "b", "a", [0.25, 0.5, 0.75])
    assert out.columns == ["b", "0.25", "0.5", "0.75"]
    assert rows(out) == [(1.0, 1, 2, None)]


def test_negative_and_sorts(frame):
    df = frame("v double", (-1.0,), (0.0,), (None,), (1.0,))
    assert rows(select.negative(df, "v")) == [(-1.0,)]
    assert [r[0] for r in select.sort_by(df, "v").collect()] == [None, -1.0, 0.0, 1.0]
    assert rows(select.dropna_subset(df, ["v"])) == [(-1.0,), (0.0,), (1.0,)]


PROFILE = pd.DataFrame(
    {"n": [0, -1, 5, 5, None, 2], "t": ["a", "bb", "bb", None, None, "é"], "k": [1, 2, 3, 4, 5, 6]}
)


def test_profile_columns(spark):
    df = spark.createDataFrame(PROFILE)
    got = {r["column"]: r for r in profiling.profile_columns(df).collect()}
    n, t = got["n"], got["t"]
    series = PROFILE["n"]
    assert (n["rows"], n["missing"], n["distinct"], n["unique"], n["zeros"], n["negatives"]) == (6, 1, 4, 3, 1, 1)
    for name, want in {"mean": series.mean(), "std": series.std(), "skew": series.skew(), "kurtosis": series.kurt(), "q05": series.quantile(0.05), "q95": series.quantile(0.95)}.items():
        assert n[name] == pytest.approx(want), name
    assert (t["missing"], t["distinct"], t["min_length"], t["max_length"], t["mean"]) == (2, 3, 1, 2, None)
    assert t["type"] == "string" and n["min_length"] is None


def test_profile_of_text_only_and_empty_tables(frame):
    empty = frame("a string")
    got = profiling.profile_columns(empty).first()
    assert (got["rows"], got["distinct"], got["missing"]) == (0, 0, 0)
    assert tuple(profiling.profile_table(empty).first()) == (0, 1, 0, 0, 0)
    assert profiling.profile_correlations(empty).count() == 0


def test_profile_table(frame):
    df = frame("a int, b string", (1, "x"), (1, "x"), (1, None), (1, None), (1, None), (2, "y"))
    assert profiling.profile_table(df).first().asDict() == {
        "rows": 6, "columns": 2, "missing_cells": 3, "duplicate_groups": 2, "duplicate_rows": 5,
    }


def test_profile_top_values(spark):
    got = rows(profiling.profile_top_values(spark.createDataFrame(PROFILE[["t"]]), 2), "rank", "value", "count")
    assert got == [(1, "bb", 2), (2, "a", 1)]


def test_profile_correlations(spark):
    got = profiling.profile_correlations(spark.createDataFrame(PROFILE)).first()
    assert got["correlation"] == pytest.approx(PROFILE["n"].corr(PROFILE["k"]))


def test_quantile_columns_names(frame):
    df = frame("g string, v double", ("x", 1.0), ("x", 3.0))
    assert rows(quantile_columns(df, ["g"], "v", {"mid": 0.5, "top": 1.0})) == [("x", 2.0, 3.0)]


def test_a_point_visits_only_the_cells_near_it(spark):
    """100,000 distinct pairs and a grid of 40,000 cells: far from 4e9 rows."""
    rng = np.random.default_rng(5)
    data = rng.multivariate_normal([0, 0], [[1, 0.6], [0.6, 2]], 100_000)
    rows = spark.createDataFrame(pd.DataFrame({"px": data[:, 0], "py": data[:, 1]})).selectExpr("'a' AS x_column", "'b' AS y_column", "px", "py")
    spread = density.pair_spread(rows, 0.5, 3.0)
    points = rows.withColumn("w", F.lit(1))
    assert density.pair_visits(points, spread, 200).count() < 100_000 * 2_000
    grid = density.kde_2d(rows.selectExpr("px AS a", "py AS b").limit(2_000), [("a", "b")], grid=60)
    assert grid.count() == 3_600 and grid.where("density IS NULL OR density < 0").count() == 0


def test_quantiles_of_many_groups_broadcast_no_group(spark):
    df = spark.range(60_000).selectExpr("id % 6000 AS g", "cast(id div 6000 AS double) AS v")
    out = exact_quantiles(df, ["g"], "v", [0.5])
    assert "hint" not in plan(out).lower() and out.count() == 6000 and out.where("quantile <> 4.5").count() == 0


def test_profiles_read_a_table_twice(spark, tmp_path):
    spark.range(1000).selectExpr("id", "cast(id % 7 AS int) AS i", "cast(id AS string) AS s", "id / 3 AS d").write.parquet(str(tmp_path / "t"))
    text = plan(profiling.profile_columns(spark.read.parquet(str(tmp_path / "t"))))
    # The counts were written while the plan was built; what is left reads them and, once, the table.
    assert len(re.findall(rf"FileScan parquet[^\n]*{tmp_path.name}", text)) == 1


def most_common_brute(values, n):
    counts = Counter(v for v in values if v is not None)
    return [(v, k) for v, k in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:n]]


@pytest.mark.parametrize("shape", ["few", "zipf", "unique", "twice", "almost unique", "empty", "null"])
def test_most_common_texts(spark, monkeypatch, shape):
    """Small sketches, so that every way is taken: proven, by digest, the lowest of those that stand once, too many equals."""
    monkeypatch.setattr(frequent, "COUNTERS", 64)
    monkeypatch.setattr(frequent, "LISTED", 16)
    monkeypatch.setattr(frequent, "MOST", 20)
    rng = random.Random(shape)
    values = {
        "few": [rng.choice("abcd") for _ in range(500)],
        "zipf": [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)],
        "unique": [f"{i:05}" for i in rng.sample(range(99999), 400)],
        "twice": [f"{i % 300:05}" for i in range(600)],
        "almost unique": [f"{i:05}" for i in range(300)] + ["hot"] * 3 + ["00007", "é"] * 2,
        "empty": [],
        "null": [None] * 5,
    }[shape]
    df = spark.createDataFrame([(v, k % 3) for k, v in enumerate(values)], "t string, k int")
    got = frequent.most_common(df, ["t", "k"], 5).collect()
    for c, own in (("t", values), ("k", [str(k % 3) for k in range(len(values))])):
        assert [(r["value"], r["count"]) for r in sorted(got, key=lambda r: r["rank"]) if r["column"] == c] == most_common_brute(own, 5)


def test_table_profiles_tell_nulls_in_different_columns_apart(frame):
    df = frame("a string, b string", ("x", None), (None, "x"), ("x", None), (None, None), ("x", "x"), ("", None))
    row = profiling.profile_table(df).first()
    assert (row["rows"], row["missing_cells"], row["duplicate_groups"], row["duplicate_rows"]) == (6, 6, 1, 2)


def test_many_repeated_rows_are_shuffled_to_their_digests(spark, monkeypatch):
    monkeypatch.setattr(profiling, "FEW", 3)
    df = spark.range(100).select((F.col("id") % 40).alias("a"), F.lit(None).cast("string").alias("b"))
    row = profiling.profile_table(df).first()
    assert tuple(row) == (100, 2, 100, 40, 100)


@pytest.mark.parametrize("few", [0, 100_000])
def test_boxes_stand_for_points_within_the_error_bound(spark, monkeypatch, few):
    monkeypatch.setattr(density, "FEW", few)
    rng = np.random.default_rng(12)
    px = np.concatenate([rng.normal(size=1500), np.full(300, 0.25)])
    py = 0.6 * px + np.concatenate([rng.normal(size=1500) * 0.7, np.full(300, 0.5)])
    df = spark.createDataFrame(pd.DataFrame({"a": px, "b": py}))
    for adjust in (0.5, 2.0):
        got = np.zeros((50, 50))
        for r in density.kde_2d(df, [("a", "b")], grid=50, bw_adjust=adjust).collect():
            got[r["i"], r["j"]] = r["density"]
        _, _, want = gaussian_2d(px, py, 50, adjust)
        cov = np.cov(px, py) * (len(px) ** (-1 / 6) * adjust) ** 2
        assert np.abs(got - want).max() < 1e-9 / (2 * math.pi * math.sqrt(np.linalg.det(cov)))
    line = [r["density"] for r in density.kde_1d(df, "a", cut=3.0).orderBy("i").collect()]
    _, want = gaussian_1d(px, 200, 3.0)
    h = px.std(ddof=1) * len(px) ** -0.2
    assert np.abs(np.array(line) - want).max() < 1e-9 / (h * math.sqrt(2 * math.pi))


def test_boxes_are_bounded_by_the_range_in_bandwidths(spark):
    df = spark.range(100_000).selectExpr("'a' AS x_column", "'b' AS y_column", "rand(1) AS px", "rand(2) AS py")
    spread = density.pair_spread(df, 0.5, 3.0)
    s = spread.first()
    most = math.prod((s[f"hi{c}"] - s[f"lo{c}"]) / math.sqrt(s[f"v{c}"]) / density.BOX + 2 for c in "xy")
    boxes = density.pair_boxes(df, spread)
    total = boxes.agg(F.count(F.lit(1)), F.sum("m_0_0")).first()
    assert total[0] < most < 100_000 and total[1] == 100_000


def test_distinct_counts_of_every_kind_of_value(spark):
    rng = random.Random(3)
    edges = [None, 0, -1, 63, 64, -64, -65, 2**31, 2**63 - 1, -(2**63)]
    data = [
        (rng.choice([None, "a", "b"]), rng.choice([*edges, *range(200)]), rng.choice([None, -128, 0, 127]), rng.choice([None, "", "x", "y"]), rng.choice([0.0, -0.0, math.nan, 1.5, None]))
        for _ in range(3000)
    ] + [("none", None, None, None, None)]
    df = spark.createDataFrame(data, "k string, n long, t byte, s string, d double").repartition(5)

    def different(rows, i):
        values = {"nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for r in rows}
        return len(values - {None})

    want = sorted(
        ((k, *[different([r for r in data if r[0] == k], i) for i in (1, 2, 3, 4)]) for k in (None, "a", "b", "none")), key=str
    )
    names = {"ns": "n", "ts": "t", "ss": "s", "ds": "d"}
    assert sorted((tuple(r) for r in reshape.distinct_counts(df, ["k"], names).collect()), key=str) == want
    assert tuple(reshape.distinct_counts(df, [], names).first()) == tuple(different(data, i) for i in (1, 2, 3, 4))
    empty = df.where("k = 'no such key'")
    assert reshape.distinct_counts(empty, ["k"], names).count() == 0 and tuple(reshape.distinct_counts(empty, [], names).first()) == (0, 0, 0, 0)


def test_moments_come_from_counted_values(spark):
    """Against pandas: constant, repeated, shifted, tiny and missing numbers; the measures read what was counted, not the table."""
    shapes = {"c": [0.1] * 40, "r": [1e6 + i % 3 for i in range(40)], "s": [1e9 + i**2 / 7 for i in range(40)], "t": [1e-160 * (i % 7) for i in range(40)]}
    data = pd.DataFrame(shapes | {"k": range(40), "e": [None] * 39 + [2.5]})
    df = spark.createDataFrame(data).selectExpr("c", "r", "s", "t", "cast(k AS int) AS k", "nullif(e, double('NaN')) AS e", "cast(NULL AS bigint) AS none")
    got = {r["column"]: r for r in profiling.profile_columns(df).collect()}
    for c in ("r", "s", "k"):
        for name, want in {"mean": data[c].mean(), "std": data[c].std(), "skew": data[c].skew(), "kurtosis": data[c].kurt()}.items():
            assert got[c][name] == pytest.approx(want, rel=1e-6, abs=1e-9), (c, name)
    assert (got["c"]["std"], got["c"]["skew"], got["c"]["kurtosis"]) == (0.0, None, None)
    assert got["t"]["mean"] == pytest.approx(data["t"].mean()) and got["t"]["std"] > 0
    assert (got["e"]["mean"], got["e"]["std"], got["e"]["missing"]) == (2.5, None, 39)
    assert (got["none"]["mean"], got["none"]["zeros"], got["none"]["distinct"], got["none"]["min"]) == (None, 0, 0, None)
    text = plan(profiling.profile_columns(df))
    assert not any(f in text for f in ("kurtosis(", "skewness(", "stddev_samp("))
