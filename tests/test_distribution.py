import bisect
import math
import random

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import drift
from scorewatch.plans import distribution, lookup
from scorewatch.plans.distribution import ks_to_reference, separation
from tests.conftest import rows_by


def frame(spark, values, g="a", m=None):
    if m is None:
        return spark.createDataFrame([(g, v) for v in values], "g string, v double")
    return spark.createDataFrame([(g, m, v) for v in values], "g string, m string, v double")


def shift(spark, base, now, bins=10):
    got = drift.population_shift(frame(spark, base), frame(spark, now, m="x"), ["g"], ["m"], "v", bins)
    return got.collect()


def brute_ks(left, right):
    points = sorted(set(left) | set(right))
    return max(abs(sum(v <= p for v in left) / len(left) - sum(v <= p for v in right) / len(right))
               for p in points)


def test_psi_of_itself_is_zero(spark):
    values = [i / 100 for i in range(100)]
    assert shift(spark, values, values)[0]["psi"] == pytest.approx(0.0, abs=1e-12)


def test_psi_by_hand(spark, plan):
    # Edge 2.0 parts the baseline 2:2 and the sample 1:3.
    row = shift(spark, [1.0, 2.0, 3.0, 4.0], [1.0, 3.0, 3.5, 9.0], 2)[0]
    want = (0.25 - 0.5) * math.log(0.25 / 0.5) + (0.75 - 0.5) * math.log(0.75 / 0.5)
    assert row["psi"] == pytest.approx(want)
    assert (row["baseline_count"], row["current_count"]) == (4, 4)
    assert row["baseline_mean"] == 2.5


def test_psi_floors_an_absent_side_and_ignores_bins_of_neither(spark):
    row = shift(spark, [1.0] * 4, [5.0] * 4, 10)[0]
    want = 2 * (1 - 1e-4) * math.log(1 / 1e-4)
    assert row["psi"] == pytest.approx(want)


def test_psi_with_an_empty_side(spark):
    assert shift(spark, [], [1.0])[0]["psi"] == 0.0
    assert shift(spark, [1.0], []) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_ks_against_one_reference_for_many_samples(spark, plan, seed):
    rng = random.Random(seed)
    base = [round(rng.gauss(0, 1), 1) for _ in range(150)]
    samples = {m: [round(rng.gauss(m / 4, 1), 1) for _ in range(60)] for m in range(3)}
    now = spark.createDataFrame([("a", str(m), v) for m, vs in samples.items() for v in vs]
                                + [("a", "0", None)], "g string, m string, v double")
    got = rows_by(ks_to_reference(frame(spark, base), now, ["g"], ["m"], "v"), "m")
    for m, values in samples.items():
        assert got[str(m)]["ks"] == pytest.approx(brute_ks(base, values))


@pytest.mark.parametrize("seed", [1, 2])
def test_ks_by_few_buckets(spark, plan, monkeypatch, seed):
    monkeypatch.setattr(distribution, "KS_BUCKETS", 6)
    monkeypatch.setattr(lookup, "CELL_ROWS", min(lookup.CELL_ROWS, 80))
    rng, odd = random.Random(seed), [float("-inf"), float("inf"), 0.0]
    base = {g: [round(rng.gauss(0, 1), 1) for _ in range(200)] + odd for g in "ab"}
    samples = {(g, m): [round(rng.gauss(m / 9, 1 + m), 1) for _ in range(80)] + odd[m:] for g in "ac" for m in range(3)}
    then = spark.createDataFrame([(g, v) for g, vs in base.items() for v in vs], "g string, v double")
    now = spark.createDataFrame([(g, str(m), v) for (g, m), vs in samples.items() for v in [*vs, None]],
                                "g string, m string, v double").repartition(3)
    got = rows_by(ks_to_reference(then, now, ["g"], ["m"], "v"), "g", "m")
    assert {k: r["ks"] for k, r in got.items()} == {
        (g, str(m)): pytest.approx(brute_ks(base[g], vs) if g in base else 0.0) for (g, m), vs in samples.items()}


def test_ks_goes_through_few_buckets_by_value(spark, monkeypatch):
    monkeypatch.setattr(lookup, "CELL_ROWS", 2000)
    monkeypatch.setattr(distribution, "KS_BUCKETS", 64)
    by_value, run = [], distribution._both_running
    monkeypatch.setattr(distribution, "_both_running", lambda counted, keys, extra, value, *most: (
        by_value.append((value, counted.count())), run(counted, keys, extra, value, *most))[1])
    low = spark.range(10000).select(F.lit("a").alias("g"), (F.col("id") / 10000).alias("v"))
    high = low.select("g", F.lit("m").alias("m"), (F.col("v") * F.col("v")).alias("v"))
    got = ks_to_reference(low, high, ["g"], ["m"], "v").first()["ks"]
    assert sum(n for value, n in by_value if value == "v") < 8000  # of 20,000 values
    values, squares = [i / 10000 for i in range(10000)], [i / 10000 * (i / 10000) for i in range(10000)]
    gaps = [abs(bisect.bisect_right(values, x) - bisect.bisect_right(squares, x)) / 10000 for x in squares]
    assert got == pytest.approx(max(gaps), abs=1e-12)


def test_ks_of_disjoint_samples_is_one(spark):
    for base, now in (([1.0, 2.0], [5.0, 6.0]), ([5.0, 6.0], [1.0, 2.0])):
        got = ks_to_reference(frame(spark, base), frame(spark, now, m="x"), ["g"], ["m"], "v")
        assert got.first()["ks"] == 1.0


def test_ks_without_a_reference_is_zero(spark):
    got = ks_to_reference(frame(spark, []), frame(spark, [1.0], m="x"), ["g"], ["m"], "v")
    assert got.first()["ks"] == 0.0


def test_separation_against_brute_force(spark, plan):
    rng = random.Random(3)
    rows = [("a", round(rng.random(), 1), int(rng.random() < 0.3)) for _ in range(120)]
    rows += [("a", None, 1), ("a", 0.4, None)]
    got = separation(spark.createDataFrame(rows, "g string, s double, y int"), ["g"], "s", "y").first()
    pairs = [(s, y) for _, s, y in rows if s is not None and y is not None]
    goods, bads = [s for s, y in pairs if y == 0], [s for s, y in pairs if y == 1]
    wins = sum((b > g) + 0.5 * (b == g) for b in bads for g in goods)
    assert got["ks"] == pytest.approx(brute_ks(goods, bads))
    assert got["gini"] == pytest.approx(2 * wins / (len(goods) * len(bads)) - 1, abs=1e-6)
    assert (got["account_count"], got["bad_count"]) == (122, len(bads) + 1)


def test_separation_of_small_or_one_sided_groups(spark):
    rows = [("few", 0.1, 0), ("few", 0.2, 1)] + [("one", i / 20, 0) for i in range(20)]
    got = rows_by(separation(spark.createDataFrame(rows, "g string, s double, y int"), ["g"], "s", "y"), "g")
    assert got["few"]["gini"] is None and got["few"]["ks"] == 1.0
    assert got["one"]["gini"] is None and got["one"]["ks"] == 0.0


def test_psi_table_lists_empty_intervals_and_counts_outside_rows(spark):
    intervals = [(0.0, 0.5), (0.5, 0.8), (0.8, 1.0)]
    got = drift.psi_table(frame(spark, [0.1, 0.2, 0.9, 1.5]), frame(spark, [0.5, 1.0, 1.0, 1.0], m="x"),
                          ["g"], ["m"], "v", intervals)
    rows = rows_by(got, "interval")
    assert set(rows) == {"0.00-0.50", "0.50-0.80", "0.80-1.00"}
    assert rows["0.00-0.50"]["baseline_pct"] == 0.5 and rows["0.00-0.50"]["compare_pct"] == 1e-4
    assert rows["0.80-1.00"]["compare_count"] == 3
    row = rows["0.80-1.00"]
    assert row["woe"] == pytest.approx(math.log(0.75 / 0.25))
    assert row["contribution"] == pytest.approx(0.5 * row["woe"])
    assert drift.psi_table(frame(spark, []), frame(spark, [0.5], m="x"), ["g"], ["m"], "v",
                           intervals).count() == 0


def test_csi_table_bins(spark):
    base = spark.createDataFrame([("a", v) for v in [1.0, 1.0, 2.0, 3.0]], "g string, f double")
    now = spark.createDataFrame([("a", "x", v) for v in [0.0, 2.0, 5.0]], "g string, m string, f double")
    got = rows_by(drift.csi_table(base, now, ["g"], ["m"], ["f"], 4), "bin_index")
    # Edges 1, 1, 2 are deduplicated; the joint range is [0, 5] and the last bin is closed.
    assert [(got[i]["min_value"], got[i]["max_value"]) for i in range(3)] == [(0, 1), (1, 2), (2, 5)]
    assert [got[i]["baseline_count"] for i in range(3)] == [0, 2, 2]
    assert [got[i]["compare_count"] for i in range(3)] == [1, 0, 2]
    assert got[0]["interval"] == "0.0000-1.0000"


def test_ks_and_gini_of_a_million_distinct_values(spark, monkeypatch):
    """Goods at even, bads at odd places of the upper half: KS and Gini are known exactly."""
    from scorewatch.plans import lookup
    monkeypatch.setattr(lookup, "CELL_ROWS", 50_000)
    n = 1_000_000
    rows = spark.range(n).select(F.lit("a").alias("g"), (F.col("id") / n).alias("v"),
                                 F.when(F.col("id") < n // 2, 0).otherwise(F.col("id") % 2).alias("bad"))
    got = separation(rows, ["g"], "v", "bad").first()
    goods, bads = n - n // 4, n // 4
    assert got["ks"] == pytest.approx((n // 2) / goods + 1 / goods, abs=1e-12)
    # A bad is above all lower goods: n/2 below the middle, and one more for every place from there.
    above = bads * (n // 2) + bads * (bads + 1) / 2
    assert got["gini"] == pytest.approx(2 * above / (goods * bads) - 1, abs=1e-6)
    low = spark.range(n).select(F.lit("a").alias("g"), (F.col("id") / n).alias("v"))
    high = low.select("g", F.lit("m").alias("m"), (F.col("v") + 0.25).alias("v"))
    assert ks_to_reference(low, high, ["g"], ["m"], "v").first()["ks"] == pytest.approx(0.25, abs=2e-6)  # sums of doubles tie or not


def test_gini_of_tied_and_of_distinct_scores(spark, plan):
    def gini(pairs):
        df = spark.createDataFrame([("a", v, b) for v, b in pairs], "g string, v double, bad int")
        return separation(df, ["g"], "v", "bad").first()["gini"]
    assert gini([(0.5, i % 2) for i in range(40)]) == 0.0
    assert gini([(i / 40, int(i >= 20)) for i in range(40)]) == 1.0
    assert gini([(i / 40, int(i < 20)) for i in range(40)]) == -1.0


def test_counts_give_the_figures_of_their_rows(spark, plan):
    rng = random.Random(4)
    base = [1000 + round(rng.gauss(0, 1), 1) for _ in range(200)]
    now = [1000 + round(rng.gauss(0.3, 2), 1) for _ in range(90)]
    rows = drift.population_shift(frame(spark, base), frame(spark, now, m="x"), ["g"], ["m"], "v", 10)
    def counted(df):
        return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    counts = drift.population_shift(counted(frame(spark, base)), counted(frame(spark, now, m="x")), ["g"], ["m"],
                                    "v", 10, weight="n")
    want, got = rows.first().asDict(), counts.first().asDict()
    assert want.keys() == got.keys()
    for name, value in want.items():
        assert got[name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), name
