import pytest
from pyspark.sql import functions as F

from scorewatch.operators import binning
from scorewatch.spec import Bucket
from tests.conftest import rows_by

BANDS = {"calm": [1, 2], "watch": [3, 4, 5, 6], "act": [7, 8, 9]}


def scores(spark, rows):
    return spark.createDataFrame(rows, "id long, score double, ch string")


def test_dynamic_bins_cover_the_range_per_partition(spark):
    df = scores(spark, [(i, i / 30, "A" if i % 2 else "B") for i in range(30)])
    got = binning.dynamic_bins(df, "score", 5, ["ch"], "bin")
    assert got.count() == 30
    for ch in ("A", "B"):
        assert {r["bin"] for r in got.filter(F.col("ch") == ch).collect()} == {1, 2, 3, 4, 5}


def test_dynamic_bins_break_ties_by_key(spark):
    df = scores(spark, [(i, 0.5, "A") for i in range(10)])
    got = rows_by(binning.dynamic_bins(df, "score", 5, ["ch"], "bin", "id"), "id")
    assert [got[i]["bin"] for i in range(10)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_dynamic_bins_put_null_scores_first(spark):
    df = scores(spark, [(1, None, "A"), (2, 0.1, "A")])
    got = rows_by(binning.dynamic_bins(df, "score", 2, ["ch"], "bin", "id"), "id")
    assert (got[1]["bin"], got[2]["bin"]) == (1, 2)


def test_static_bins_by_baseline_edges(spark, plan):
    base = scores(spark, [(i, i / 100, "A") for i in range(1, 101)])
    df = scores(spark, [(1, -1.0, "A"), (2, 2.0, "A"), (3, None, "A"), (4, 0.5, "B"), (5, 0.2, "A"),
                        (6, 0.2001, "A")])
    got = rows_by(binning.static_bins(df, base, "score", 5, ["ch"], "sbin"), "id")
    assert {i: got[i]["sbin"] for i in got} == {1: 1, 2: 5, 3: None, 4: None, 5: 1, 6: 2}


@pytest.mark.parametrize("base", [[], [(1, None, "A")]])
def test_empty_or_null_baseline_gives_null_bins(spark, base):
    got = binning.static_bins(scores(spark, [(1, 0.5, "A")]), scores(spark, base), "score", 5, ["ch"],
                              "sbin")
    assert got.first()["sbin"] is None


def test_static_bins_need_a_baseline(spark):
    with pytest.raises(ValueError):
        binning.static_bins(scores(spark, []), None, "score", 5, ["ch"], "sbin")


def test_static_bins_keep_key_types(spark):
    df = spark.createDataFrame([(1, 0.5, 7)], "id long, score double, ch int")
    got = binning.static_bins(df, df, "score", 2, ["ch"], "sbin")
    assert dict(got.dtypes)["ch"] == "int" and got.first()["sbin"] == 1


def test_fallback_deciles_spread_over_all_bins(spark):
    df = scores(spark, [(i, i / 100, "A") for i in range(100)])
    got = binning.fallback_deciles(df, ["ch"], "score", "d")
    assert {r["d"]: r["count"] for r in got.groupBy("d").count().collect()} == {i: 10 for i in range(1, 11)}


def test_bucket_is_right_closed(spark):
    bucket = Bucket("b", "hours", (7.5, 40, 61), ("short", "part", "full", "over"))
    df = spark.createDataFrame([(1, -3.0), (2, 7.5), (3, 7.6), (4, 40.0), (5, 61.0), (6, 61.5), (7, None)],
                               "id long, hours double")
    got = rows_by(binning.with_bucket(df, bucket), "id")
    assert [got[i]["b"] for i in range(1, 8)] == ["short", "short", "part", "part", "full", "over", None]


def test_bucket_needs_one_more_label_than_boundaries():
    with pytest.raises(ValueError):
        Bucket("b", "hours", (7.5, 40), ("short", "full"))


def test_bands(spark):
    df = spark.createDataFrame([(1, 2), (2, 7), (3, 9), (4, None), (5, 11)], "id long, decile int")
    got = rows_by(binning.with_band(df, "decile", BANDS, "band"), "id")
    assert [got[i]["band"] for i in range(1, 6)] == ["calm", "act", "act", None, None]
