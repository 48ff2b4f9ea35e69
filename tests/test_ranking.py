import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from scorewatch.plans import lookup, ranking, running
from scorewatch.plans.lookup import measure
from scorewatch.plans.running import running_totals
from tests.conftest import rows_by


def sample(spark, n=400):
    """One hot group and one hot value: a third of the rows share the score 0.5."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        group = "big" if i % 4 else "small"
        score = 0.5 if rng.random() < 0.33 else (None if rng.random() < 0.05 else round(rng.random(), 2))
        rows.append((i, group, score))
    return spark.createDataFrame(rows, "id long, g string, score double").repartition(3)


def test_equal_bins_match_ntile(spark, plan):
    df = sample(spark)
    got = ranking.equal_bins(df, ["g"], "score", "id", "bin", ranking.ntile_ranks(7), 7)
    want = df.withColumn("bin", F.ntile(7).over(Window.partitionBy("g").orderBy("score", "id")))
    assert sorted(got.select("id", "bin").collect()) == sorted(want.select("id", "bin").collect())


def test_equal_bins_break_ties_by_text_keys(spark, plan):
    df = sample(spark, 150).withColumn("id", F.concat(F.lit("k"), F.col("id").cast("string")))
    got = ranking.equal_bins(df, ["g"], "score", "id", "bin", ranking.ntile_ranks(3), 3)
    want = df.withColumn("bin", F.ntile(3).over(Window.partitionBy("g").orderBy("score", "id")))
    assert sorted(got.select("id", "bin").collect()) == sorted(want.select("id", "bin").collect())


def test_the_whole_table_may_be_one_group(spark, plan):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(20)], "id long, score double")
    assert ranking.quantiles(df, [], "score", [0.5]).first()["edges"] == [2.0]
    got = ranking.equal_bins(df, [], "score", "id", "bin", ranking.ntile_ranks(3), 3)
    want = df.withColumn("bin", F.ntile(3).over(Window.partitionBy(F.lit(1)).orderBy("score", "id")))
    assert sorted(got.select("id", "bin").collect()) == sorted(want.select("id", "bin").collect())


def test_equal_bins_of_few_rows(spark, plan):
    df = spark.createDataFrame([(i, "a", float(i)) for i in range(3)], "id long, g string, score double")
    got = ranking.equal_bins(df, ["g"], "score", "id", "bin", ranking.ntile_ranks(10), 10)
    assert sorted(r["bin"] for r in got.collect()) == [1, 2, 3]


def test_equal_bins_without_tie_column_keep_their_size(spark, plan):
    df = spark.createDataFrame([(i, 1.0) for i in range(40)], "id long, score double")
    got = ranking.equal_bins(df.withColumn("g", F.lit("a")), ["g"], "score", None, "bin",
                             ranking.ntile_ranks(4), 4)
    assert [r["count"] for r in got.groupBy("bin").count().collect()] == [10] * 4


def test_quantiles_are_the_smallest_value_reaching_the_share(spark, plan):
    df = sample(spark)
    got = rows_by(ranking.quantiles(df, ["g"], "score", [0.1, 0.5, 0.7, 0.95]), "g")
    for group in ("big", "small"):
        values = sorted(r["score"] for r in df.filter(F.col("g") == group).collect()
                        if r["score"] is not None)
        n = len(values)
        want = [values[max(-(-n * p // 100), 1) - 1] for p in (10, 50, 70, 95)]
        assert got[group]["edges"] == want
        assert got[group]["group_n"] == n


def test_quantile_rank_is_exact_where_binary_fractions_are_not(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 101)], "g string, v double")
    got = ranking.quantiles(df, ["g"], "v", [0.07, 0.55, 0.29]).first()["edges"]
    assert got == [7.0, 55.0, 29.0]


def test_groups_without_values_have_no_quantiles(spark, plan):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "g string, v double")
    assert [r["g"] for r in ranking.quantiles(df, ["g"], "v", [0.5]).collect()] == ["b"]


def test_sketch_option_is_close(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1000)], "g string, v double")
    assert abs(ranking.quantiles(df, ["g"], "v", [0.5], accuracy=100).first()["edges"][0] - 500) <= 10


def test_measure_counts_groups_and_the_largest(spark):
    sizing = measure(sample(spark), ["g"])
    assert (sizing.groups, sizing.largest) == (2, 300)


def same_as_ntile(df, n_bins, tie="id"):
    got = ranking.equal_bins(df, ["g"], "score", tie, "bin", ranking.ntile_ranks(n_bins), n_bins)
    want = df.withColumn("bin", F.ntile(n_bins).over(Window.partitionBy("g").orderBy("score", tie)))
    columns = df.columns + ["bin"]
    assert (sorted(map(repr, got.select(*columns).collect()))
            == sorted(map(repr, want.select(*columns).collect())))


def test_null_ties_take_their_place_before_others(spark, plan):
    rows = [(i if i % 2 else None, "a", 0.5, i) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g string, score double, row long")
    got = ranking.equal_bins(df, ["g"], "score", "id", "bin", ranking.ntile_ranks(4), 4)
    assert sorted((r["bin"], r["count"]) for r in got.groupBy("bin").count().collect()) == [
        (b, 10) for b in (1, 2, 3, 4)]
    assert {r["bin"] for r in got.filter("id is null").collect()} == {1, 2}
    assert got.columns == [*df.columns, "bin"]


def test_scores_keep_their_own_type(spark, plan):
    # Longs that a double cannot tell apart, decimals, texts, and the places of null and NaN.
    longs = spark.createDataFrame([(i, "a", 2**53 + (i * 7) % 30) for i in range(30)], "id long, g string, score long")
    same_as_ntile(longs, 7)
    same_as_ntile(longs.withColumn("score", F.col("score").cast("decimal(38,18)") / 10**9), 4)
    same_as_ntile(longs.withColumn("score", F.concat(F.lit("common prefix "), F.col("score"))), 5)
    odd = [float("nan"), None, float("-inf"), float("inf"), -0.0, 0.0]
    same_as_ntile(spark.createDataFrame([(i, "a", odd[i % 6]) for i in range(30)], "id long, g string, score double"), 6)


def test_long_common_prefixes_of_keys(spark, plan):
    df = spark.range(20000).select(F.concat(F.lit("prefix-ten"), F.col("id")).alias("id"), F.lit("a").alias("g"),
                                   (F.col("id") % 2).alias("score"))
    if plan == "one_cell":
        same_as_ntile(df, 10)
    else:
        same_as_ntile(df.limit(300), 10)


def test_bins_of_rows_that_agree_in_everything(spark, plan):
    rows = [(1, "a", 0.5)] * 25 + [(None, "a", None)] * 10 + [(2, "b", 1.0)] * 3 + [(1, "a", 0.25)]
    df = spark.createDataFrame(rows, "id long, g string, score double").repartition(3)
    for tie in ("id", None):
        got = ranking.equal_bins(df, ["g"], "score", tie, "bin", ranking.ntile_ranks(4), 4)
        counts = {(r["g"], r["bin"]): r["count"] for r in got.groupBy("g", "bin").count().collect()}
        assert counts == {("a", b): 9 for b in (1, 2, 3, 4)} | {("b", b): 1 for b in (1, 2, 3)}
        assert got.filter("score is null and bin = 1").count() == 9


def test_bins_carry_columns_that_cannot_be_hashed(spark):
    df = spark.createDataFrame([(i % 2, {"k": i}) for i in range(12)], "score int, m map<string,int>")
    got = ranking.equal_bins(df, [], "score", None, "bin", ranking.ntile_ranks(3), 3)
    assert sorted(r["count"] for r in got.groupBy("bin").count().collect()) == [4, 4, 4]


def test_quantiles_of_texts_and_of_longs_beyond_doubles(spark, plan):
    df = spark.createDataFrame([("a", 2**53 + i, f"t{i:03d}") for i in range(101)], "g string, n long, t string")
    assert ranking.quantiles(df, ["g"], "n", [0.5, 1.0]).first()["edges"] == [2**53 + 50, 2**53 + 100]
    assert ranking.quantiles(df, ["g"], "t", [0.1, 0.9]).first()["edges"] == ["t010", "t090"]


def test_running_totals_over_cells_of_cells(spark, monkeypatch):
    monkeypatch.setattr(lookup, "CELL_ROWS", 12)
    monkeypatch.setattr(running, "DRAWN", 3)
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", None]), rng.choice([None, *range(60)]), rng.randint(0, 9)) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, v long, n long").repartition(4)
    want = df.withColumns({"x_upto": F.sum("n").over(Window.partitionBy("g").orderBy("v")),
                           "x_here": F.sum("n").over(Window.partitionBy("g", "v")),
                           "x_all": F.sum("n").over(Window.partitionBy("g"))})
    got = running_totals(df, ["g"], "v", {"x": F.col("n")}, df.count())
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_no_cell_is_long(spark, monkeypatch):
    """A group of 300,000 values: the windows see cells, and cells stay near the asked size."""
    monkeypatch.setattr(lookup, "CELL_ROWS", 5000)
    df = spark.range(300_000).select(F.lit("a").alias("g"), F.xxhash64("id").alias("v"))
    borders = running.cell_borders(df, ["g"], "v", {})
    placed = running.add_cell(df.crossJoin(F.broadcast(borders.select("_borders"))), "v", "_borders",
                              len(borders.first()["_borders"]), "_cell")
    sizes = [r["count"] for r in placed.groupBy("_cell").count().collect()]
    assert sum(sizes) == 300_000 and max(sizes) < 4 * 5000 and len(sizes) > 30
    got = ranking.quantiles(df, ["g"], "v", [0.25, 0.5]).first()["edges"]
    values = sorted(r["v"] for r in df.collect())
    assert got == [values[74_999], values[149_999]]


def test_every_window_over_a_long_group_is_by_cell(spark, monkeypatch):
    monkeypatch.setattr(lookup, "CELL_ROWS", 60)
    df = spark.createDataFrame([("a", float(i)) for i in range(200)], "g string, v double")
    got = running_totals(df, ["g"], "v", {"x": F.lit(1)}, 200)
    lines = got._jdf.queryExecution().optimizedPlan().toString().split("windowspecdefinition(")[1:]
    over_values = [spec.split(" ASC")[0] for spec in lines if ", v#" in spec.split(" ASC")[0]]
    assert over_values and all("_cell0#" in spec for spec in over_values)


def test_rows_meet_a_cut_per_halving(spark):
    """One projection that compares a row with every cut is too long for the JVM to compile."""
    got = ranking.equal_bins(sample(spark), ["g"], "score", "id", "bin", ranking.ntile_ranks(100), 100)
    longest = max(line.count("isnotnull(") + line.count(".depth") for line in
                  got._jdf.queryExecution().executedPlan().toString().split("\n") if "Project" in line)
    assert longest < 20


def test_no_generated_method_is_too_long_to_compile(spark):
    """The JVM interprets methods above 8000 bytes; the columns worked out behind the bins add to theirs."""
    rows = sample(spark).select("id", "g", "score", *[(F.col("score") * i).alias(f"c{i}") for i in range(20)])
    got = ranking.equal_bins(rows, ["g"], "score", "id", "bin", ranking.ntile_ranks(40), 40)
    got = got.withColumns({f"b{i}": F.when(F.col(f"c{i}") > 1, F.col("bin") + i).when(F.col(f"c{i}") > 0, i)
                           for i in range(20)})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = got._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) <= 8000, sizes


def test_ranks_of_unions_of_cells(spark, plan):
    # Groups overlap: "ab" holds the cells a and b, "bc" the cells b and null.
    rng = random.Random(3)
    values = [None, float("nan"), 0.5, *[round(rng.random(), 2) for _ in range(60)]]
    rows = [(rng.choice(["a", "b", None]), rng.choice(values), 1 + i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "cell string, v double, n long").repartition(3)
    table = spark.createDataFrame([("a", "ab"), ("b", "ab"), ("b", "bc"), (None, "bc"), ("d", "none")],
                                  "cell string, g string")
    whole = df.join(table, df["cell"].eqNullSafe(table["cell"])).select("g", "v", "n")
    fractions = [0.1, 0.5, 0.55, 0.999]
    got = ranking.quantiles(df, ["g"], "v", fractions, weight="n", unions=ranking.Unions(["cell"], table))
    want = ranking.quantiles(whole, ["g"], "v", fractions, weight="n", sizing=lookup.Sizing(2, 0))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert {r["g"] for r in got.collect()} == {"ab", "bc"}


def test_only_buckets_with_a_wanted_rank_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(lookup, "CELL_ROWS", 500)
    sorted_rows, sort = [], ranking._sorted_ranks
    monkeypatch.setattr(ranking, "_sorted_ranks", lambda rows, keys, value, *rest: (
        sorted_rows.append((value, rows.count())), sort(rows, keys, value, *rest))[1])
    df = spark.range(20000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"))
    got = rows_by(ranking.quantiles(df, ["g"], "v", [0.25, 0.5]), "g")
    assert sum(n for value, n in sorted_rows if value == "v") < 2000
    values = [sorted(r["v"] for r in df.filter(F.col("g") == g).collect()) for g in (0, 1)]
    assert all(got[g]["edges"] == [values[g][2499], values[g][4999]] and got[g]["upto"] == [2500, 5000]
               for g in (0, 1))
