import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import keys, merge, quality, ranking, shares, streaks
from millrace.operators.asof import latest_before
from millrace.sources import files


# -- keys --------------------------------------------------------------------
def test_one_row_per_key_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", rng.randint(0, 5), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, version int, payload int").repartition(7)
    latest = {r.k: (r.version, r.payload) for r in keys.latest_per_key(df, ["k"], ["version"]).collect()}
    first = {r.k: (r.version, r.payload) for r in keys.first_per_key(df, ["k"], ["version"]).collect()}
    for k in {r[0] for r in rows}:
        mine = [(v, p) for key, v, p in rows if key == k]
        assert latest[k] == max(mine) and first[k] == min(mine)
    copies = {r.k: r.copies for r in keys.duplicate_keys(df, ["k"]).collect()}
    assert copies["hot"] == 1000


def test_key_only_table(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.k for r in keys.latest_per_key(df, ["k"], []).collect()) == [1, 2]


def test_surrogate_key_is_stable(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "x string, y int")
    ids = [r[0] for r in df.select(keys.surrogate_key("x", "y")).collect()]
    assert len(set(ids)) == 3
    assert ids == [r[0] for r in df.repartition(5).orderBy("x", "y").select(keys.surrogate_key("x", "y")).collect()]


# -- merge -------------------------------------------------------------------
SCHEMA = "k int, day date, version int, value string"
D1, D2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)


def table(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select("k", "day", "version", "value").collect())


def test_append_new_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")

    def add(rows):
        merge.append_new(spark.createDataFrame(rows, SCHEMA), path, ["k", "day"], ["day"], ["version"])

    add([(1, D1, 1, "a"), (2, D1, 1, "b")])
    add([(1, D1, 9, "late"), (3, D1, 2, "second"), (3, D1, 1, "first"), (1, D2, 1, "other day")])
    expected = [(1, D1, 1, "a"), (1, D2, 1, "other day"), (2, D1, 1, "b"), (3, D1, 1, "first")]
    assert table(spark, path) == expected
    add([(1, D1, 9, "late"), (3, D1, 2, "second")])
    assert table(spark, path) == expected


def test_upsert_takes_the_newest(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(rows):
        merge.upsert(spark.createDataFrame(rows, SCHEMA), path, ["k", "day"], ["version"], ["day"])

    put([(1, D1, 1, "a"), (2, D1, 5, "b"), (7, D2, 1, "untouched")])
    batch = [(1, D1, 2, "new"), (2, D1, 4, "stale"), (3, D1, 1, "x"), (3, D1, 2, "y")]
    for _ in range(2):
        put(batch)
        assert table(spark, path) == [(1, D1, 2, "new"), (2, D1, 5, "b"), (3, D1, 2, "y"), (7, D2, 1, "untouched")]
    put([(2, D1, 5, "same version, later batch")])
    assert (2, D1, 5, "same version, later batch") in table(spark, path)


def test_upsert_prunes_untouched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert(spark.createDataFrame([(1, D1, 1, "a"), (2, D2, 1, "b")], SCHEMA), path, ["k", "day"], ["version"], ["day"])
    before = {p.name for p in (tmp_path / "t" / "day=2026-01-02").glob("*.parquet")}
    merge.upsert(spark.createDataFrame([(1, D1, 2, "c")], SCHEMA), path, ["k", "day"], ["version"], ["day"])
    assert {p.name for p in (tmp_path / "t" / "day=2026-01-02").glob("*.parquet")} == before


def test_null_keys_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        merge.append_new(spark.createDataFrame([(None, D1, 1, "a"), (2, None, 1, "b")], SCHEMA), path, ["k", "day"], ["day"], ["version"])
        assert spark.read.schema(SCHEMA).parquet(path).count() == 2
    whole, rest = merge.split_complete(spark.read.schema(SCHEMA).parquet(path), ["k", "day"])
    assert (whole.count(), rest.count()) == (0, 2)


def test_upsert_keeps_what_lies_in_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert(spark.createDataFrame([(1, None, 1, "a"), (2, None, 1, "b"), (3, D1, 1, "c")], SCHEMA), path, ["k", "day"], ["version"], ["day"])
    merge.upsert(spark.createDataFrame([(9, None, 1, "new"), (4, D1, 1, "new"), (2, None, 2, "b2")], SCHEMA), path, ["k", "day"], ["version"], ["day"])
    got = sorted((r.k, r.value) for r in spark.read.schema(SCHEMA).parquet(path).collect())
    assert got == [(1, "a"), (2, "b2"), (3, "c"), (4, "new"), (9, "new")]


def test_upsert_without_partitions_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        merge.upsert(spark.createDataFrame([(1, D1, 1, "a")], SCHEMA), str(tmp_path / "t"), ["k"], ["version"], [])


def test_only_the_batch_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [dt.date(2026, 1, d) for d in range(1, 21)]
    merge.append_new(spark.createDataFrame([(1, d, 1, "a") for d in days], SCHEMA), path, ["k", "day"], ["day"])
    target = spark.read.schema(SCHEMA).parquet(path)
    touched = merge._touched(target, spark.createDataFrame([(5, D1, 1, "x"), (6, D2, 1, "y")], SCHEMA), ["day"])
    assert len(touched.inputFiles()) == 20  # of the relation; the plan reads two
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan and "2026-01-01" in plan.split("PartitionFilters")[1]
    assert sorted(r.day for r in touched.collect()) == [D1, D2]


def test_replacing_a_partition_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, D1, 1, "a"), (2, D2, 1, "b")], SCHEMA)
    for _ in range(2):
        files.replace_partitions(rows, path, "day")
        assert len(table(spark, path)) == 2
    files.replace_partitions(rows.where("k = 1").withColumn("value", F.lit("z")), path, "day")
    assert table(spark, path) == [(1, D1, 1, "z"), (2, D2, 1, "b")]


def test_a_partition_can_be_replaced_by_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, D1, 1, "a"), (2, D2, 1, "b")], SCHEMA)
    for day in ("2026-01-01", "2026-01-02"):
        files.replace_partition(rows, path, "day", day)
    assert len(table(spark, path)) == 2
    for empty in (rows.where("k > 5"), rows.limit(0), spark.createDataFrame([], SCHEMA), rows.groupBy("k", "day").agg(
        F.max("version").alias("version"), F.max("value").alias("value")).where("version > 7")):
        files.replace_partition(rows, path, "day", "2026-01-01")
        files.replace_partition(empty, path, "day", "2026-01-01")
        assert table(spark, path) == [(2, D2, 1, "b")]
    files.replace_partition(rows, path, "day", "2026-01-01")
    assert len(table(spark, path)) == 2


# -- ranking -----------------------------------------------------------------
def scores(spark, n=2000, seed=2):
    rng = random.Random(seed)
    rows = [(i, f"g{rng.randint(0, 4)}", 50.0 if i % 3 == 0 else round(rng.uniform(0, 100), 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, g string, score double").repartition(6)


def test_global_rank_with_a_hot_score(spark):
    rows, df = scores(spark)
    got = {r.id: r["rank"] for r in ranking.global_rank(df, "score", "rank").collect()}
    for i, _, score in rows:
        assert got[i] == 1 + sum(other > score for _, _, other in rows)


def test_global_rank_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 7.0), (4, None)], "id int, score double")
    got = {r.id: r["rank"] for r in ranking.global_rank(df, "score", "rank").collect()}
    assert got == {3: 1, 2: 2, 1: 3, 4: 3}


@pytest.mark.parametrize("seed", range(4))
def test_top_rows_carry_their_rank_in_the_whole_group(spark, seed):
    rows, df = scores(spark, 300, seed)
    got = ranking.top_rows_with_group_rank(df, "g", "score", 8, "place", ["id"]).collect()
    best = sorted(rows, key=lambda r: (-r[2], r[0]))[:8]
    assert [(r.id, r.g, r.score) for r in got] == best
    for r in got:
        assert r.place == 1 + sum(g == r.g and s > r.score for _, g, s in rows)


def test_top_per_group_keeps_ties_and_limits_before_the_shuffle(spark):
    rows, df = scores(spark)
    top = ranking.top_ranked_per_group(df, "g", "score", 3, "place")
    expected = {i for i, g, s in rows if sum(og == g and os > s for _, og, os in rows) < 3}
    assert {r.id for r in top.collect()} == expected
    assert top._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


# -- shares ------------------------------------------------------------------
def test_shares_sum_to_hundred(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 5.0)], "g string, v double")
    got = {r.g: r.pct for r in shares.share_of_total(df, "v", "pct").collect()}
    assert got == {"a": 12.5, "b": 25.0, "c": 62.5}


def test_compared_with_average_and_latest(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 9.0)], "id int, v double")
    kept = shares.compared_with_average(df, F.avg("v"), lambda a: F.col("v") < a)
    assert sorted(r.id for r in kept.collect()) == [1, 2]
    assert [r.id for r in shares.at_latest(df, "id").collect()] == [3]


# -- streaks -----------------------------------------------------------------
def days(spark, series):
    rows = [
        (city, dt.date(2026, 1, 10), dt.date(2026, 1, 1) + dt.timedelta(i), float(p))
        for city, rain in series.items()
        for i, p in enumerate(rain)
    ]
    return spark.createDataFrame(rows, "location_key string, run_date date, obs_date date, precip_mm double").repartition(5)


def test_streak_of_the_survey_fixture(spark):
    rows = streaks.dry_day_streaks(days(spark, {"x": [0, 0, 5, 0, 0, 0]})).orderBy("obs_date").collect()
    assert [r.dry_day_streak for r in rows] == [1, 2, 0, 3, 4, 5]
    assert [r.dry_day_streak_true for r in rows] == [1, 2, 0, 1, 2, 3]


def test_streaks_against_brute_force(spark):
    rng = random.Random(4)
    series = {f"c{c}": [rng.choice([0, 0.99, 1, 20]) for _ in range(60)] for c in range(6)}
    got = streaks.dry_day_streaks(days(spark, series)).orderBy("location_key", "obs_date").collect()
    for city, rain in series.items():
        rows = [r for r in got if r.location_key == city]
        dry = run = 0
        for row, p in zip(rows, rain):
            dry += p < 1
            run = run + 1 if p < 1 else 0
            assert row.dry_day_streak == (dry if p < 1 else 0)
            assert row.dry_day_streak_true == run


def test_streak_continues_over_a_batch_border(spark):
    rng = random.Random(6)
    whole = {f"c{c}": [rng.choice([0, 0, 3]) for _ in range(20)] for c in range(8)}
    whole["always"] = [0] * 20
    df = days(spark, whole)
    cut = dt.date(2026, 1, 11)
    early = streaks.dry_day_streaks(df.where(F.col("obs_date") < cut))
    late = streaks.dry_day_streaks(df.where(F.col("obs_date") >= cut))
    joined = early.unionByName(streaks.continue_streaks(late, early))
    columns = ["location_key", "obs_date", "dry_day_streak_true"]
    expected = streaks.dry_day_streaks(df).select(*columns)
    assert sorted(joined.select(*columns).collect()) == sorted(expected.collect())


def test_streak_does_not_continue_over_a_gap(spark):
    df = streaks.dry_day_streaks(days(spark, {"x": [0, 0, 0, 0]}))
    early, late = df.where("obs_date < '2026-01-02'"), days(spark, {"x": [0, 0, 0, 0]}).where("obs_date > '2026-01-02'")
    rows = streaks.continue_streaks(streaks.dry_day_streaks(late), early).orderBy("obs_date").collect()
    assert [r.dry_day_streak_true for r in rows] == [1, 2]


def test_previous_day(spark):
    df = streaks.dry_day_streaks(days(spark, {"x": [0, 0, 5, 0]}))
    rows = streaks.previous_day_streak(df).orderBy("obs_date").collect()
    assert [r.prev_streak for r in rows] == [0, 1, 2, 0]


# -- quality -----------------------------------------------------------------
def test_checks_and_policies(spark, caplog):
    rows = [("jakarta", D1, 5.0), ("jakarta", None, 20.0), ("medan", D2, None)]
    df = spark.createDataFrame(rows, "location_key string, obs_date date, temp_max_c double")
    result = quality.run_checks(df, quality.silver_checks(least_cities=2))
    got = {r["check"]: (r.passed, r.detail) for r in result.collect()}
    assert got == {
        "city_coverage": (True, "2"),
        "temperature_out_of_range": (False, "1"),
        "missing_obs_date": (False, "1"),
    }
    with pytest.raises(quality.QualityError, match="missing_obs_date: 1"):
        quality.enforce(result)
    assert quality.enforce(result, "warn") is False
    assert "temperature_out_of_range" in caplog.text
    assert quality.enforce(result.where("passed")) is True


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert quality.key_check(df, ["a", "b"], "t").first() == ("t", False, "1")
    assert quality.key_check(df.distinct(), ["a", "b"], "t").first() == ("t", True, "0")


# -- tables ------------------------------------------------------------------
def test_tables_are_created_once(spark):
    names = schemas.create_tables(spark, "warehouse_test")
    assert schemas.create_tables(spark, "warehouse_test") == names
    assert spark.table("warehouse_test.gold_weather_daily").schema["risk_code"].dataType.simpleString() == "string"
    stored = {t.name for t in spark.catalog.listTables("warehouse_test") if not t.isTemporary}
    assert stored == {n.split(".")[1] for n in names}


def test_global_rank_over_any_column(spark):
    """Texts, and as many values as rows: no range holds more than its share."""
    df = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    want = {r.id: i + 1 for i, r in enumerate(df.orderBy(F.desc("v")).collect())}
    assert {r.id: r["rank"] for r in ranking.global_rank(df, "v", "rank").collect()} == want


def test_latest_before_over_any_gap(spark):
    rng = random.Random(11)
    start = dt.datetime(2020, 1, 1)

    def rows(n, most):
        # one user holds most rows; times repeat; gaps reach over empty months
        out = [(rng.choice([1] * 8 + [2, None]), start + dt.timedelta(days=rng.choice((0, 40, 400, 1200)), hours=rng.randint(0, most)), i) for i in range(n)]
        return [*out, (3, None, n)]

    asks, tells = rows(300, 30), rows(200, 30)
    schema = "user int, at timestamp_ntz, x int"
    left = spark.createDataFrame(asks, schema).withColumnRenamed("x", "id").repartition(4)
    right = spark.createDataFrame(tells, schema)
    for same_time in (False, True):
        got = latest_before(left, right, ["user"], "at", ["x"], same_time=same_time)
        assert got.columns == ["user", "at", "id", "last_at", "last_x"]
        for r in got.collect():
            earlier = [] if r.at is None else [(t, x) for u, t, x in tells if u == r.user and t and (t < r.at or same_time and t == r.at)]
            assert (r.last_at, r.last_x) == max(earlier, default=(None, None))
        assert got.count() == len(asks)
