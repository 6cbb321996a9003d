"""Data-generating contract of the synthetic experiment log (ported checks)."""

import pytest
from pyspark.sql import functions as F

from funnelforge.operators import quality as QC
from funnelforge.operators.experiment import lift_table
from funnelforge.operators.funnel import funnel_by_variant, funnel_overall, user_flags
from funnelforge.plans import prefix, queries
from funnelforge.schemas import STEPS
from funnelforge.sources import fixtures
from funnelforge.sources import generate as G
from funnelforge.sources.generate import generate

N = 50_000
SEED = 42


@pytest.fixture(scope="module")
def dataset(spark):
    users, events = generate(spark, n_users=N, seed=SEED)
    return users.cache(), events.cache()


def test_shapes(dataset):
    users, events = dataset
    assert users.count() == N
    assert users.select("user_id").distinct().count() == N
    names = {r[0] for r in events.select("event_name").distinct().collect()}
    assert names <= set(STEPS)
    assert events.count() >= N


def test_reproducibility(spark):
    u1, e1 = generate(spark, n_users=5_000, seed=7)
    u2, e2 = generate(spark, n_users=5_000, seed=7)
    assert QC.same_rows(u1, u2).first().asDict() == {"only_left": 0, "only_right": 0}
    assert QC.same_rows(e1, e2).first().asDict() == {"only_left": 0, "only_right": 0}


def test_different_seed_gives_different_data(spark):
    u1, _ = generate(spark, n_users=5_000, seed=1)
    u2, _ = generate(spark, n_users=5_000, seed=2)
    diff = u1.alias("a").join(u2.alias("b"), "user_id").filter(F.col("a.country") != F.col("b.country")).count()
    assert diff > 0


def test_independent_of_shuffle_partitions(spark):
    _, e1 = generate(spark, n_users=3_000, seed=3)
    rows1 = sorted(e1.collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        _, e2 = generate(spark, n_users=3_000, seed=3)
        assert sorted(e2.collect()) == rows1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_variant_split_is_roughly_balanced(dataset):
    users, _ = dataset
    assert QC.arm_balance(users, 0.02).first()["passed"]


def test_funnel_counts_are_monotonically_decreasing(dataset):
    users, events = dataset
    rows = {r["check"]: r for r in QC.funnel_monotone(users, events).collect()}
    assert rows["steps_non_increasing"]["passed"]
    assert rows["first_step_covers_users"]["passed"]


def test_event_timestamps_are_ordered_per_user(dataset):
    _, events = dataset
    assert QC.timestamps_in_step_order(events).first()["value"] == 0


def test_event_ids_are_unique_and_dense(dataset):
    _, events = dataset
    r = events.agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("d"),
                   F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    assert r["n"] == r["d"] == r["hi"] and r["lo"] == 1
    # Ordered by (user_id, event_ts).
    from pyspark.sql import Window
    w = Window.orderBy("event_id")
    bad = events.select("user_id", "event_ts", F.lag("user_id").over(w).alias("pu"),
                        F.lag("event_ts").over(w).alias("pt")) \
        .filter((F.col("pu") > F.col("user_id")) | ((F.col("pu") == F.col("user_id")) & (F.col("pt") >= F.col("event_ts"))))
    assert bad.count() == 0


def test_treatment_lifts_signup_completed(dataset):
    users, events = dataset
    flags = user_flags(users, events, STEPS, keep=("variant",))
    assert QC.lift_above(flags, "reached_signup_completed", 0.03).first()["passed"]


def test_signup_completed_is_not_driven_by_country_or_platform(dataset):
    users, events = dataset
    flags = user_flags(users, events, STEPS, keep=("variant", "country", "platform"))
    for dim in ("country", "platform"):
        assert QC.rate_spread_check(flags, dim, "reached_signup_completed", 0.03, True, "x").first()["passed"]


def test_downstream_activation_does_vary_by_segment(dataset):
    users, events = dataset
    flags = user_flags(users, events, STEPS, keep=("variant", "country", "platform"))
    for dim in ("country", "platform"):
        assert QC.rate_spread_check(flags, dim, "reached_first_transaction", 0.02, False, "x").first()["passed"]


def test_marginal_rates_close_to_design(dataset):
    users, events = dataset
    flags = user_flags(users, events, STEPS, keep=("variant",))
    r = flags.groupBy("variant").agg(F.avg("reached_signup_completed").alias("r")).collect()
    rates = {x["variant"]: x["r"] for x in r}
    assert rates["control"] == pytest.approx(0.62, abs=0.015)
    assert rates["treatment"] == pytest.approx(0.68, abs=0.015)


def _joins(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [ln for ln in plan.splitlines() if "Join" in ln]


def test_only_block_offsets_are_broadcast(spark):
    """A short id table makes Spark's estimate of the walk small: the walk was the broadcast side of the numbering, and one task numbered all users."""
    _, events = generate(spark, n_users=1_000, seed=5)
    last = next(ln for ln in _joins(events) if "block" in ln)
    assert "BroadcastHashJoin [_block" in last and "BuildRight" in last, last


def test_event_ids_over_many_blocks_gaps_and_repeated_users(spark, monkeypatch):
    monkeypatch.setattr(G, "EVENT_ID_BLOCK_USERS", 8)
    monkeypatch.setattr(prefix, "SUPER_BLOCK", 4)
    ids = [*range(-20, 3), *range(500, 700), 600, 600, 9_000]
    _, events = generate(spark, ids=spark.createDataFrame([(i,) for i in ids], "user_id long").repartition(5), seed=11)
    rows = sorted(events.collect())
    assert [r["event_id"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["user_id"] for r in rows] == sorted(r["user_id"] for r in rows)
    assert {r["user_id"] for r in rows} == set(ids)
    assert sum(r["user_id"] == 600 for r in rows) == 3 * len({r["event_ts"] for r in rows if r["user_id"] == 600})


def test_stored_log_is_drawn_once_and_equals_the_generator(spark, tmp_path):
    folder = str(tmp_path / "three")
    spark.range(40, 43).withColumnRenamed("id", "c_custkey").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(41,), (None,)], "c_custkey long").write.mode("append").parquet(f"{folder}/customer.parquet")
    drawn = fixtures.generated_tables(spark, folder)
    stored = fixtures.generated_source(spark, folder)
    assert stored.users.dtypes == drawn.users.dtypes and stored.events.dtypes == drawn.events.dtypes
    assert sorted(stored.users.collect()) == sorted(drawn.users.collect()) and stored.users.count() == 40
    assert sorted(stored.events.collect()) == sorted(drawn.events.collect())
    # Users and events come from one stored walk: nothing is drawn when they are read.
    for df in (stored.users, stored.events):
        assert "md5" not in df._jdf.queryExecution().executedPlan().toString()
    assert "_walk" in stored.users._jdf.queryExecution().executedPlan().toString()


def test_block_offsets(spark):
    df = spark.range(30_000).selectExpr("id div 7 - 3 AS b", "id % 5 AS v")
    got = {r["b"]: r["o"] for r in prefix.block_offsets(df, "b", "v", "o").collect()}
    want, total = {}, 0
    for i in range(30_000):
        want.setdefault(i // 7 - 3, total)
        total += i % 5
    assert got == want


def _customers(spark, folder, n):
    spark.range(1, n + 1).withColumnRenamed("id", "c_custkey").write.parquet(f"{folder}/customer.parquet")
    return queries.Marts(fixtures.generated_tables(spark, folder))


def test_lift_table_reads_the_stored_walk(spark, tmp_path):
    m = _customers(spark, str(tmp_path), 300)
    got = queries.registry()["lift_table"](spark, str(tmp_path))
    assert "_walk" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(got.collect()) == sorted(lift_table(funnel_by_variant(m.users, m.events, m.steps)).collect())


def test_funnel_overall_reads_the_stored_walk(spark, tmp_path):
    m = _customers(spark, str(tmp_path), 200)
    got = queries.registry()["funnel_overall"](spark, str(tmp_path))
    assert "_walk" in got._jdf.queryExecution().executedPlan().toString()
    rows = got.orderBy("step_order").collect()
    assert rows == funnel_overall(m.users, m.events, m.steps).orderBy("step_order").collect() and rows[0]["users"] == 2_000
