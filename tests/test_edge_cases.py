"""Hand-made edge frames (FIXTURES section 5)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.config import Tuning
from churnlens.operators import balance, clean, derive, predictions
from churnlens.plans.wrangle import wrangle_explore, wrangle_train

CS = T.StructType([
    T.StructField("userId", T.StringType()), T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()), T.StructField("sessionId", T.LongType()),
    T.StructField("level", T.StringType()), T.StructField("length", T.DoubleType()),
    T.StructField("page", T.StringType()), T.StructField("location", T.StringType()),
    T.StructField("method", T.StringType()), T.StructField("status", T.LongType()),
    T.StructField("ts", T.LongType()),
])


def row(uid, length=None, page="NextSong", item=0, session=1, loc="Remote", gender="F",
        level="paid", ts=1_704_067_200_000):
    return (uid, gender, item, session, level, length, page, loc, "PUT", 200, ts)


def frame(spark, rows):
    return spark.createDataFrame(rows, CS)


def test_missing_user_ids_are_not_imputed_and_dropped(spark):
    df = frame(spark, [row("", None, "Home"), row(None, None, "Home"), row("", 10.0),
                       row("7", 10.0), row("7", None, "Home", item=1)])
    imp = clean.impute_length(clean.cast_columns(df)).collect()
    by = {(r.userId, r.itemInSession, r.page): r.length for r in imp}
    assert by[(None, 0, "Home")] is None
    assert by[(7, 1, "Home")] == 10.0
    out = wrangle_train(df).collect()
    assert all(r.userId is not None for r in out)
    assert len(out) == 2


def test_user_without_songs_stays_null_and_is_dropped(spark):
    df = frame(spark, [row("3", None, "Home"), row("3", None, "Downgrade", item=1)])
    imp = clean.impute_length(clean.cast_columns(df))
    assert imp.where(F.col("length").isNotNull()).count() == 0
    assert wrangle_train(df).count() == 0


def test_state_extraction_and_fan_out(spark):
    df = spark.createDataFrame([("Remote",), ("A, B, C",), ("X, NY-NJ-PA",), ("A,",)], "location string")
    states = {r.location: r.state for r in derive.add_state(df).collect()}
    assert states == {"Remote": "Remote", "A, B, C": "B", "X, NY-NJ-PA": "NY-NJ-PA", "A,": ""}
    fanned = derive.explode_states(derive.add_state(df), drop_location=False)
    assert fanned.where(F.col("location") == "X, NY-NJ-PA").count() == 3


def _counts(spark, pairs):
    return spark.createDataFrame(pairs, "churn int, count long")


def test_fractions_two_classes_and_ties(spark):
    two = {r.churn: r.fraction for r in balance.balance_fractions(_counts(spark, [(0, 100), (2, 10)])).collect()}
    assert two == {0: 8.6 * 10 / 100, 2: 1.0}
    tied = {r.churn: r.fraction for r in balance.balance_fractions(
        _counts(spark, [(0, 50), (1, 50), (2, 5)]), k=2.0).collect()}
    assert tied[0] == tied[1] == 2.0 * 5 / 50


def test_fraction_above_one_keeps_class_whole(spark):
    fr = {r.churn: r.fraction for r in balance.balance_fractions(
        _counts(spark, [(0, 100), (1, 20), (2, 10)])).collect()}
    assert fr[1] == 1.0  # 8.6 * 10 / 20 > 1


def test_duplicates_follow_the_column_list(spark):
    rows = [row("1", 5.0), row("1", 5.0), row("1", 5.0, session=2)]
    df = frame(spark, rows)
    assert wrangle_train(df).count() == 1
    assert wrangle_explore(df, fan_out=False).count() == 2


def test_no_flagged_rows_gives_null_precision(spark):
    df = spark.createDataFrame([("NextSong", 0.0)], "page string, churn_pred double")
    out = predictions.flag_precision(predictions.flagged_rows(df)).first()
    assert out.n_flagged == 0 and out.flag_precision is None


def test_same_result_for_any_partitioning(spark):
    from churnlens.sources import load_clickstream
    base = wrangle_train(load_clickstream(spark, "/root/testdata/sf0.001")).cache()
    results = []
    for n in (1, 3, 7):
        df = base.repartition(n)
        s = balance.balanced_sample(df).transform(balance.hash_split).transform(balance.assign_folds)
        results.append(sorted(tuple(r) for r in s.collect()))
    assert results[0] == results[1] == results[2]
    base.unpersist()


def test_skewed_join_path_matches_broadcast_path(spark):
    """Force the non-broadcast path: hot keys (incl. null) are salted, result unchanged."""
    from churnlens.sources import load_clickstream
    df = clean.cast_columns(load_clickstream(spark, "/root/testdata/sf0.001"))
    # A hot user holding a third of the rows, plus the null-key group.
    hot = df.withColumn("userId", F.when(F.col("itemInSession") % 3 == 0, F.lit(999999))
                        .otherwise(F.col("userId")))
    a = clean.impute_length(hot)
    rows_a = sorted((tuple(r) for r in a.collect()), key=repr)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large side table
    try:
        b = clean.impute_length(hot, tuning=Tuning(broadcast_max_rows=0))
        plan = b._jdf.queryExecution().executedPlan().toString()
        rows_b = sorted((tuple(r) for r in b.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "__salt" in plan
    assert rows_a == rows_b


def test_time_parts_are_utc_for_any_session_zone(spark):
    df = spark.createDataFrame([(1_704_070_800_123,)], "ts long")  # 2024-01-01 01:00:00.123 UTC
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = derive.add_time_parts(df).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.year, r.month, r.day, r.hour) == (2024, 1, 1, 1)


def test_lower_strings_opt_in(spark):
    df = spark.createDataFrame([("Paid", 1)], "level string, n int")
    assert tuple(clean.lower_strings(df).first()) == ("paid", 1)


def test_range_numbering_equals_window_numbering(spark):
    """The skew path of row_number_within splits groups across tasks; same numbers."""
    from churnlens.sources.events import adapt_events, load_events_table
    ev = load_events_table(spark, "/root/testdata/sf0.001")
    # One user-day holding a third of all rows.
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7))
                        .otherwise(F.col("user_id")))
    hot = hot.withColumn("ts", F.when(F.col("event_id") % 3 == 0,
                                      F.to_timestamp_ntz(F.lit("2024-01-05 00:00:00"))
                                      + F.make_dt_interval(secs=F.col("event_id").cast("int")))
                               .otherwise(F.col("ts")))
    a = adapt_events(hot, numbering="window")
    b = adapt_events(hot, numbering="range")
    from churnlens.config import Tuning
    from churnlens.operators.sequence import row_number_within
    tiny = Tuning(task_rows=10)
    picked = row_number_within(hot, ["user_id"], ["ts", "event_id"], "n", tuning=tiny)
    assert "__task" in picked._jdf.queryExecution().analyzed().toString()  # range path chosen
    c = adapt_events(hot, numbering="range")
    rows = [sorted((tuple(r) for r in d.collect()), key=repr) for d in (a, b, c)]
    assert rows[0] == rows[1] == rows[2]
    assert max(r.itemInSession for r in b.collect()) >= 300


def test_schema_and_preview(spark):
    from churnlens.schema import EVENT_SCHEMA
    from churnlens.sources import preview, schema_of
    df = spark.createDataFrame([], EVENT_SCHEMA)
    assert ("userId", "string") in schema_of(df) and ("ts", "bigint") in schema_of(df)
    assert preview(frame(spark, [row("1", 1.0, item=i) for i in range(9)]), 5).count() == 5


def test_drop_and_rename(spark):
    df = frame(spark, [row("1", 1.0)])
    out = clean.rename_column(clean.drop_columns(df, ["location", "absent"]), "page", "p")
    assert "location" not in out.columns and "p" in out.columns


def test_class_sizes_with_two_classes(spark):
    out = balance.class_size_summary(_counts(spark, [(0, 100), (2, 10)])).first()
    assert (out.max_count, out.min_count, out.mid_count, out.n_classes) == (100, 10, None, 2)
    out3 = balance.class_size_summary(_counts(spark, [(0, 100), (1, 30), (2, 10)])).first()
    assert out3.mid_count == 30


def test_reference_style_random_sample_and_split(spark):
    """``method="random"`` and ``random_split`` reproduce the seeded calls (partition-dependent)."""
    from churnlens.sources import load_clickstream
    base = wrangle_train(load_clickstream(spark, "/root/testdata/sf0.001"))
    s = balance.balanced_sample(base, method="random")
    counts = {r.churn: r["count"] for r in balance.class_counts(s).collect()}
    assert counts[2] == 19 and counts[1] == 54  # whole: fractions clamp to 1
    assert 0 < counts[0] < 742
    parts = balance.random_split(s)
    assert sum(p.count() for p in parts) == s.count()


def test_json_scan_modes(spark, scratch):
    import os
    from churnlens.sources import read_events
    path = os.path.join(scratch, "events.json")
    with open(path, "w") as f:
        f.write('{"userId": "5", "page": "NextSong", "length": 200.5, "ts": 1704067200000}\n')
        f.write('{"userId": "", "page": "Home", "ts": 1704067201000}\n')
        f.write('{not json\n')
    assert read_events(spark, path).count() == 3          # PERMISSIVE keeps a null row
    assert read_events(spark, path, "DROPMALFORMED").count() == 2
    rows = clean.cast_columns(read_events(spark, path, "DROPMALFORMED")).collect()
    assert sorted((r.userId is None) for r in rows) == [False, True]


def test_imputation_changes_only_null_lengths(spark):
    from churnlens.sources import load_clickstream
    cast = clean.cast_columns(load_clickstream(spark, "/root/testdata/sf0.001"))
    keys = ["userId", "sessionId", "itemInSession"]
    before = cast.select(*keys, F.col("length").alias("before"))
    after = clean.impute_length(cast).select(*keys, F.col("length").alias("after"))
    means = cast.groupBy("userId").agg(F.avg("length").alias("m"))
    j = before.alias("b").join(after.alias("a"), [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys])
    j = j.join(means.alias("mm"), F.col("b.userId") == F.col("mm.userId"), "left")
    assert j.count() == cast.count()
    assert j.where(F.col("before").isNotNull() & (F.col("before") != F.col("after"))).count() == 0
    changed = j.where(F.col("before").isNull() & F.col("after").isNotNull())
    assert changed.where(F.col("after") != F.col("m")).count() == 0
    assert changed.count() > 0


def test_split_by_user_keeps_each_user_on_one_side(spark):
    from churnlens.sources import load_clickstream
    base = wrangle_train(load_clickstream(spark, "/root/testdata/sf0.001"))
    by_user = balance.hash_split(base, split_by="user")
    per_user = by_user.groupBy("userId").agg(F.countDistinct("split").alias("n"))
    assert per_user.where(F.col("n") > 1).count() == 0
    assert by_user.select("split").distinct().count() >= 2


def test_balanced_sample_keeps_every_class_at_tiny_fractions(spark):
    """A class whose keep fraction is far under 1e-4 is thinned, not emptied."""
    from churnlens.operators.balance import balanced_sample
    n = 2_000_000
    rows = spark.range(n).select(
        F.col("id").cast("int").alias("userId"), F.lit("M").alias("gender"), F.lit(1).alias("itemInSession"),
        F.lit("free").alias("level"), F.when(F.col("id") < 2, 2).when(F.col("id") < 200, 1).otherwise(0).alias("churn"))
    got = {r["churn"]: r["count"] for r in balanced_sample(rows).groupBy("churn").count().collect()}
    assert got[2] == 2
    assert 1 <= got[1] <= 60 and 1 <= got[0] <= 60  # 8.6 * 2 expected each
