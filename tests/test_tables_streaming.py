import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.plans import catalog
from tidewater.session import scratch_path
from tidewater.sources import tables as K
from tidewater.streaming import ingest as ST


def test_repeated_refresh_appends_twice_latest_once(spark):
    batch = spark.createDataFrame([("t1", "u1"), ("t2", "u2")], "title string, url string")
    log = scratch_path(spark, "t-log")
    K.append_batch(batch, log, 1)
    K.append_batch(batch, log, 2)
    K.append_batch(batch, log, 2)  # a replayed batch overwrites itself
    rows = K.read_log(spark, log)
    assert rows.count() == 4
    latest = K.latest_per_key(rows, ["title"])
    assert latest.count() == 2 and {r.batch_id for r in latest.collect()} == {2}


def test_unpublished_batch_is_not_read(spark):
    log = scratch_path(spark, "t-log2")
    K.append_batch(spark.createDataFrame([("a",)], "k string"), log, 1)
    # a batch directory without a manifest row (writer died before publishing)
    (spark.createDataFrame([("b",)], "k string").withColumn("created_at", F.current_timestamp())
     .write.parquet(f"{log}/data/batch_id=9"))
    assert [r.k for r in K.read_log(spark, log).collect()] == ["a"]


def test_dense_ids_are_consecutive(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 3).alias("x"))
    ids = sorted(r.id for r in K.with_dense_ids(df, start=5).collect())
    assert ids == list(range(5, 1005))


def test_collect_sources_survives_a_broken_source(spark):
    def broken():
        return spark.range(3).select("no_such_column")
    _, status = K.collect_sources(spark, {
        "ok": (lambda: spark.range(3), K.SCHEMAS["real_solutions"]),
        "bad": (broken, K.SCHEMAS["real_solutions"])})
    got = {r.source: (r.n_rows, r.status.split(":")[0]) for r in status.collect()}
    assert got == {"ok": (3, "ok"), "bad": (0, "error")}


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, ts, 1, "view", 1.0, '{"k": 1}') for i, ts in rows],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_late_event_dropped_and_counted(spark):
    root = scratch_path(spark, "t-late")
    early = [(i, dt.datetime(2024, 1, 10, 12, 0) + dt.timedelta(minutes=i)) for i in range(5)]
    ST.stage_files(_events(spark, early), f"{root}/in")
    ST.daily_rollup(spark, f"{root}/in", f"{root}/log", watermark="1 day", max_files=1)
    late = [(100, dt.datetime(2024, 1, 2, 8, 0)), (101, dt.datetime(2024, 1, 10, 13, 0))]
    ST.stage_files(_events(spark, late), f"{root}/in")
    q = ST.daily_rollup(spark, f"{root}/in", f"{root}/log", watermark="1 day", max_files=1)
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    latest = K.latest_per_key(K.read_log(spark, f"{root}/log"), ["window_start", "event_type"])
    got = {(r.day, r.n_events) for r in latest.select(
        ST.utc_day("window_start").alias("day"), "n_events").collect()}
    assert got == {(dt.date(2024, 1, 10), 6)}
    assert dropped == 1


def test_stream_dedup_equals_batch(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(50)]
    out = ST.survey_ingest(spark, _events(spark, rows))
    assert sorted(r.event_id for r in out.collect()) == list(range(50))


def test_save_all_commits_once_with_continuing_ids(spark):
    root = scratch_path(spark, "t-save")
    a = spark.createDataFrame([("x",), ("y",)], "name string")
    b = spark.createDataFrame([("u",)], "title string")
    K.save_all(spark, {"a": a, "b": b}, root, 1)
    K.save_all(spark, {"a": a, "b": b}, root, 2)
    ids = sorted(r.id for r in K.read_log(spark, f"{root}/a", f"{root}/_manifest").collect())
    assert ids == [1, 2, 3, 4]
    # a third batch written but never published stays invisible in every log
    K.write_batch(K.with_dense_ids(a, 5), f"{root}/a", 3)
    assert K.read_log(spark, f"{root}/a", f"{root}/_manifest").count() == 4
    assert K.read_log(spark, f"{root}/b", f"{root}/_manifest").count() == 2


def test_write_if_empty_loads_once(spark):
    path = scratch_path(spark, "t-once")
    K.write_if_empty(spark.createDataFrame([(1,)], "x long"), path)
    K.write_if_empty(spark.createDataFrame([(2,), (3,)], "x long"), path)
    assert [r.x for r in spark.read.parquet(path).collect()] == [1]


def test_create_tables_if_absent(spark):
    root = scratch_path(spark, "t-create")
    paths = K.create_tables(spark, root)
    assert len(paths) == 7
    assert spark.read.parquet(f"{root}/kpi_monthly").schema.fieldNames()[:3] == ["date_month", "year", "quarter"]
    spark.createDataFrame([(1, "x")], "id long, name string").write.mode("overwrite").parquet(
        f"{root}/real_solutions_extra")
    K.create_tables(spark, root)  # second call: nothing replaced
    assert spark.read.parquet(f"{root}/real_solutions").count() == 0


def test_seed_after_create(spark):
    root = scratch_path(spark, "t-seed")
    K.create_tables(spark, root)
    row = spark.createDataFrame([(1, "n")], "id long, name string")
    for _ in range(2):
        K.write_if_empty(K.conform(row, K.SCHEMAS["real_solutions"]), f"{root}/real_solutions")
    assert [r.name for r in spark.read.parquet(f"{root}/real_solutions").collect()] == ["n"]


def test_a_source_that_fails_while_it_runs_is_left_out(spark):
    schema = K.SCHEMAS["real_indicators"]
    good = spark.createDataFrame([("a", 1)], "indicator string, year long")
    loaders = {"real_indicators": (lambda: good, schema),
               "real_solutions": (lambda: good.selectExpr("cast(indicator as int) id"), K.SCHEMAS["real_solutions"]),
               "real_procurements": (lambda: spark.read.parquet("/nowhere"), K.SCHEMAS["real_procurements"])}
    root = scratch_path(spark, "t-fail")
    for batch in (1, 2):  # the second refresh meets the empty logs of the first
        datasets, status = K.collect_sources(spark, loaders)
        K.save_all(spark, datasets, root, batch)
    assert {r.source: (r.n_rows, r.status == "ok") for r in status.collect()} == {
        "real_indicators": (1, True), "real_solutions": (0, False), "real_procurements": (0, False)}
    read = lambda n: K.read_log(spark, f"{root}/{n}", f"{root}/_manifest", K.SCHEMAS[n])
    assert sorted(r.id for r in read("real_indicators").collect()) == [1, 2] and read("real_solutions").count() == 0
    assert set(K.SCHEMAS["real_indicators"].names) <= set(read("real_indicators").columns)


@pytest.mark.parametrize("refresh,broken", [
    (1, lambda df: df.select("no_such_column")),
    (2, lambda df: df.withColumn("value", F.raise_error(F.lit("unreadable")).cast("double")))])
def test_a_refresh_with_a_failing_source_is_an_error(spark, sf_dir, monkeypatch, refresh, broken):
    """While it is planned or while it runs: the other sources are tried, that refresh commits nothing."""
    tried, root, indicators, cards = [], scratch_path(spark, "t-refresh"), catalog._indicators, catalog._cards

    def loaded(*a):
        tried.append("indicators")
        return broken(indicators(*a)) if tried.count("indicators") == refresh else indicators(*a)

    monkeypatch.setattr(catalog, "scratch_path", lambda *_: root)
    monkeypatch.setattr(catalog, "_indicators", loaded)
    monkeypatch.setattr(catalog, "_cards", lambda *a: tried.append("cards") or cards(*a))
    with pytest.raises(RuntimeError, match="real_indicators: "):
        catalog.refresh_commit(spark, sf_dir)
    assert tried.count("cards") == refresh
    committed = spark.read.parquet(f"{root}/_manifest").select("batch_id").collect() if K._path_exists(spark, f"{root}/_manifest") else []
    assert [r.batch_id for r in committed] == list(range(1, refresh))


def test_latest_breaks_ties_by_id(spark):
    log = spark.createDataFrame([(i, "k", 1) for i in range(6)], "id long, key string, batch_id long").repartition(3)
    assert K.latest_per_key(log, ["key"]).first().id == 5


def test_snapshots_give_what_the_whole_log_gives(spark):
    """Ten refreshes, snapshots only when the batches since weigh enough."""
    log, wrote = scratch_path(spark, "t-snap"), []
    for batch in range(1, 11):
        rows = [(f"k{i}", f"v{batch}-{i}") for i in range(40) if (i + batch) % (2 if batch < 3 else 9) == 0]
        K.append_batch(spark.createDataFrame(rows, "k string, v string"), log, batch)
        wrote.append(K.compact(spark, log, ["k"]))
        got = sorted((r.k, r.v, r.batch_id) for r in K.read_latest(spark, log, ["k"]).collect())
        assert got == sorted((r.k, r.v, r.batch_id) for r in K.latest_per_key(K.read_log(spark, log), ["k"]).collect())
    assert wrote[0] and 2 <= sum(wrote) < 7
    assert not K.compact(spark, log, ["k"], ratio=1.0)
    # earlier batches are not read: their folders may go
    newest = K._snapshots(spark, log)
    plan = K.read_latest(spark, log, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert f"(batch_id" in plan and f"> {newest.upto})" in plan


def test_state_answers_from_the_commits(spark):
    root = scratch_path(spark, "t-state")
    cards = [("a", "x"), ("b", "x"), (None, "x")]
    one = spark.createDataFrame(cards, "title string, description string")
    K.save_all(spark, {"real_support_measures": one, "real_solutions": K.empty(spark, K.SCHEMAS["real_solutions"])}, root, 1)
    two = spark.createDataFrame([("b", "y"), ("c", "y")], "title string, description string")
    K.save_all(spark, {"real_support_measures": two}, root, 2)
    K.save_all(spark, {"real_support_measures": two}, root, 2)  # a replay
    s = {r.name: r for r in K.source_state(spark, f"{root}/_manifest").collect()}
    cards = s["real_support_measures"]
    assert (cards.n_rows, cards.last_id, cards.null_keys, cards.n_keys) == (5, 5, 1, 3)
    assert cards.first_created <= cards.last_created
    assert (s["real_solutions"].n_rows, s["real_solutions"].last_created) == (0, None)
