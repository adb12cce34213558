import json
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from merchlake import schemas
from merchlake.operators import keyset, quality, quarantine, runlog, surrogate, tables, watermarks
from merchlake.operators.increments import OrderStore
from merchlake.operators.keyset import Watermark
from merchlake.operators.upsert import DuplicateKeyError, MissingKeyError, require_unique, upsert
from merchlake.streaming import orders as order_stream
from merchlake.streaming import pageviews as pageview_stream

T1, T2, T3 = datetime(2026, 1, 1, 10), datetime(2026, 1, 2, 9), datetime(2026, 1, 3, 12)


def raw(spark, *rows):
    return spark.createDataFrame(
        [(i, t, 1, 1, 1, 1, price, 1.0) for i, t, price in rows], schemas.ORDERS
    )


def staged(spark, *rows):
    return raw(spark, *rows).withColumn("gross_profit", F.col("price_usd") - F.col("cogs_usd"))


def prices(df):
    return {r.order_id: r.price_usd for r in df.collect()}


# keyset


def test_keyset_increment(spark):
    df = raw(spark, (1, T1, 1.0), (2, T1, 1.0), (3, T2, 1.0), (4, T3, 1.0))
    behind = keyset.after(df, Watermark(T1, 1))
    assert sorted(r.order_id for r in behind.collect()) == [2, 3, 4]
    assert keyset.after(df).count() == 4


def test_keyset_filter_reaches_the_scan(spark, folder):
    raw(spark, (1, T1, 1.0)).write.parquet(f"{folder}/o")
    df = keyset.after(spark.read.parquet(f"{folder}/o"), Watermark(T2, 1))
    assert "GreaterThanOrEqual(created_at" in df._jdf.queryExecution().executedPlan().toString()


def test_zoned_checkpoint_becomes_utc():
    zoned = datetime(2026, 1, 1, 12, tzinfo=timezone(timedelta(hours=2)))
    assert keyset.naive_utc(zoned) == T1


def test_half_a_checkpoint_is_refused():
    with pytest.raises(ValueError):
        Watermark(T1, None)
    with pytest.raises(ValueError):
        Watermark(None, 1)


def test_checkpoint_is_the_highest_position(spark):
    df = raw(spark, (12, T1, 1.0), (11, T1, 1.0), (1, T1 - timedelta(days=1), 1.0))
    assert tuple(keyset.checkpoint(df).first()) == (T1, 12)


def test_late_orders_are_reported(spark):
    source = raw(spark, (1, T1, 1.0), (2, T1, 1.0), (9, T3, 1.0))
    late = keyset.late(source, source.filter("order_id = 2"), Watermark(T2, 3))
    assert [r.order_id for r in late.collect()] == [1]


# upsert and surrogate keys


def test_upsert_inserts_overwrites_and_keeps(spark):
    target, source = [(1, T1, 1.0), (2, T1, 2.0)], [(2, T2, 5.0), (3, T2, 6.0)]
    state = upsert(staged(spark, *target), staged(spark, *source), ["order_id"])
    assert prices(state) == {1: 1.0, 2: 5.0, 3: 6.0}


def test_upsert_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, None)], "k int, v string")
    assert [tuple(r) for r in upsert(target, source, ["k"]).collect()] == [(1, None)]


def test_upsert_keeps_surrogate_keys(spark):
    members = spark.range(50).select(F.col("id").alias("user_id"), F.lit("a").alias("v"))
    target = surrogate.assign(members.filter("user_id % 2 = 0"), ["user_id"], "k")
    state = upsert(target, members.withColumn("v", F.lit("b")), ["user_id"], "k")
    before = {r.user_id: r.k for r in target.collect()}
    after = {r.user_id: r.k for r in state.collect()}
    assert len(after) == 50 and sorted(after.values()) == list(range(1, 51))
    assert all(after[user] == key for user, key in before.items())
    assert {r.v for r in state.collect()} == {"b"}


def test_surrogate_keys_do_not_depend_on_the_partitioning(spark):
    ids = spark.range(1000).select(F.col("id").alias("user_id"))
    one = surrogate.assign(ids.repartition(1), ["user_id"], "k")
    many = surrogate.assign(ids.repartition(13), ["user_id"], "k")
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in many.collect()}


def test_duplicate_keys_in_one_upsert_raise(spark):
    with pytest.raises(DuplicateKeyError):
        require_unique(staged(spark, (1, T1, 1.0), (1, T2, 2.0)), ["order_id"])
    require_unique(staged(spark, (1, T1, 1.0), (None, T2, 2.0), (None, T2, 2.0)), ["order_id"])


# versioned tables and loads


def test_versions_publish_only_complete_writes(spark, folder):
    table = tables.VersionedTable(f"{folder}/t")
    assert not table.exists(spark)
    assert table.read(spark, schemas.PRODUCTS).count() == 0
    assert table.write(spark.range(3).toDF("a")) == 1
    assert table.write(table.read(spark).filter("a > 0")) == 2
    unmarked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    spark.range(9).toDF("a").write.options(**unmarked).parquet(f"{folder}/t/v=3")
    assert sorted(r.a for r in table.read(spark).collect()) == [1, 2]
    assert table.write(spark.range(1).toDF("a")) == 3
    assert table.drop_old(spark, keep=1) == [1, 2]
    assert table.versions(spark) == [3]


def test_load_modes(spark, folder):
    path = f"{folder}/s"
    tables.load(spark.range(2), path)
    tables.load(spark.range(3), path, "append")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.load(spark.range(1), path, "fail")
    with pytest.raises(ValueError):
        tables.load(spark.range(1), path, "merge")
    tables.ensure(spark, path, schemas.PRODUCTS)
    assert spark.read.parquet(path).count() == 5
    tables.ensure(spark, f"{folder}/new", schemas.PRODUCTS)
    assert spark.read.parquet(f"{folder}/new").schema == schemas.PRODUCTS


# order store


def test_increments_advance_data_and_checkpoint_together(spark, folder):
    store = OrderStore(folder)
    assert store.watermark(spark).is_empty and store.read(spark).count() == 0
    assert store.append(staged(spark, (11, T1, 1.0), (12, T1, 2.0))) == Watermark(T1, 12)
    assert store.append(staged(spark, (12, T2, 5.0), (13, T2, 6.0))) == Watermark(T2, 13)
    assert store.watermark(spark) == Watermark(T2, 13)
    assert prices(store.read(spark)) == {11: 1.0, 12: 5.0, 13: 6.0}


def test_empty_increment_moves_nothing(spark, folder):
    store = OrderStore(folder)
    store.append(staged(spark, (11, T1, 1.0)))
    assert store.append(staged(spark)) is None
    assert store.watermark(spark) == Watermark(T1, 11)
    assert prices(store.read(spark)) == {11: 1.0}


def test_uncommitted_run_is_invisible_and_replaced(spark, folder):
    store = OrderStore(folder)
    store.append(staged(spark, (11, T1, 1.0)))
    # Data written, then the run dies before its commit.
    staged(spark, (99, T3, 9.0)).write.parquet(f"{folder}/data/run=1")
    assert prices(store.read(spark)) == {11: 1.0}
    assert store.watermark(spark) == Watermark(T1, 11)
    store.append(staged(spark, (12, T2, 2.0)))
    assert prices(store.read(spark)) == {11: 1.0, 12: 2.0}


def test_failing_increment_leaves_the_checkpoint(spark, folder):
    store = OrderStore(folder)
    store.append(staged(spark, (11, T1, 1.0)))
    broken = staged(spark, (12, T2, 2.0)).withColumn(
        "price_usd", F.raise_error(F.lit("lost connection")).cast("double")
    )
    with pytest.raises(Exception, match="lost connection"):
        store.append(broken)
    assert store.watermark(spark) == Watermark(T1, 11)
    assert prices(store.read(spark)) == {11: 1.0}


def test_missing_columns_raise(spark, folder):
    with pytest.raises(ValueError, match="cogs_usd, gross_profit"):
        OrderStore(folder).append(raw(spark, (1, T1, 1.0)).drop("cogs_usd"))


def test_compaction_changes_nothing_but_the_files(spark, folder):
    store = OrderStore(folder)
    for rows in [[(1, T1, 1.0), (2, T1, 2.0)], [(2, T2, 3.0)], [(2, T3, 4.0), (3, T3, 5.0)]]:
        store.append(staged(spark, *rows))
    expected = prices(store.read(spark))
    assert expected == {1: 1.0, 2: 4.0, 3: 5.0}
    assert store.compact(spark) == 2
    assert prices(store.read(spark)) == expected
    assert store.watermark(spark) == Watermark(T3, 3)
    assert store.compact(spark) is None
    store.append(staged(spark, (1, T3 + timedelta(days=1), 7.0)))
    assert store.open_runs(spark) == 1
    assert prices(store.read(spark)) == {1: 7.0, 2: 4.0, 3: 5.0}


def test_second_compaction_drops_what_the_first_one_folded(spark, folder):
    store = OrderStore(folder)
    for day in range(6):
        store.append(staged(spark, (1, T1 + timedelta(days=day), float(day)), (10 + day, T1, 1.0)))
        if day in (2, 4):
            store.compact(spark)
    assert tables.finished_numbers(spark, f"{folder}/data", "run") == [3, 4, 5]
    assert tables.finished_numbers(spark, f"{folder}/base", "upto") == [2, 4]
    expected = {1: 5.0} | {10 + day: 1.0 for day in range(6)}
    assert prices(store.read(spark)) == expected
    assert store.next_run(spark) == 6


def test_replayed_micro_batch_replaces_itself(spark, folder):
    store, rejected = OrderStore(f"{folder}/o"), f"{folder}/r"
    batch = raw(spark, (1, T1, 1.0), (2, T1, -2.0))
    for _ in range(2):
        order_stream.take_over_batch(batch, 0, store, rejected, "s")
    assert prices(store.read(spark)) == {1: 1.0}
    assert spark.read.option("header", True).csv(rejected).count() == 1


def test_stream_batch_on_a_used_store_adds_to_it(spark, folder):
    store, rejected = OrderStore(f"{folder}/o"), f"{folder}/r"
    store.append(staged(spark, (1, T1, 1.0), (2, T1, 2.0)))
    store.append(staged(spark, (3, T2, 3.0)))
    order_stream.take_over_batch(raw(spark, (9, T3, 9.0)), 0, store, rejected, "s")
    assert prices(store.read(spark)) == {1: 1.0, 2: 2.0, 3: 3.0, 9: 9.0}
    assert store.watermark(spark) == Watermark(T3, 9)


def test_new_stream_after_compaction_adds_to_it(spark, folder):
    store, rejected = OrderStore(f"{folder}/o"), f"{folder}/r"
    for number in range(3):
        order_stream.take_over_batch(raw(spark, (number, T1, 1.0)), number, store, rejected, "old")
    assert store.compact(spark) == 2
    assert tables.finished_numbers(spark, f"{folder}/o/commits", "run") == []
    order_stream.take_over_batch(raw(spark, (9, T2, 9.0)), 0, store, rejected, "new")
    order_stream.take_over_batch(raw(spark, (2, T1, 1.0)), 2, store, rejected, "old")
    order_stream.take_over_batch(raw(spark, (4, T1, 4.0)), 3, store, rejected, "old")
    expected = {0: 1.0, 1: 1.0, 2: 1.0, 9: 9.0, 4: 4.0}
    assert prices(store.read(spark)) == expected and store.next_run(spark) == 5
    assert store.compact(spark) == 4
    order_stream.take_over_batch(raw(spark, (2, T3, 5.0)), 2, store, rejected, "old")
    assert prices(store.read(spark)) == expected
    assert store.watermark(spark) == Watermark(T2, 9)


def test_late_orders_do_not_move_the_checkpoint_back(spark, folder):
    store = OrderStore(folder)
    store.append(staged(spark, (5, T2, 1.0)))
    assert store.append(staged(spark, (2, T1, 2.0))) == Watermark(T2, 5)
    assert store.watermark(spark) == Watermark(T2, 5)
    assert prices(store.read(spark)) == {5: 1.0, 2: 2.0}


def test_replay_that_turned_empty_changes_nothing(spark, folder):
    store = OrderStore(folder)
    store.append(staged(spark, (5, T2, 1.0)), "s", 0)
    assert store.append(staged(spark), "s", 0) == Watermark(T2, 5)
    assert prices(store.read(spark)) == {5: 1.0}


def test_orders_without_key_raise(spark, folder):
    with pytest.raises(MissingKeyError):
        OrderStore(folder).append(staged(spark, (5, T2, 1.0)).withColumn("order_id", F.lit(None).cast("long")))


def test_order_times_with_offset_are_instants(spark):
    text = spark.createDataFrame([("2024-01-01T10:00:00+02:00",), ("2024-01-01T10:00:00",)], "created_at string")
    schema = StructType([StructField("created_at", TimestampNTZType())])
    assert [r.created_at.hour for r in schemas.conform(text, schema).collect()] == [8, 10]


def test_order_stream(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()

    def land(name, *orders):
        body = [
            {"order_id": i, "created_at": t.isoformat(), "website_session_id": 1, "user_id": 1,
             "primary_product_id": 1, "items_purchased": 1, "price_usd": p, "cogs_usd": 1.0}
            for i, t, p in orders
        ]
        text = json.dumps({"total": len(body), "limit": 10, "offset": 0, "orders": body})
        (pages / name).write_text(text)

    store = OrderStore(str(tmp_path / "store"))

    def drain():
        query = order_stream.stream_orders(
            spark, str(pages), store, str(tmp_path / "rej"), str(tmp_path / "chk"), 1
        )
        query.awaitTermination()

    land("a.json", (1, T1, 1.0), (2, T1, 2.0))
    drain()
    land("b.json", (2, T2, 5.0), (3, T2, -1.0), (4, T3, 4.0))
    drain()
    drain()
    assert prices(store.read(spark)) == {1: 1.0, 2: 5.0, 4: 4.0}
    assert store.watermark(spark) == Watermark(T3, 4)


def test_pageview_stream_replaces_then_appends(spark, tmp_path):
    exports, folder = tmp_path / "exports", str(tmp_path / "staged")
    exports.mkdir()
    spark.createDataFrame([(99, T1, 1, "/old")], schemas.PAGEVIEWS).withColumn(
        "batch", F.lit(7)
    ).write.partitionBy("batch").parquet(folder)
    header = "website_pageview_id,created_at,website_session_id,pageview_url\n"
    (exports / "1.csv").write_text(header + "1,2026-01-01 10:00:00,1,/home\n2,2026-01-01 10:01:00,1,/cart\n")
    (exports / "2.csv").write_text(header + "3,2026-01-01 10:02:00,1,/home\n4,2026-01-01 10:03:00,1,\"  \"\n")
    query = pageview_stream.stream_pageviews(
        spark, str(exports), folder, str(tmp_path / "rej"), str(tmp_path / "chk")
    )
    query.awaitTermination()
    loaded = pageview_stream.staged_pageviews(spark, folder)
    assert sorted(r.website_pageview_id for r in loaded.collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        pageview_stream.stream_pageviews(spark, str(exports), folder, "r", "c", 0)


# quarantine, watermarks, run log, constraints


def test_quarantine_appends_and_checks_names(spark, folder):
    rejected = spark.createDataFrame([(10, -1.0)], "order_id int, price_usd double")
    assert quarantine.quarantine(rejected, "orders", "run-123", folder) == 1
    assert quarantine.quarantine(rejected, "orders", "run-123", folder) == 1
    rows = spark.read.option("header", True).csv(folder)
    assert rows.count() == 2
    assert {"_pipeline_run_id", "_rejected_at"} <= set(rows.columns)
    for source, run in (("../orders", "r"), ("orders", "../r"), ("a/b", "r"), ("", "r")):
        with pytest.raises(ValueError):
            quarantine.quarantine(rejected, source, run, folder)


def test_empty_quarantine_leaves_no_partition(spark, tmp_path):
    empty = spark.createDataFrame([], "order_id int")
    assert quarantine.quarantine(empty, "orders", "run", str(tmp_path)) == 0
    assert not list(tmp_path.glob("source=*"))


def marks(spark, *rows):
    return spark.createDataFrame(
        [(runlog.PIPELINE_NAME, s, t, i) for s, t, i in rows],
        "pipeline_name string, source_name string, last_created_at timestamp_ntz, last_id bigint",
    )


def test_watermark_table(spark):
    before, updates = marks(spark, ("orders", T1, 1)), marks(spark, ("orders", T2, 5), ("x", T1, 2))
    table = watermarks.set_watermarks(before, updates)
    assert watermarks.get_watermark(table, "orders") == Watermark(T2, 5)
    assert watermarks.get_watermark(table, "nothing").is_empty
    with pytest.raises(Exception, match="requires both"):
        watermarks.set_watermarks(marks(spark), marks(spark, ("orders", T1, None))).collect()


def test_run_log_states(spark):
    t = datetime(2026, 1, 1, tzinfo=UTC).replace(tzinfo=None)
    log = spark.createDataFrame(
        [
            ("a", "p", t, "STARTED", 0, 0, 0, None),
            ("a", "p", t, "SUCCESS", 15, 13, 2, None),
            ("b", "p", t + timedelta(days=1), "STARTED", 0, 0, 0, None),
        ],
        schemas.RUN_LOG,
    )
    states = {r.run_id: r for r in runlog.current_runs(log).collect()}
    assert (states["a"].status, states["a"].rows_loaded, states["a"].finished_at) == ("SUCCESS", 13, t)
    assert (states["b"].status, states["b"].finished_at) == ("STARTED", None)
    assert runlog.latest_run(log).first().run_id == "b"
    with pytest.raises(ValueError):
        runlog.require_final("RUNNING")
    assert quality.outside_domain(log, "status", runlog.STATUSES).count() == 0


def test_run_steps_keep_the_launch_order(spark):
    rows = [
        ("r", n, name, T1 + timedelta(minutes=n), status, None, 5, None)
        for n, name in ((2, "second"), (1, "first"))
        for status in ("STARTED", "SUCCESS")
    ]
    steps = runlog.run_steps(spark.createDataFrame(rows, schemas.STEP_LOG), "r").collect()
    assert [(s.step_name, s.status, float(s.duration_seconds)) for s in steps] == [
        ("first", "SUCCESS", 0.0),
        ("second", "SUCCESS", 0.0),
    ]



def test_constraint_checks(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (2, None)], "id int, ref int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in quality.duplicate_keys(child, ["id"]).collect()] == [(2, 2)]
    assert {tuple(r) for r in quality.null_counts(child).collect()} == {("id", 0), ("ref", 1)}
    assert [tuple(r) for r in quality.orphans(child, "ref", parent, "id").collect()] == [(2, 9)]


def staged_orders(spark, ids):
    return staged(spark, *[(k, T1 + timedelta(minutes=k), 1.0) for k in ids])


def test_two_writers_lose_no_run(spark, folder):
    """Writers at the same time get different run numbers; all that is committed is read."""
    store = OrderStore(folder)
    rows = [staged_orders(spark, [k]) for k in range(1, 9)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(store.append, rows))
    assert sorted(r.order_id for r in store.read(spark).collect()) == list(range(1, 9))
    with ThreadPoolExecutor(4) as pool:
        folded = list(pool.map(lambda k: store.compact(spark), range(3)))
    assert len([n for n in folded if n is not None]) <= 2
    assert sorted(r.order_id for r in store.read(spark).collect()) == list(range(1, 9))


def test_claims_are_exclusive(spark, folder):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: tables.claim(spark, f"{folder}/claims/run=1"), range(16)))
    assert won.count(True) == 1


def test_run_committed_during_a_compaction_stays(spark, folder, monkeypatch):
    """A compaction deletes the commits it has read, not those that came meanwhile."""
    store = OrderStore(folder)
    for k in (1, 2):
        store.append(staged_orders(spark, [k]))
    inner = OrderStore._commit

    def late(self, session, path, rows):
        if path.startswith("folded/"):
            monkeypatch.undo()
            store.append(staged_orders(spark, [3]))
        return inner(self, session, path, rows)

    monkeypatch.setattr(OrderStore, "_commit", late)
    store.compact(spark)
    assert sorted(r.order_id for r in store.read(spark).collect()) == [1, 2, 3]


def test_base_lies_in_keyset_order(spark, folder):
    """Behind a checkpoint only files whose range reaches there hold rows."""
    store = OrderStore(folder)
    for part in range(2):
        store.append(staged_orders(spark, [k for k in range(1, 4001) if k % 2 == part]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.compact(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    position = F.struct("created_at", "order_id")
    ranges = store.read(spark).groupBy(F.input_file_name().alias("f")).agg(F.min(position).alias("low"), F.max(position).alias("high"))
    files = sorted((r.low, r.high) for r in ranges.collect())
    assert len(files) >= 4 and all(a[1] < b[0] for a, b in zip(files, files[1:]))
    place = keyset.Watermark(files[-1][0][0], files[-1][0][1])
    assert keyset.after(store.read(spark), place).select(F.input_file_name()).distinct().count() == 1


def test_logs_are_folded(spark, folder):
    """Many runs leave a bounded number of files and the same states."""
    log, at = f"{folder}/runs", datetime(2026, 1, 1)
    for k in range(30):
        for status in (runlog.STARTED, runlog.SUCCESS):
            row = (f"run-{k}", runlog.PIPELINE_NAME, at + timedelta(minutes=k), status, k, k, 0, None)
            runlog.append_log(spark, log, schemas.RUN_LOG, row)
        runlog.fold_log(spark, log, schemas.RUN_LOG, after=10)
        assert len(tables.data_files(spark, log)) < 10
    states = runlog.current_runs(runlog.read_log(spark, log, schemas.RUN_LOG)).collect()
    assert len(states) == 30 and all(r.status == runlog.SUCCESS and r.rows_extracted == int(r.run_id[4:]) for r in states)


def test_small_pages_share_a_micro_batch(spark, tmp_path):
    """Batches follow the bytes that have landed, not the number of files."""
    pages = tmp_path / "pages"
    pages.mkdir()
    for k in range(120):
        order = {"order_id": k, "created_at": T1.isoformat(), "website_session_id": 1, "user_id": 1,
                 "primary_product_id": 1, "items_purchased": 1, "price_usd": 2.0, "cogs_usd": 1.0}
        (pages / f"{k:03d}.json").write_text(json.dumps({"total": 1, "limit": 10, "offset": 0, "orders": [order]}))

    def runs(name, **bounds):
        store = OrderStore(str(tmp_path / name))
        order_stream.stream_orders(spark, str(pages), store, str(tmp_path / f"rej-{name}"), str(tmp_path / f"chk-{name}"), **bounds).awaitTermination()
        assert prices(store.read(spark)) == dict.fromkeys(range(120), 2.0)
        return store.next_run(spark)

    assert runs("default") == 1
    total = sum(p.stat().st_size for p in pages.iterdir())
    assert 2 <= runs("bytes", bytes_per_batch=total // 2 + 1) <= 3
