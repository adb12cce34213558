"""Facts kept by month: only touched months are written, keys last, constraints hold at the write."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.operators.constraints import ConstraintError
from merchlake.operators.tables import VersionedTable
from merchlake.operators.upsert import DuplicateKeyError
from merchlake.plans import dimensions, facts, mart_states, marts, warehouse
from merchlake.plans.monthly_facts import MonthlyFacts
from merchlake.plans.staging import transform_all


def moment(month, day, hour=10):
    return datetime(2026, month, day, hour)


ROWS = {
    "website_sessions": [
        (1, moment(1, 5), 100, 0, None, None, None, "desktop", None),
        (2, moment(2, 5), 100, 1, "gsearch", "brand", "ad", "mobile", "https://s"),
        (3, moment(3, 5), 200, 0, "gsearch", "brand", "ad", "desktop", "https://s"),
    ],
    "website_pageviews": [
        (11, moment(1, 5), 1, "/products"),
        (12, moment(1, 5, 11), 1, "/cart"),
        (13, moment(2, 5), 2, "/home"),
        (14, moment(3, 5), 3, "/home"),
    ],
    "products": [(1, moment(1, 1), "Bear"), (2, moment(1, 1), "Panda")],
    "orders": [
        (1000, moment(1, 5, 12), 1, 100, 1, 2, 89.98, 35.0),
        (1001, moment(2, 5, 12), 2, 100, 1, 1, 49.99, 19.49),
        (1002, moment(3, 5, 12), 3, 200, 2, 1, 49.99, 19.49),
    ],
    "order_items": [
        (1, moment(1, 5, 12), 1000, 1, 1, 49.99, 19.49),
        (2, moment(2, 1, 0), 1000, 1, 0, 39.99, 15.51),
        (3, moment(2, 5, 12), 1001, 1, 1, 49.99, 19.49),
        (4, moment(3, 5, 12), 1002, 2, 1, 49.99, 19.49),
    ],
    "order_item_refunds": [(1, moment(2, 20), 1, 1000, 10.0)],
}


def staged(spark, **changed):
    rows = {**ROWS, **changed}
    return transform_all({n: spark.createDataFrame(r, schemas.SOURCES[n]) for n, r in rows.items()})


def refresh(spark, root, tables, dims=None):
    """One run over both facts, as the build does it."""
    dims = dims or dimensions.build_dimensions(tables)
    monthly = MonthlyFacts(spark, root)
    visits = facts.session_visits(tables["website_pageviews"])
    sales = monthly.refresh_sales(tables, dims)
    sessions = monthly.refresh_sessions(tables, dims, visits)
    return monthly, sales.months, sessions.months


def contents(monthly, name, *hidden):
    return sorted(map(str, monthly.read(name).drop(*hidden).collect()))


def expected(spark, tables, name):
    dims = dimensions.build_dimensions(tables)
    if name == "fact_sales":
        return sorted(map(str, facts.fact_sales(tables, dims).collect()))
    return sorted(map(str, facts.fact_sessions(tables, dims, facts.session_visits(tables["website_pageviews"])).collect()))


HIDDEN = ("sales_key", "session_key", "opens_order", "opens_order_of_product", "month")


def test_runs_write_touched_months_only(spark, folder):
    tables = staged(spark)
    monthly, sales, sessions = refresh(spark, folder, tables)
    assert sales == [202601, 202602, 202603] == sessions
    keys = {r.order_item_id: r.sales_key for r in monthly.read("fact_sales").collect()}
    assert sorted(keys.values()) == [1, 2, 3, 4]

    # Nothing new: nothing is written.
    monthly, sales, sessions = refresh(spark, folder, tables)
    assert (sales, sessions) == ([], [])

    # A refund of an item of January, whose order has an item in February; one more pageview in March.
    tables = staged(
        spark,
        order_item_refunds=[*ROWS["order_item_refunds"], (2, moment(3, 9), 1, 1000, 5.0)],
        website_pageviews=[*ROWS["website_pageviews"], (15, moment(3, 5, 13), 3, "/cart")],
    )
    monthly, sales, sessions = refresh(spark, folder, tables)
    assert (sales, sessions) == ([202601, 202602], [202603])
    runs = {m: x.run for m, x in monthly.table("fact_sales").months(spark).items()}
    assert runs == {202601: 2, 202602: 2, 202603: 1}
    assert {r.order_item_id: r.sales_key for r in monthly.read("fact_sales").collect()} == keys
    for name in ("fact_sales", "fact_sessions"):
        assert contents(monthly, name, *HIDDEN) == expected(spark, tables, name)
    opened = monthly.read("fact_sales", [202603]).inputFiles()
    assert opened and all("/run=1/month=202603/" in f for f in opened)


def test_items_that_move_or_leave(spark, folder):
    """An item given to another order and month; a new one; one that is gone from the source stays."""
    refresh(spark, folder, staged(spark))
    items = list(ROWS["order_items"])
    items[2] = (3, moment(3, 7), 1002, 1, 0, 49.99, 19.49)
    items = [items[0], *items[2:], (5, moment(4, 1), 1002, 2, 0, 1.0, 0.5)]
    tables = staged(spark, order_items=items)
    monthly, sales, _ = refresh(spark, folder, tables)
    # Item 2 is gone: its order's months are built again, and its row is kept.
    assert sales == [202601, 202602, 202603, 202604]
    found = {r.order_item_id: r for r in monthly.read("fact_sales").collect()}
    assert (found[2].month, found[3].month, found[3].order_id, found[5].month) == (202602, 202603, 1002, 202604)
    assert sorted(r.sales_key for r in found.values()) == [1, 2, 3, 4, 5] and found[5].sales_key == 5
    assert [k for k in (1, 3, 4, 5) if found[k].opens_order] == [1, 3]
    assert [k for k in (1, 3, 4, 5) if found[k].opens_order_of_product] == [1, 3, 4]


def test_constraints_hold_before_rows_are_readable(spark, folder):
    tables = staged(spark)
    dims = dimensions.build_dimensions(tables)
    refresh(spark, folder, tables, dims)
    # The calendar ends before this refund.
    late = staged(spark, order_item_refunds=[(1, moment(9, 1), 1, 1000, 10.0)])
    with pytest.raises(ConstraintError, match=r"unknown refund_date_key \(1 rows\)"):
        refresh(spark, folder, late, dims)
    # An amount that is missing where the table wants one.
    nameless = dict(tables)
    nameless["order_items"] = tables["order_items"].withColumn("price_usd", F.when(F.col("order_item_id") != 3, F.col("price_usd")))
    with pytest.raises(ConstraintError, match=r"NULL in price_usd \(1 rows\)"):
        refresh(spark, folder, nameless, dims)
    monthly, sales, _ = refresh(spark, folder, tables, dims)
    assert sales == [] and contents(monthly, "fact_sales", *HIDDEN) == expected(spark, tables, "fact_sales")


def test_old_months_are_deleted_once_no_kept_run_names_them(spark, folder, tmp_path):
    tables = staged(spark)
    monthly, _, _ = refresh(spark, folder, tables)
    for k in range(3):
        refunds = [(1, moment(2, 20), 1, 1000, 10.0 + k), (2, moment(2, 21), 4, 1002, 1.0)]
        monthly, _, _ = refresh(spark, folder, staged(spark, order_item_refunds=refunds))
    table = monthly.table("fact_sales")
    monthly.drop_old("fact_sales")
    prints = sorted(p.name for p in (tmp_path / "monthly/fact_sales/fingerprints/orders").glob("run=*"))
    assert prints == [f"run={n}" for n in table.runs(spark)]
    kept = sorted(str(p.relative_to(table.root)) for p in (tmp_path / "monthly/fact_sales/data").glob("*/month=*"))
    months = table.months(spark)
    assert len(table.runs(spark)) == 2 and all(f"data/run={x.run}/month={m}" in kept for m, x in months.items())
    assert len(kept) <= 5
    assert monthly.read("fact_sales").count() == 4
    with pytest.raises(ValueError, match="at least 1"):
        table.drop_old(spark, 0)


def states(spark, root, tables, dims):
    monthly = MonthlyFacts(spark, root)
    visits = facts.session_visits(tables["website_pageviews"])
    sales, sessions = monthly.refresh_sales(tables, dims), monthly.refresh_sessions(tables, dims, visits)
    kept = mart_states.MartStates(spark, monthly)
    kept.refresh(sales, sessions, visits)
    return kept


def test_marts_by_differences_equal_a_full_build(spark, folder):
    """Orders across months, refunds across months, a session that changes its channel."""
    whole = staged(
        spark,
        website_sessions=[ROWS["website_sessions"][0], (2, moment(2, 5), 100, 1, None, None, None, "mobile", None), *ROWS["website_sessions"][2:]],
        order_item_refunds=[*ROWS["order_item_refunds"], (2, moment(3, 9), 4, 1002, 5.0)],
        order_items=[*ROWS["order_items"], (6, moment(3, 1), 1000, 1, 0, 3.0, 1.0)],
    )
    dims = dimensions.build_dimensions(whole)
    states(spark, folder, staged(spark), dims)
    kept = states(spark, folder, whole, dims)
    runs = {m: x.run for m, x in kept.table("day_traffic").months(spark).items()}
    assert runs == {202601: 1, 202602: 2, 202603: 1}
    digests = facts.build_digests(whole)
    full = marts.build_marts(dims | facts.build_facts(whole, dims, digests), digests)
    for name, mart in kept.marts(dims).items():
        assert sorted(map(str, mart.select(full[name].columns).collect())) == sorted(map(str, full[name].collect())), name


def test_bitmaps_are_merged_exactly(spark):
    rows = spark.range(0, 200_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 90_000 + 1).alias("m"), (F.col("id") % 5).alias("part"))
    parts = mart_states.bitmaps(rows, ["g", "part"], "m")
    found = mart_states.bitmap_counts(parts, ["g"], "n")
    assert {r.g: r.n for r in found.collect()} == {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("m").alias("n")).collect()}


def test_build_in_monthly_mode(spark, folder):
    """A first build, then one with more; the marts equal those of a rebuild."""
    more = staged(spark, order_item_refunds=[*ROWS["order_item_refunds"], (2, moment(3, 9), 4, 1002, 5.0)])
    warehouse.build_warehouse(spark, staged(spark), f"{folder}/kept", warehouse.MONTHLY)
    kept = warehouse.build_warehouse(spark, more, f"{folder}/kept", warehouse.MONTHLY)
    whole = warehouse.build_warehouse(spark, more, f"{folder}/whole", warehouse.REBUILD)
    assert kept.volumes == whole.volumes and len(kept.checks) == 9
    for name in marts.MART_KEYS:
        tables = [VersionedTable(f"{folder}/{root}/marts/{name}").read(spark) for root in ("kept", "whole")]
        assert [sorted(map(str, t.select(tables[1].columns).collect())) for t in tables][0] == sorted(map(str, tables[1].collect())), name


def test_fact_rows_of_an_order_lie_together(spark, folder):
    """The last shuffle of the sales is by their order, whatever the sides' sizes."""
    tables = staged(spark)
    with_sizes = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in with_sizes}
    try:
        for name, value in with_sizes.items():
            spark.conf.set(name, value)
        sales = facts.fact_sales(tables, dimensions.build_dimensions(tables))
        plan = sales._jdf.queryExecution().sparkPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "order_id" in joins[0] and "order_item_id" not in joins[0]


def test_duplicate_items_are_refused_as_written(spark, folder):
    """The written rows are checked, so the joins behind them run once; nothing becomes readable."""
    twice = staged(spark, order_items=[*ROWS["order_items"], ROWS["order_items"][3]])
    dims = dimensions.build_dimensions(staged(spark))
    monthly = MonthlyFacts(spark, folder)
    with pytest.raises(DuplicateKeyError):
        monthly.refresh_sales(twice, dims)
    assert monthly.table("fact_sales").runs(spark) == []


def test_visitors_of_channels_are_kept_per_month_not_per_day(spark, folder):
    pages = [(20 + k, moment(1, 5 + k), 10 + k, "/home") for k in range(9)]
    visits = [(10 + k, moment(1, 5 + k), 100, 1, None, None, None, "desktop", None) for k in range(9)]
    tables = staged(spark, website_sessions=ROWS["website_sessions"] + visits, website_pageviews=ROWS["website_pageviews"] + pages)
    dims = dimensions.build_dimensions(tables)
    # Surrogate keys of the sessions are for one run; the bitmaps hold customers.
    monthly, states = MonthlyFacts(spark, folder), None
    paths = facts.session_visits(tables["website_pageviews"])
    sales = monthly.refresh_sales(tables, dims)
    states = mart_states.MartStates(spark, monthly)
    states.refresh(sales, monthly.refresh_sessions(tables, dims, paths), paths)
    assert states.read("channel_visitors").count() == 3
    found = {r.utm_source: r.unique_visitors for r in states.marts(dims)["marketing_performance"].collect()}
    assert found == {"(non renseigné)": 1, "gsearch": 2}


def test_one_state_of_one_fact_as_an_earlier_run_left_it(spark, folder, tmp_path):
    """A mart of sales needs no sessions; the first run's state can be made after the second run."""
    more = staged(spark, order_items=[*ROWS["order_items"], (5, moment(4, 1), 1002, 2, 0, 1.0, 0.5)])
    dims = dimensions.build_dimensions(more)
    monthly = MonthlyFacts(spark, folder)
    runs = [monthly.refresh_sales(tables, dims) for tables in (staged(spark), more)]
    assert [r.run for r in runs] == [1, 2]
    assert [monthly.read("fact_sales", run=r.run).count() for r in runs] == [4, 5]
    kept = mart_states.MartStates(spark, monthly)
    for run in runs:
        kept.refresh(run, None, None, ["product_sales"])
    assert [p.name for p in (tmp_path / "monthly/states").iterdir()] == ["product_sales"]
    assert {r.month: r.run for r in kept.table("product_sales")._manifest(spark, 1)} == {202601: 1, 202602: 1, 202603: 1}
    assert sum(r.units_sold for r in kept.read("product_sales").collect()) == 5
    # Keys are numbered apart: no copy of the fact rows is written on the way.
    scratch = {p.name: set(spark.read.parquet(str(p)).columns) for p in (tmp_path / "monthly/fact_sales/scratch").iterdir()}
    assert all(len(columns) <= 2 for columns in scratch.values())
