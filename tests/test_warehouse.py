from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.operators import keyset, runlog, surrogate
from merchlake.operators.bucketed import BucketedTable, upsert_buckets
from merchlake.operators.tables import VersionedTable
from merchlake.operators.upsert import DuplicateKeyError, MissingKeyError
from merchlake.plans import analyses, dimensions, facts, fullrun, marts, reconciliation, warehouse
from merchlake.plans.fullrun import FullRun, RunSources
from merchlake.plans.staging import transform_all


def moment(day, hour=10, minute=0, second=0):
    return datetime(2026, 1, day, hour, minute, second)


def shop(spark):
    """Three sessions of two visitors, a buyer without a session, one unsold product."""
    rows = {
        "website_sessions": [
            (1, moment(1), 100, 0, None, None, None, "desktop", None),
            (2, moment(2), 100, 1, "gsearch", "brand", "ad", "mobile", "https://s"),
            (3, moment(2), 200, 0, "gsearch", "brand", "ad", "desktop", "https://s"),
        ],
        "website_pageviews": [
            (11, moment(1), 1, "/products"),
            (13, moment(1), 1, "/cart"),
            (12, moment(1), 1, "/home"),
            (14, moment(1, 10, 2, 30), 1, "/billing-2"),
            (15, moment(2), 2, "/home"),
            (16, moment(2), 3, "/the-forever-love-bear"),
        ],
        "products": [(1, moment(1), "Bear"), (2, moment(1), "Panda")],
        "orders": [
            (1000, moment(1, 11), 1, 100, 1, 2, 89.98, 35.0),
            (1001, moment(3, 11), 1, 100, 1, 1, 49.99, 19.49),
        ],
        "order_items": [
            (1, moment(1, 11), 1000, 1, 1, 49.99, 19.49),
            (2, moment(1, 11), 1000, 1, 0, 39.99, 15.51),
            (3, moment(3, 11), 1001, 1, 1, 49.99, 19.49),
        ],
        "order_item_refunds": [
            (1, moment(4), 1, 1000, 10.0),
            (2, moment(6), 1, 1000, 5.5),
        ],
    }
    return {n: spark.createDataFrame(r, schemas.SOURCES[n]) for n, r in rows.items()}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    staged = transform_all(shop(spark))
    result = warehouse.build_warehouse(spark, staged, root)

    def read(name):
        schema = "marts" if name in marts.MART_KEYS else "warehouse"
        return VersionedTable(f"{root}/{schema}/{name}").read(spark)

    return result, read, root


def test_build_order_and_volumes(built):
    result, _, _ = built
    assert result.volumes == {
        "dim_date": 6, "dim_product": 2, "dim_customer": 2, "dim_marketing": 2, "dim_device": 2,
        "fact_sales": 3, "fact_sessions": 3, "daily_performance": 6, "marketing_performance": 2,
        "product_performance": 2, "customer_summary": 2, "funnel_performance": 6,
        "refunds_performance": 2,
    }
    assert len(result.checks) == 9 and all(c.passed for c in result.checks)


def test_session_fact(built):
    _, read, _ = built
    row = read("fact_sessions").filter("website_session_id = 1").first()
    # Equal instants are ordered by pageview id.
    assert (row.landing_page_url, row.exit_page_url) == ("/products", "/billing-2")
    assert (row.pageview_count, row.duration_seconds, row.is_bounce) == (4, 150, False)
    assert (row.order_count, row.items_purchased) == (2, 3)
    assert (row.revenue_usd, row.gross_profit_usd) == (Decimal("139.97"), Decimal("85.48"))
    bounced = read("fact_sessions").filter("website_session_id = 2").first()
    assert (bounced.is_bounce, bounced.is_converted, bounced.revenue_usd) == (True, False, Decimal("0.00"))


def test_refunds_sum_up_on_the_last_refund_day(built):
    _, read, _ = built
    row = read("fact_sales").filter("order_item_id = 1").first()
    assert (row.refund_amount_usd, row.refund_date_key) == (Decimal("15.50"), 20260106)
    assert (row.net_revenue_usd, row.net_profit_usd) == (Decimal("34.49"), Decimal("15.00"))
    daily = {r.date_key: r for r in read("daily_performance").collect()}
    assert daily[20260106].refund_amount_usd == Decimal("15.50")
    assert daily[20260104].refund_amount_usd == Decimal("0.00")
    assert daily[20260105].sessions == 0


def test_daily_rates(built):
    _, read, _ = built
    day = read("daily_performance").filter("date_key = 20260102").first()
    assert (day.sessions, day.unique_visitors, day.bounces) == (2, 2, 2)
    assert (day.bounce_rate, day.conversion_rate) == (Decimal("1.0000"), Decimal("0.0000"))
    first = read("daily_performance").filter("date_key = 20260101").first()
    assert (first.orders, first.items_purchased, first.average_order_value_usd) == (1, 2, Decimal("89.98"))


def test_unsold_product_and_channel_attribution(built):
    _, read, _ = built
    unsold = read("product_performance").filter("product_id = 2").first()
    assert (unsold.units_sold, unsold.refund_rate) == (0, Decimal("0.0000"))
    direct = read("marketing_performance").filter("is_direct").first()
    assert (direct.orders, direct.gross_revenue_usd) == (2, Decimal("139.97"))
    assert direct.utm_source == "(non renseigné)" and direct.utm_campaign == "(non renseignée)"


def test_customers(built):
    _, read, _ = built
    found = {r.user_id: r for r in read("customer_summary").collect()}
    assert found[100].customer_status == "acheteur récurrent" and found[100].is_repeat_buyer
    assert (found[100].order_count, found[100].last_order_date) == (2, date(2026, 1, 3))
    assert found[100].days_to_first_order == 0
    assert found[200].customer_status == "prospect" and found[200].last_order_date is None


def test_net_revenue_is_the_same_in_every_mart(built):
    _, read, _ = built

    def total(name, column):
        return read(name).agg(F.sum(column)).first()[0]

    expected = Decimal("124.47")
    assert total("daily_performance", "net_revenue_usd") == expected
    assert total("product_performance", "net_revenue_usd") == expected
    assert total("marketing_performance", "net_revenue_usd") == expected
    assert total("customer_summary", "lifetime_revenue_usd") == expected
    assert total("refunds_performance", "net_revenue_usd") == expected
    assert total("funnel_performance", "sessions") == read("fact_sessions").count()


def test_second_build_changes_nothing(spark, built):
    result, read, root = built
    before = {n: sorted(map(str, read(n).collect())) for n in result.volumes}
    again = warehouse.build_warehouse(spark, transform_all(shop(spark)), root)
    assert again.volumes == result.volumes
    assert {n: sorted(map(str, read(n).collect())) for n in result.volumes} == before


def test_fact_row_keys_on_demand(spark, built):
    _, _, root = built
    numbered = warehouse.number_facts(spark, root, "fact_sales")
    assert sorted(r.sales_key for r in numbered.collect()) == [1, 2, 3]


def test_buyer_without_session_is_kept(spark):
    tables = shop(spark)
    orders = tables["orders"].unionByName(
        spark.createDataFrame([(9, moment(5), 99, 900, 1, 1, 1.0, 0.5)], schemas.ORDERS)
    )
    found = dimensions.customer_members(tables["website_sessions"], orders)
    row = found.filter("user_id = 900").first()
    assert (row.first_session_at, row.is_buyer, row.has_repeat_session) == (None, True, False)


def test_failed_gate_stops_before_the_marts(spark, folder):
    staged = dict(transform_all(shop(spark)))
    # A session nobody viewed a page in never becomes a fact.
    lost = spark.createDataFrame([(4, moment(2), 1, 0, None, None, None, "mobile", None)], schemas.SESSIONS)
    staged["website_sessions"] = staged["website_sessions"].unionByName(lost)
    with pytest.raises(reconciliation.ReconciliationError, match="volume_sessions: attendu=4, obtenu=3"):
        warehouse.build_warehouse(spark, staged, folder)
    assert VersionedTable(f"{folder}/warehouse/fact_sessions").exists(spark)
    assert not VersionedTable(f"{folder}/marts/daily_performance").exists(spark)


def test_calendar(spark):
    days = dimensions.build_dim_date(spark, date(2026, 1, 1), date(2026, 1, 4)).orderBy("date").collect()
    assert [d.day_name for d in days] == ["jeudi", "vendredi", "samedi", "dimanche"]
    assert [d.is_weekend for d in days] == [False, False, True, True]
    assert (days[3].day_of_week, days[0].month_name, days[0].date_key) == (7, "janvier", 20260101)
    with pytest.raises(ValueError):
        dimensions.build_dim_date(spark, date(2026, 1, 3), date(2026, 1, 1))


def test_calendar_of_empty_staging_raises(spark):
    empty = {n: spark.createDataFrame([], s) for n, s in schemas.SOURCES.items()}
    with pytest.raises(Exception, match="empty staging"):
        dimensions.build_dim_date_from_staging(empty).collect()


def test_literal_and_missing_attribute_are_one_member(spark):
    rows = [
        (1, None, 1, 0, "g", None, None, "mobile", None),
        (2, None, 1, 0, "g", "(non renseignée)", None, "mobile", None),
    ]
    members = dimensions.marketing_members(spark.createDataFrame(rows, schemas.SESSIONS))
    assert members.count() == 1


# analyses


def frame(spark, columns, *rows):
    return spark.createDataFrame(list(rows), columns)


def test_monthly_sales(spark):
    columns = (
        "date date, sessions bigint, orders bigint, gross_revenue_usd decimal(14,2), "
        "refund_amount_usd decimal(14,2), net_revenue_usd decimal(14,2), net_profit_usd decimal(14,2)"
    )
    d = Decimal
    daily = frame(
        spark,
        columns,
        (date(2026, 1, 1), 100, 10, d(1000), d(50), d(950), d(500)),
        (date(2026, 1, 2), 200, 30, d(3000), d(100), d(2900), d(1500)),
        (date(2026, 2, 1), 0, 0, d(0), d(10), d(-10), d(-10)),
    )
    january, february = analyses.analyse_sales(daily).collect()
    assert (january.month, january.net_revenue_usd) == ("2026-01", d(3850))
    assert january.conversion_rate == pytest.approx(40 / 300)
    assert (february.conversion_rate, february.average_order_value_usd) == (0.0, 0.0)
    assert analyses.top_month(analyses.analyse_sales(daily)).first().month == "2026-01"


def test_segments(spark):
    customers = frame(
        spark,
        "customer_status string, user_id bigint, order_count bigint, "
        "lifetime_revenue_usd double, lifetime_profit_usd double",
        ("acheteur", 1, 1, 100.0, 50.0),
        ("acheteur", 2, 1, 60.0, 20.0),
        ("prospect", 3, 0, 0.0, 0.0),
    )
    buyers, prospects = analyses.analyse_customers(customers).collect()
    assert (buyers.customers, buyers.revenue_per_customer_usd) == (2, 80.0)
    assert (prospects.customers, prospects.revenue_per_customer_usd) == (1, 0.0)


def test_funnel(spark):
    steps = ["product_list", "product_detail", "cart", "shipping", "billing", "order"]
    columns = ", ".join(["sessions bigint", *[f"{s}_sessions bigint" for s in steps]])
    rows = analyses.analyse_funnel(
        frame(spark, columns, (200, 100, 80, 40, 30, 20, 10), (200, 100, 80, 40, 30, 20, 10))
    ).collect()
    assert [r.stage for r in rows][0::6] == ["Sessions", "Commande"]
    assert (rows[-1].sessions, rows[-1].rate_from_start, rows[-1].rate_from_previous) == (20, 0.05, 0.5)
    empty = analyses.analyse_funnel(frame(spark, columns, (0, 0, 0, 0, 0, 0, 0))).collect()
    assert {r.rate_from_previous for r in empty} == {1.0}
    assert [r.rate_from_start for r in empty][1:] == [0.0] * 6


def test_channels_keep_missing_groups(spark):
    columns = (
        "utm_source string, utm_campaign string, is_direct boolean, sessions bigint, "
        "orders bigint, net_revenue_usd double, net_profit_usd double"
    )
    rows = analyses.analyse_marketing(
        frame(
            spark,
            columns,
            ("g", "brand", False, 100, 10, 1000.0, 500.0),
            ("g", "brand", False, 300, 40, 2000.0, 900.0),
            (None, None, True, 10, 0, 0.0, 0.0),
        )
    ).collect()
    assert (rows[0].sessions, rows[0].net_revenue_usd) == (400, 3000.0)
    assert (rows[0].conversion_rate, rows[0].revenue_per_session_usd) == (50 / 400, 3000 / 400)
    assert rows[1].utm_source is None


# full run


def sources(spark, tables):
    return RunSources(
        tables["website_sessions"], tables["website_pageviews"], tables["products"],
        lambda position: keyset.after(tables["orders"], position), tables["order_items"],
        tables["order_item_refunds"],
    )


STEPS = [  # launch order
    "staging_sessions", "staging_pageviews", "staging_products", "staging_orders",
    "staging_order_items", "staging_refunds", "warehouse_et_marts",
]


def test_full_run_twice(spark, folder):
    tables = shop(spark)
    bad = spark.createDataFrame([(2000, moment(1), 1, 100, 1, 1, -5.0, 1.0)], schemas.ORDERS)
    tables["orders"] = tables["orders"].unionByName(bad)
    first = FullRun(spark, folder)
    run_id = first.run(sources(spark, tables))
    assert first.rows == {"extracted": 19, "loaded": 18, "rejected": 1}
    steps = runlog.run_steps(fullrun.step_log(spark, folder), run_id).collect()
    assert [s.step_name for s in steps] == STEPS
    assert {s.status for s in steps} == {"SUCCESS"}

    second = FullRun(spark, folder)
    second.run(sources(spark, tables))
    # The orders are behind the checkpoint now, the rejected one included.
    assert second.rows == {"extracted": 16, "loaded": 16, "rejected": 0}
    assert second.orders.read(spark).count() == 2
    loaded = warehouse.load_marts(spark, folder)
    headline = analyses.headline_metrics(analyses.build_analyses(loaded))
    found = {r.metric: (r.label, r.amount) for r in headline.collect()}
    assert found["best_month"] == ("2026-01", 124.47)
    assert found["repeat_buyers"] == ("1", 124.47)
    assert found["top_product"][0] == "Bear"


def test_analyses_are_exported(spark, built, tmp_path):
    _, _, root = built
    built_analyses = fullrun.report(spark, root, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(built_analyses)
    assert len(list((tmp_path / "funnel_overall").glob("*.csv"))) == 1
    products = spark.read.option("header", True).csv(str(tmp_path / "product_performance"))
    assert [r.product_name for r in products.collect()] == ["Bear", "Panda"]


def test_failed_run_is_logged(spark, folder):
    tables = shop(spark)
    tables["products"] = tables["products"].filter("product_id = 99")
    broken = FullRun(spark, folder)
    with pytest.raises(reconciliation.ReconciliationError):
        # No product: every item is rejected, so sales no longer match orders' sessions.
        tables["website_pageviews"] = tables["website_pageviews"].filter("website_session_id <> 2")
        broken.run(sources(spark, tables))
    state = runlog.latest_run(fullrun.run_log(spark, folder)).first()
    assert state.status == "FAILED" and "volume_sessions" in state.error_message
    steps = runlog.run_steps(fullrun.step_log(spark, folder), broken.run_id).collect()
    assert [s.status for s in steps] == ["SUCCESS"] * 6 + ["FAILED"]


def test_shared_and_separate_visits_agree(spark):
    pageviews = shop(spark)["website_pageviews"]
    both = facts.session_visits(pageviews)
    path = facts.pageviews_by_session(pageviews)
    steps = facts.page_steps_by_session(pageviews)
    assert sorted(map(str, both.select(*path.columns).collect())) == sorted(map(str, path.collect()))
    assert sorted(map(str, both.select(*steps.columns).collect())) == sorted(map(str, steps.collect()))


def test_broken_keys_are_refused_and_taken_back(spark, folder):
    builder = warehouse.WarehouseBuilder(spark, folder)
    for ids, error in (([1, None], MissingKeyError), ([1, 1], DuplicateKeyError)):
        rows = spark.createDataFrame([(i, 5.0) for i in ids], "order_item_id long, price double")
        with pytest.raises(error):
            builder._take_over("fact_sales", rows, ["order_item_id"])
        assert not builder.table("fact_sales").exists(spark)


def test_product_without_id_stops_the_build(spark, folder):
    tables = shop(spark)
    kind = tables["products"].schema["product_id"].dataType
    unnamed = tables["products"].limit(1).withColumn("product_id", F.lit(None).cast(kind))
    tables["products"] = tables["products"].unionByName(unnamed)
    with pytest.raises(MissingKeyError):
        FullRun(spark, folder).run(sources(spark, tables))


def test_stored_customers_are_not_shuffled(spark, folder):
    """The second build joins the stored buckets as they lie; keys last, and readers see one table."""
    table = BucketedTable(f"{folder}/t", ("user_id",), 8)
    first = spark.range(1, 501).select(F.col("id").alias("user_id"), F.lit("old").alias("v"))
    table.write(surrogate.assign(first, ["user_id"], "customer_key"))
    source = spark.range(401, 701).select(F.col("id").alias("user_id"), F.lit("new").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        state = upsert_buckets(table.read_buckets(spark), source, ["user_id"], "customer_key")
        before = {r.user_id: r.customer_key for r in table.read(spark).collect()}
        plan = state._jdf.queryExecution().executedPlan().toString()
        table.write(state)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    scans = [k for k, line in enumerate(lines) if "FileScan" in line]
    assert len(scans) >= 2 and all("Bucketed: true" in lines[k] for k in scans)
    for k in scans:
        # From a scan upwards to the join that reads it there is no exchange.
        at, above = depth[k], []
        for j in range(k - 1, -1, -1):
            if depth[j] < at:
                at = depth[j]
                above.append(lines[j])
                if "Join" in lines[j]:
                    break
        assert above and not any("Exchange" in line for line in above), above
    after = {r.user_id: (r.customer_key, r.v) for r in table.read(spark).collect()}
    assert len(after) == 700 and all(after[u][0] == k for u, k in before.items())
    assert sorted(k for k, _ in after.values()) == list(range(1, 701))
    assert {v for u, (_, v) in after.items() if u > 400} == {"new"}
    assert spark.catalog.listTables() == [] or not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
