"""What the ``*_two_builds`` queries hold on disk: shuffles of ended jobs, and shuffles of whole fact rows."""

import re
import time

import pytest
from test_monthly import ROWS, moment, refresh, staged

from merchlake.operators.constraints import ConstraintError
from merchlake.plans import dimensions, facts
from merchlake.plans.mart_states import MartStates
from merchlake.plans.monthly_facts import MonthlyFacts
from merchlake.session import configure


def _shuffles(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark, folder):
    configure(spark)
    before = _shuffles(spark)
    grouped = spark.range(100_000).selectExpr("id % 977 AS k").groupBy("k")
    grouped.count().write.parquet(f"{folder}/counted")
    until = time.time() + 30
    while _shuffles(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffles(spark) - before
    assert spark.read.parquet(f"{folder}/counted").count() == 977


def _without_broadcasts(spark, plan_of):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        return plan_of()._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_whole_items_are_shuffled_by_item_only(spark, folder):
    """Products, orders and customers are found for the ids; the rows get them in the join with their refunds."""
    tables = staged(spark)
    dims = dimensions.build_dimensions(tables)
    facts.sold_items(tables, dims).write.parquet(f"{folder}/sold")
    sold = spark.read.parquet(f"{folder}/sold")
    rows = facts.fact_sales_of(tables, sold)
    assert sorted(map(str, rows.collect())) == sorted(map(str, facts.fact_sales(tables, dims).collect()))
    plan = _without_broadcasts(spark, lambda: facts.fact_sales_of(tables, sold))
    keys = set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan))
    assert keys == {"order_item_id"}


def test_written_rows_get_their_flags_and_scratch_goes(spark, folder):
    tables = staged(spark)
    monthly, *_ = refresh(spark, folder, tables)
    again = staged(spark, order_item_refunds=[*ROWS["order_item_refunds"], (2, moment(3, 9), 1, 1000, 5.0)])
    monthly, months, _ = refresh(spark, folder, again)
    assert months == [202601, 202602]
    flags = {r.order_item_id: (r.opens_order, r.opens_order_of_product) for r in monthly.read("fact_sales").collect()}
    assert flags == {1: (True, True), 2: (False, False), 3: (True, True), 4: (True, True)}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{monthly.table('fact_sales').root}/scratch/*")
    left = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    assert [s.getPath().getName() for s in left] == ["keys"]


def test_item_without_id_is_refused(spark, folder):
    items = [*ROWS["order_items"], (None, moment(3, 5, 12), 1002, 2, 0, 1.0, 0.5)]
    with pytest.raises(ConstraintError, match="NULL in order_item_id"):
        MonthlyFacts(spark, folder).refresh_sales(staged(spark, order_items=items), dimensions.build_dimensions(staged(spark)))


def test_refunds_mart_adds_up_its_state_once(spark, folder):
    tables = staged(spark)
    dims = dimensions.build_dimensions(tables)
    monthly = MonthlyFacts(spark, folder)
    states = MartStates(spark, monthly)
    states.refresh(monthly.refresh_sales(tables, dims), None, None, ["product_sales"])
    mart = states.marts(dims)["refunds_performance"]
    found = {r.product_id: (r.items_sold, r.items_refunded, float(r.refund_amount_usd), r.first_refund_date) for r in mart.collect()}
    sold = {1: (3, 1, 10.0, moment(2, 20).date()), 2: (1, 0, 0.0, None)}
    assert {p: found[p] for p in sold} == sold
    plan = _without_broadcasts(spark, lambda: states.marts(dims)["refunds_performance"])
    assert len(re.findall(r"FileScan parquet", plan)) == 1
