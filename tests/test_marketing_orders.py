"""Orders of channels are counted where sales meet their sessions."""

import re

from merchlake import catalog
from merchlake.plans.shop import open_shop

SF_DIR = "/root/testdata/sf0.001"


def test_orders_of_channels_need_no_shuffle_of_their_own(spark):
    catalog.configure(spark)
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    facts = open_shop(spark, SF_DIR, "volume").facts
    assert {n: facts[n].count() > 0 for n in facts} == {"fact_sales": True, "fact_sessions": True}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        mart = open_shop(spark, SF_DIR, "volume").marts["marketing_performance"]
        plan = mart._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    shuffled_by = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert shuffled_by and not any("order_id" in keys for keys in shuffled_by)
