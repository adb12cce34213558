"""The monthly facts of the ``*_two_builds`` queries: what their two runs share."""

from threading import Barrier

from merchlake import catalog
from merchlake.plans import monthly_facts
from merchlake.plans.monthly_facts import MonthlyFacts, Refresh
from merchlake.plans.shop import Shop
from merchlake.sources import supplied

SF_DIR = "/root/testdata/sf0.001"


def test_paths_of_both_runs_are_written_before_their_steps_read_them(spark, monkeypatch):
    plans = []

    def refresh(self, staged, dims, visits):
        plans.append(visits._jdf.queryExecution().optimizedPlan().toString())
        return Refresh([], visits, None)

    monkeypatch.setattr(MonthlyFacts, "refresh_sessions", refresh)
    assert len(catalog._TwoRuns(spark, SF_DIR).sessions) == 2
    assert len(plans) == 2 and not any("Aggregate" in plan for plan in plans)


def test_facts_that_do_not_depend_on_each_other_run_side_by_side(spark, monkeypatch):
    both = Barrier(2, timeout=120)

    def refresh(self, staged, dims, *visits):
        both.wait()
        return Refresh([], dims["dim_date"], None)

    monkeypatch.setattr(MonthlyFacts, "refresh_sales", refresh)
    monkeypatch.setattr(MonthlyFacts, "refresh_sessions", refresh)
    runs = catalog._TwoRuns(spark, SF_DIR)
    runs.need(*catalog.FACT_ROWS)
    assert [len(runs.fact(name)) for name in catalog.FACT_ROWS] == [2, 2]


def _numbered_plans(monkeypatch, module):
    """Plans of what is numbered in ``module``, which numbering reads twice."""
    plans, assign = [], module.surrogate.assign

    def recorded(df, *args, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return assign(df, *args, **more)

    monkeypatch.setattr(module.surrogate, "assign", recorded)
    return plans


def test_members_and_new_keys_are_written_before_they_are_numbered(spark, monkeypatch, folder):
    plans = _numbered_plans(monkeypatch, monthly_facts)
    shop = Shop(supplied.volume(spark, SF_DIR), folder)
    assert shop.dims["dim_customer"].count() > 0
    MonthlyFacts(spark, f"{folder}/facts").refresh_sales(shop.staged, shop.dims)
    assert len(plans) == 3
    assert not any("Aggregate" in plan or "Join" in plan for plan in plans)
