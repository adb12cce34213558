import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.operators import rules, validators
from merchlake.operators.split import flag_first, split


def flags(df, rule):
    return [r.ok for r in df.select("n", rule.alias("ok")).orderBy("n").collect()]


def numbered(spark, values, kind):
    return spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")


@pytest.mark.parametrize(
    ("rule", "values", "expected"),
    [
        (lambda: rules.not_null("v"), [1.0, None, 3.0], [True, False, True]),
        (lambda: rules.number_not_null("v"), [1.0, None, math.nan], [True, False, False]),
        (lambda: rules.is_non_negative("v"), [-1.0, 0.0, 5.0, None, math.nan], [False, True, True, False, False]),
        (lambda: rules.is_positive("v"), [0.0, 1.0, None, math.nan], [False, True, False, False]),
        (lambda: rules.is_in_set("v", [1.0, 2.0]), [1.0, 3.0, None], [True, False, False]),
    ],
)
def test_number_rules(spark, rule, values, expected):
    assert flags(numbered(spark, values, "double"), rule()) == expected


def test_blank_text_fails_but_missing_text_passes(spark):
    values = ["/home", "", "  ", "\t ", None]
    df = numbered(spark, values, "string")
    assert flags(df, rules.not_empty_string("v")) == [True, False, False, False, True]


def test_first_occurrence_is_unique_and_nulls_are_one_key(spark):
    df = numbered(spark, [1, 2, 2, 3, None, None], "int")
    found = {r.n: r._first for r in flag_first(df, "v").collect()}
    assert found == {0: True, 1: True, 2: False, 3: True, 4: True, 5: False}


def test_member_flag_ignores_nulls_on_both_sides(spark):
    df = numbered(spark, [1, 2, None], "int")
    reference = numbered(spark, [1, 1, None], "int").select(F.col("v").alias("id"))
    flagged = rules.add_member_flag(df, "v", reference, "id", "known")
    assert {r.n: r.known for r in flagged.collect()} == {0: True, 1: False, 2: False}


def test_split_counts(spark):
    df = numbered(spark, [1, -1, 2], "int")
    parts = split(df, "n", rules.is_non_negative("v"))
    assert parts.valid.count() == 2
    assert parts.rejected.count() == 1
    assert parts.counts.first().asDict() == {
        "rows_extracted": 3,
        "rows_loaded": 2,
        "rows_rejected": 1,
    }


def test_duplicate_of_a_rejected_first_row_is_rejected_too(spark):
    # The first row of key 1 (lowest values) breaks a rule; its repeat stays a repeat.
    df = spark.createDataFrame([(1, -5.0), (1, 10.0), (2, 3.0)], "id int, price double")
    parts = split(df, "id", rules.is_non_negative("price"))
    assert [tuple(r) for r in parts.valid.collect()] == [(2, 3.0)]
    assert sorted(tuple(r) for r in parts.rejected.collect()) == [(1, -5.0), (1, 10.0)]


ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 4)),
        st.one_of(st.none(), st.integers(-1, 2)),
        st.one_of(st.none(), st.integers(1, 3)),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts_count=st.integers(1, 4))
def test_split_matches_a_plain_keep_first_and_loses_nothing(spark, rows, parts_count):
    from merchlake.operators.split import Membership

    df = spark.createDataFrame(rows, "id int, v int, ref int").repartition(parts_count)
    known = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    parts = split(df, "id", rules.is_non_negative("v"), members=[Membership("ref", known, "k")])
    valid = Counter(tuple(r) for r in parts.valid.collect())
    rejected = Counter(tuple(r) for r in parts.rejected.collect())

    first = {}
    for row in sorted(rows, key=lambda r: [(x is not None, x or 0) for x in r[1:]]):
        first.setdefault(row[0], row)
    expected = Counter(
        r for r in first.values() if r[1] is not None and r[1] >= 0 and r[2] in (1, 2)
    )
    assert valid == expected
    assert valid + rejected == Counter(rows)


def test_hot_key_is_cut_before_it_reaches_one_task(spark):
    """A third of the rows share one key, most of them as exact copies."""
    hot = spark.range(3000, numPartitions=6).select(F.lit(7).alias("id"), F.lit(1).alias("v"))
    rest = spark.range(6000, numPartitions=6).select(
        (F.col("id") + 100).cast("int").alias("id"), F.lit(1).alias("v")
    )
    parts = split(hot.unionByName(rest), "id", rules.is_non_negative("v"))
    assert parts.valid.count() == 6001
    assert parts.rejected.count() == 2999
    plan = parts.valid._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def orders(spark, *rows):
    return spark.createDataFrame(
        [(i, None, s, u, 1, n, p, c) for i, s, u, n, p, c in rows], schemas.ORDERS
    )


def test_order_rules(spark):
    df = orders(
        spark,
        (1, 10, 20, 1, 49.99, 19.49),
        (2, 10, 20, 1, -10.0, 1.0),
        (3, None, 20, 1, 1.0, 1.0),
        (4, 10, None, 1, 1.0, 1.0),
        (5, 10, 20, 0, 1.0, 1.0),
        (6, 10, 20, 1, 1.0, math.nan),
        (7, 10, 20, 1, 1.0, 1.0),
        (7, 10, 20, 1, 1.0, 1.0),
    )
    parts = validators.validate_orders(df)
    assert sorted(r.order_id for r in parts.valid.collect()) == [1, 7]
    assert sorted(r.order_id for r in parts.rejected.collect()) == [2, 3, 4, 5, 6, 7]


def test_device_is_checked_before_normalisation(spark):
    rows = [
        (i, None, 1, 0, None, None, None, device, None)
        for i, device in enumerate(["desktop", "mobile", "Desktop", "tablet", None])
    ]
    parts = validators.validate_sessions(spark.createDataFrame(rows, schemas.SESSIONS))
    assert sorted(r.device_type for r in parts.valid.collect()) == ["desktop", "mobile"]


def test_items_and_refunds_need_known_references(spark):
    items = spark.createDataFrame(
        [(1, None, 10, 5, 1, 1.0, 0.5), (2, None, 99, 5, 1, 1.0, 0.5), (3, None, 10, 6, 1, 1.0, 0.5)],
        schemas.ORDER_ITEMS,
    )
    known = orders(spark, (10, 1, 1, 1, 1.0, 1.0))
    products = spark.createDataFrame([(5, None, "bear")], schemas.PRODUCTS)
    valid_items = validators.validate_order_items(items, known, products)
    assert [r.order_item_id for r in valid_items.valid.collect()] == [1]
    assert sorted(r.order_item_id for r in valid_items.rejected.collect()) == [2, 3]

    refunds = spark.createDataFrame(
        [(1, None, 1, 10, 0.5), (2, None, 2, 10, 0.5), (3, None, 1, 99, 0.5), (4, None, 1, 10, -1.0)],
        schemas.REFUNDS,
    )
    parts = validators.validate_refunds(refunds, valid_items.valid, known)
    assert [r.order_item_refund_id for r in parts.valid.collect()] == [1]
    assert sorted(r.order_item_refund_id for r in parts.rejected.collect()) == [2, 3, 4]


def test_few_unknown_references_go_without_a_join(spark):
    """The rows are shuffled by their key alone; many unknown references are joined as before."""
    from merchlake.operators.split import Membership

    rows = spark.createDataFrame([(i, i % 7) for i in range(70)] + [(70, None)], "id int, ref int")
    known = spark.createDataFrame([(k,) for k in range(5)], "k int")
    parts = split(rows, "id", members=[Membership("ref", known, "k")])
    kept = sorted(r.id for r in parts.valid.collect())
    assert kept == [i for i in range(70) if i % 7 < 5]
    assert "Join" not in parts.valid._jdf.queryExecution().optimizedPlan().toString()
    far = rows.withColumn("ref", F.col("ref") + F.when(F.col("id") > 6, F.col("id") * 100).otherwise(0))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("merchlake.operators.split.FEW_UNKNOWN", 10)
        joined = split(far, "id", members=[Membership("ref", known, "k")])
        assert sorted(r.id for r in joined.valid.collect()) == [0, 1, 2, 3, 4]
        assert "Join" in joined.valid._jdf.queryExecution().optimizedPlan().toString()
    assert joined.rejected.count() == 66
