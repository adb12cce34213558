import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from merchlake import schemas
from merchlake.functions import dates, labels, numeric
from merchlake.operators import transforms
from merchlake.sources import files, jdbc


def test_order_margin_and_date(spark):
    df = spark.createDataFrame(
        [("2012-03-19 10:42:46", 49.99, 19.49)], "created_at string, price_usd double, cogs_usd double"
    )
    row = transforms.transform_orders(df).first()
    assert row.created_at == datetime(2012, 3, 19, 10, 42, 46)
    assert row.gross_profit == pytest.approx(30.5)


def test_unreadable_date_raises(spark):
    df = spark.createDataFrame([("soon",)], "created_at string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        transforms.transform_pageviews(df).collect()


def test_session_attributes_are_stripped_and_lowered(spark):
    row = (1, None, 1, 0, " GSearch ", "\tBRAND", "  ", "desktop", " HTTPS://X ")
    out = transforms.transform_sessions(spark.createDataFrame([row], schemas.SESSIONS)).first()
    assert (out.utm_source, out.utm_campaign, out.utm_content) == ("gsearch", "brand", "")
    assert out.http_referer == " HTTPS://X "


def test_missing_attribute_stays_missing(spark):
    row = (1, None, 1, 0, None, None, None, "mobile", None)
    out = transforms.transform_sessions(spark.createDataFrame([row], schemas.SESSIONS)).first()
    assert out.utm_source is None and out.http_referer is None


def test_iso_text_shows_the_fraction_only_when_there_is_one(spark):
    moments = [datetime(2026, 1, 1, 10), datetime(2026, 1, 1, 10, 0, 0, 1200)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    found = [r[0] for r in df.select(dates.iso_text(F.col("t"))).collect()]
    assert found == [m.isoformat() for m in moments]


@pytest.mark.parametrize(
    ("micros", "seconds"), [(0, 0), (499_999, 0), (500_000, 1), (1_499_999, 1), (2_500_000, 3)]
)
def test_seconds_round_half_up(spark, micros, seconds):
    df = spark.createDataFrame([(micros,)], "us bigint")
    assert df.select(dates.rounded_seconds(F.col("us"))).first()[0] == seconds


def test_ratios_round_half_up_and_survive_zero(spark):
    df = spark.createDataFrame([(1, 3), (5, 100000), (0, 0), (7, 0)], "n bigint, d bigint")
    rate = numeric.count_rate(F.col("n"), F.col("d"), schemas.RATE)
    found = [r[0] for r in df.select(rate).collect()]
    assert found == [Decimal("0.3333"), Decimal("0.0001"), Decimal("0.0000"), Decimal("0.0000")]


def test_channel_label_names_missing_parts(spark):
    df = spark.createDataFrame(
        [(None, None, True), ("gsearch", "brand", False)], "s string, c string, d boolean"
    )
    label = labels.channel_label(F.col("s"), F.col("c"), F.col("d"))
    assert [r[0] for r in df.select(label).collect()] == [
        "direct / sans campagne / direct",
        "gsearch / brand",
    ]


def test_csv_round_trip_keeps_types(spark, folder):
    rows = [(1, datetime(2024, 1, 1, 8, 30), 5, "/home"), (2, datetime(2024, 1, 2), 5, "/cart")]
    df = spark.createDataFrame(rows, schemas.PAGEVIEWS)
    df.write.option("header", True).csv(f"{folder}/pageviews")
    read = files.read_pageviews(spark, f"{folder}/pageviews")
    assert read.schema == schemas.PAGEVIEWS
    assert sorted(tuple(r) for r in read.collect()) == rows


def test_csv_missing_texts_and_wrong_header(spark, tmp_path):
    columns = ",".join(schemas.SESSIONS.fieldNames())
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text(f"{columns}\n1,2024-01-01 08:00:00,NULL,0,NULL,n/a,,mobile,nan\n")
    row = files.read_sessions(spark, str(good)).first()
    assert tuple(row) == (1, datetime(2024, 1, 1, 8), None, 0, None, None, None, "mobile", None)
    swapped = columns.replace("utm_source,utm_campaign", "utm_campaign,utm_source")
    bad.write_text(f"{swapped}\n1,2024-01-01 08:00:00,1,0,a,b,c,mobile,d\n")
    row = files.read_sessions(spark, str(bad)).first()
    named = row.asDict()
    assert [named[c] for c in swapped.split(",")[4:7]] == ["a", "b", "c"]
    bad.write_text(columns.replace("utm_source", "source") + "\n1,2024-01-01 08:00:00,1,0,a,b,c,mobile,d\n")
    with pytest.raises(ValueError, match="Missing columns: utm_source"):
        files.read_sessions(spark, str(bad))
    broken = tmp_path / "broken.csv"
    broken.write_text(f"{columns}\nx,2024-01-01 08:00:00,1,0,a,b,c,mobile,d\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_sessions(spark, str(broken)).collect()


def test_missing_csv_fails_at_once(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_sessions(spark, f"{folder}/nowhere.csv")


def test_products_json_and_malformed_json(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(
        json.dumps([{"product_id": 1, "created_at": "2012-03-19 08:00:00", "product_name": "Bear"}])
    )
    bad.write_text('{"product_id": 1,')
    row = files.read_products(spark, str(good)).first()
    assert tuple(row) == (1, datetime(2012, 3, 19, 8), "Bear")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_products(spark, str(bad)).collect()


def order(number, moment="2026-01-01T10:00:00"):
    return {
        "order_id": number, "created_at": moment, "website_session_id": 1, "user_id": 1,
        "primary_product_id": 1, "items_purchased": 1, "price_usd": 49.99, "cogs_usd": 19.49,
    }


def page(path, orders, total, offset):
    body = {"total": total, "limit": 2, "offset": offset, "orders": orders}
    path.write_text(json.dumps(body))


def test_order_pages_become_flat_rows(spark, tmp_path):
    page(tmp_path / "p1.json", [order(1), order(2)], 3, 0)
    page(tmp_path / "p2.json", [order(3)], 3, 2)
    df = files.read_order_pages(spark, str(tmp_path))
    assert df.schema == schemas.ORDERS
    assert sorted(r.order_id for r in df.collect()) == [1, 2, 3]


def test_empty_order_page_keeps_the_columns(spark, tmp_path):
    page(tmp_path / "p1.json", [], 0, 0)
    df = files.read_order_pages(spark, str(tmp_path))
    assert df.columns == schemas.ORDERS.fieldNames() and df.count() == 0


def test_order_page_limits(spark):
    rows = [(i, datetime(2026, 1, 1, 10), 1, 1, 1, 1, 1.0, 1.0) for i in range(1, 6)]
    df = spark.createDataFrame(rows, schemas.ORDERS)
    assert [r.order_id for r in files.order_page(df, 2, 1).collect()] == [2, 3]
    for limit, offset in ((0, 0), (5001, 0), (1, -1)):
        with pytest.raises(ValueError):
            files.order_page(df, limit, offset)
    assert files.require_order(df, 3)["order_id"] == 3
    with pytest.raises(LookupError):
        files.require_order(df, 99)


def test_jdbc_reads_are_partitioned():
    options = jdbc.jdbc_options("jdbc:x", "t", "id", (1, 10**9), 200, 10_000)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "200"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", "id", (2, 1), 200, 10_000)
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", "id", (1, 2), 0, 10_000)


def test_csv_by_name_with_line_breaks_and_decimal_whole_numbers(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "note,website_pageview_id,pageview_url,website_session_id,created_at\n"
        '"two\nlines",1.0,"/a\n""b""",7.00,2024-01-01 10:00:00\n'
        ",2,/c,8,2024-01-01 11:00:00\n"
    )
    rows = files.read_pageviews(spark, str(tmp_path / "s.csv"), multi_line=True).orderBy("website_pageview_id").collect()
    assert [(r.website_pageview_id, r.website_session_id, r.pageview_url) for r in rows] == [
        (1, 7, '/a\n"b"'),
        (2, 8, "/c"),
    ]
