"""CSV exports with line breaks inside quotes, cut into many splits and into chunks of rows."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from merchlake.sources import files, quoted_csv
from merchlake.streaming import pageviews

OPTIONS = files._CSV_OPTIONS


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def export(tmp_path, name, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator=end).writerows([("id", "note", "x"), *rows])
    (tmp_path / name).write_text(out.getvalue(), newline="")


def texts(rng, n):
    parts = ["word", "\n", '"', ",", " ", "é", "line\nbreak", '""', "\n\n", "x" * 40]
    return [(str(k), "n" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) + "e", "z") for k in range(n)]


def test_records_across_splits(spark, tmp_path, small_splits):
    """Three files of many splits; some records are longer than a split."""
    rng = random.Random(3)
    wanted = {}
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n"), ("c.csv", "\n")):
        rows = texts(rng, 120)
        rows[50] = ("50", "long " + "line,\n" * 200 + '"', "z")
        export(tmp_path, name, rows, end)
        wanted[name] = [(k + 1, *r) for k, r in enumerate(rows)]
    lines = quoted_csv._lines(spark, str(tmp_path))
    assert lines.select("file", "block").distinct().count() > 50
    assert lines.rdd.getNumPartitions() > 20
    found = quoted_csv.read(spark, str(tmp_path), OPTIONS)
    by_file = {}
    for r in found.orderBy("row").collect():
        by_file.setdefault(r.file, []).append((r.row, r.id, r.note, r.x))
    assert sorted(by_file.values()) == sorted(wanted.values())


def test_refused_files(spark, tmp_path, small_splits):
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "a.csv").write_text('id,note,x\n1,"open,2\n' + "3,b,c\n" * 200)
    with pytest.raises(Exception, match="ends inside quotes"):
        quoted_csv.read(spark, str(tmp_path / "open"), OPTIONS).collect()
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "a.csv").write_text("id,note,x\n1,a,b\n")
    (tmp_path / "other" / "b.csv").write_text("id,x,note\n1,a,b\n")
    with pytest.raises(Exception, match="header does not conform"):
        quoted_csv.read(spark, str(tmp_path / "other"), OPTIONS).collect()
    (tmp_path / "short").mkdir()
    (tmp_path / "short" / "a.csv").write_text("id,note,x\n1,a\n")
    with pytest.raises(Exception, match="MALFORMED"):
        quoted_csv.read(spark, str(tmp_path / "short"), OPTIONS).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        quoted_csv.read(spark, str(tmp_path / "none"), OPTIONS)


def test_header_alone_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note,x\n")
    assert quoted_csv.read(spark, str(tmp_path), OPTIONS).count() == 0
    (tmp_path / "a.csv").write_text('id,note,x\n\n1,"a\n\nb",c\n\n\r\n2,,\n\n')
    found = quoted_csv.read(spark, str(tmp_path), OPTIONS).orderBy("row").collect()
    assert [(r.row, r.id, r.note, r.x) for r in found] == [(1, "1", "a\n\nb", "c"), (2, "2", None, None)]


def pageview(number, url="/home", session="1"):
    return f"{number},2026-01-01 10:00:00,{session},{url}\n"


HEADER = "website_pageview_id,created_at,website_session_id,pageview_url\n"


def test_one_file_in_chunks(spark, tmp_path):
    """250,000 rows are three chunks."""
    (tmp_path / "p.csv").write_text(HEADER + "".join(pageview(k) for k in range(250_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        rows = files.read_pageview_chunks(spark, str(tmp_path / "p.csv"))
        found = {r.chunk: (r.n, r.low, r.high) for r in rows.groupBy("chunk").agg(
            F.count("*").alias("n"), F.min("website_pageview_id").alias("low"), F.max("website_pageview_id").alias("high")
        ).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {0: (100_000, 0, 99_999), 1: (100_000, 100_000, 199_999), 2: (50_000, 200_000, 249_999)}
    with pytest.raises(ValueError, match="greater than zero"):
        files.read_pageview_chunks(spark, str(tmp_path / "p.csv"), 0)


def test_ids_are_unique_within_a_chunk(spark, tmp_path, folder):
    """The first row of an id in a chunk stays; a later chunk may have it again."""
    (tmp_path / "p.csv").write_text(
        HEADER + pageview(7, "/z") + pageview(7, "/a") + pageview(8) + pageview(7, "/late") + pageview(9, '"  "') + pageview(10, "/x", "")
    )
    for _ in range(2):
        counts = pageviews.load_chunks(spark, str(tmp_path / "p.csv"), f"{folder}/staged", f"{folder}/rejected", "run-1", 3)
        assert sorted((r.chunk, r.rows_extracted, r.rows_loaded, r.rows_rejected) for r in counts.collect()) == [(0, 3, 2, 1), (1, 3, 1, 2)]
    staged = pageviews.staged_pageviews(spark, f"{folder}/staged").collect()
    assert sorted((r.website_pageview_id, r.pageview_url) for r in staged) == [(7, "/late"), (7, "/z"), (8, "/home")]
    assert spark.read.option("header", True).csv(f"{folder}/rejected").count() == 3
