from types import SimpleNamespace

import pytest

from merchlake import session


def test_settings_can_be_changed_in_a_running_session(spark):
    assert all(spark.conf.isModifiable(name) for name in session.SETTINGS)
    session.configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def fake(master, shared):
    return SimpleNamespace(
        sparkContext=SimpleNamespace(applicationId=f"{master}-{shared}", master=master),
        conf=SimpleNamespace(get=lambda name, default: shared or default),
    )


def test_work_folder_is_shared_on_a_cluster():
    folder = session.work_folder(fake("spark://m:7077", "hdfs://n/chk/"))
    assert folder.startswith("hdfs://n/chk/merchlake-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_folder(fake("yarn", None))


def test_splits_are_bounded_unless_the_cluster_says_otherwise(spark):
    split = "spark.sql.files.maxPartitionBytes"
    session.configure(spark)
    assert spark.conf.get(split) == session.SPLIT_BYTES
    try:
        spark.conf.set(split, "1m")
        session.configure(spark)
        assert spark.conf.get(split) == "1m"
    finally:
        spark.conf.unset(split)
        session.configure(spark)


def test_broadcasts_are_bounded_by_rows_in_memory(spark, folder):
    """A table that is small as a file but not as a hash table is joined without the driver."""
    session.configure(spark)
    spark.range(0, 4_000_000).selectExpr("id AS k", "id % 7 AS v").write.parquet(f"{folder}/wide")
    joined = spark.range(0, 10_000_000, numPartitions=4).toDF("k").join(spark.read.parquet(f"{folder}/wide"), "k")
    assert joined.count() == 4_000_000
    plan = joined.groupBy("v").count()
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text.split("Initial Plan")[0] and "BroadcastHashJoin" not in text.split("Initial Plan")[0]
