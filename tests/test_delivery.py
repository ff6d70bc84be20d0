import datetime as dt

import pytest

from siltstone.operators.delivery import DeliveryStore, ingest_in_steps
from siltstone.session import hadoop_path, joined_by_part

DDL = "delivery_id long, batch_id int, delivered_at timestamp, conversation_id long, platform_id long, edit_date timestamp, text string"
T = dt.datetime


def row(i, batch, day, c, p, edit=None, text="x"):
    return (i, batch, T(2017, 3, day), c, p, edit and T(2017, 3, edit), text)


def kept(store):
    return sorted((r["conversation_id"], r["platform_id"], r["delivery_id"], r["copies"]) for r in store.rows().filter("conversation_id is not null and platform_id is not null").collect())


def test_one_copy_over_batches(spark):
    store = DeliveryStore(spark)
    assert store.merge(spark.createDataFrame([row(1, 1, 1, 7, 1), row(2, 1, 1, 7, 1), row(3, 1, 2, 7, 2)], DDL)) == []
    # a late copy from day 3 rewrites the partition of day 1 only
    assert store.merge(spark.createDataFrame([row(4, 2, 3, 7, 1), row(5, 2, 3, 8, 1)], DDL)) == ["20170301"]
    assert kept(store) == [(7, 1, 4, 3), (7, 2, 3, 1), (8, 1, 5, 1)]


def test_latest_edit_wins_over_later_delivery(spark):
    store = DeliveryStore(spark)
    store.merge(spark.createDataFrame([row(1, 1, 1, 7, 1, edit=9)], DDL))
    store.merge(spark.createDataFrame([row(2, 2, 5, 7, 1)], DDL))
    assert kept(store) == [(7, 1, 1, 2)]


def test_null_identifiers_stay(spark):
    store = DeliveryStore(spark)
    store.merge(spark.createDataFrame([row(1, 1, 1, None, 1), row(2, 1, 1, None, 1), row(3, 1, 1, 7, None), row(4, 1, 1, 7, 1)], DDL))
    assert sorted(r["delivery_id"] for r in store.rows().collect()) == [1, 2, 3, 4]


def test_order_of_batches_does_not_matter(spark):
    rows = [row(i, 1 + i % 4, 1 + i % 5, i % 3, i % 7, edit=(i % 6) or None) for i in range(1, 60)]
    df = spark.createDataFrame(rows, DDL)
    one = DeliveryStore(spark)
    one.merge(df)
    assert kept(one) == kept(ingest_in_steps(df, 4))


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], DDL)
    assert ingest_in_steps(empty).rows().count() == 0
    store = DeliveryStore(spark)
    store.merge(spark.createDataFrame([row(1, 1, 1, 7, 1)], DDL).selectExpr("*", "5 as copies", "'z' as _s_part"))
    r = store.rows().first()
    assert (r["copies"], r["copies_in"]) == (1, 5)
    store.merge(empty.selectExpr("*", "5 as copies", "'z' as _s_part"))
    assert store.rows().count() == 1


def test_readers_see_whole_states(spark):
    store = DeliveryStore(spark)
    store.merge(spark.createDataFrame([row(1, 1, 1, 7, 1)], DDL))
    before = store.rows()
    store.merge(spark.createDataFrame([row(2, 2, 2, 7, 1)], DDL))
    assert [r["delivery_id"] for r in before.collect()] == [1]
    assert [r["delivery_id"] for r in store.rows().collect()] == [2]


def test_another_session_goes_on(spark):
    store = DeliveryStore(spark)
    store.merge(spark.createDataFrame([row(1, 1, 1, 7, 1)], DDL))
    again = DeliveryStore(spark, store.root)
    assert again.merge(spark.createDataFrame([row(2, 2, 4, 7, 1), row(3, 2, 4, 7, 2)], DDL)) == ["20170301"]
    assert kept(again) == [(7, 1, 2, 2), (7, 2, 3, 1)]


def test_a_writer_that_died_leaves_nothing_wrong(spark, monkeypatch):
    store = DeliveryStore(spark)
    store.merge(spark.createDataFrame([row(1, 1, 1, 7, 1)], DDL))
    batch = spark.createDataFrame([row(2, 2, 2, 8, 1)], DDL)
    with monkeypatch.context() as m:
        m.setattr(DeliveryStore, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.merge(batch)
    fs, p = hadoop_path(spark, f"{store.root}/v00000002")
    fs.delete(p, True)
    store.merge(batch)
    store.merge(spark.createDataFrame([row(3, 3, 3, 8, 1)], DDL))
    assert kept(store) == [(7, 1, 1, 1), (8, 1, 3, 2)]


def test_old_versions_go(spark):
    store = DeliveryStore(spark)
    for i in range(1, 6):
        store.merge(spark.createDataFrame([row(i, i, 1, 7, 1)], DDL))
    fs, p = hadoop_path(spark, store.root)
    files = [f for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{store.root}/v*").select("path").collect()]
    assert len(files) == 2 and kept(store) == [(7, 1, 5, 5)]


def test_a_batch_reads_the_index_buckets_it_has_slots_in(spark):
    store = DeliveryStore(spark)
    store.merge(spark.createDataFrame([row(i, 1, 1 + i % 9, i % 50, i) for i in range(3000)], DDL))
    index = store._open_index(store._manifest()[1])
    fresh = store._slot(spark.createDataFrame([row(9000, 2, 3, 7, 7)], DDL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joined_by_part(spark):
            plan = store._located(fresh, index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the one exchange is the batch's
    assert "SelectedBucketsCount: 1 out of 8" in plan and plan.count("Exchange hashpartitioning") == 1
