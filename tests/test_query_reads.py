"""What queries write of the tables they derive."""

import datetime
import os

import pytest

from ledgerweave.plans import inputs, posting_queries, stream_queries
from ledgerweave.sources import tables as t


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """Five line items of three orders, one repeated, in the tables that make the ledger's events."""
    folder = str(tmp_path_factory.mktemp("orders"))
    day = datetime.date(1995, 1, 1)
    lines = [(1, 1, 1, 1, "O"), (1, 2, 2, 1, "O"), (2, 1, 3, 2, "F"), (2, 1, 3, 2, "F"), (3, 3, 50, 1, "O")]
    for name, rows, schema in (
        ("region", [(0, "A"), (1, "B")], "r_regionkey int, r_name string"),
        ("nation", [(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        ("customer", [(1, 0, "BUILDING", 1.5), (2, 1, "AUTO", 2.0)], "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double"),
        ("orders", [(1, 1), (2, 2), (3, 1)], "o_orderkey long, o_custkey long"),
        ("lineitem", [(o, n, p, s, 1.0, 10.0 + n, day, "A", status) for o, n, p, s, status in lines],
         "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate date,"
         " l_returnflag string, l_linestatus string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_first_transfers_writes_only_ids(spark, orders):
    ids = [r["id"] for r in stream_queries.stream_first_transfers(spark, orders).collect()]
    # two fundings, four different line items, a post of line 2 and a void of line 3
    assert len(ids) == len(set(ids)) == 8
    written = [df.columns for (app, folder, name), df in t._staged.items() if folder == orders and "event" in name]
    assert written == [["id"]]


def test_reconcile_ranges_writes_only_timestamps_of_changes(spark, orders):
    spark.createDataFrame([(1, 0), (2, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{orders}/supplier.parquet")
    assert stream_queries.reconcile_ranges(spark, orders).collect() == []
    times = t._staged[spark.sparkContext.applicationId, orders, "change_times"]
    # the wide change events are not written
    assert times.columns == ["timestamp"] and times.count() > 0
    assert (spark.sparkContext.applicationId, orders, "changes") not in t._staged
    wide = inputs.changes(spark, orders).select("timestamp")
    assert sorted(r[0] for r in times.collect()) == sorted(r[0] for r in wide.collect())


def test_commands_are_dealt_over_more_tasks_than_cores(spark, orders):
    day = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(i, day, 1 + i % 2, "view", 1.25) for i in range(20)], "event_id long, ts timestamp, user_id long, event_type string, value double"
                          ).coalesce(1).write.parquet(f"{orders}/events.parquet")
    log = t.command_log(spark, orders)
    assert log.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert sorted(r["offset"] for r in log.collect()) == list(range(20))


def test_no_loss_no_double_writes_its_events_and_first_copies_once(spark, orders):
    (row,) = posting_queries.no_loss_no_double(spark, orders).collect()
    assert (row["sent"], row["lost"]) == (8, 0)
    app = spark.sparkContext.applicationId
    sent, applied = t._staged[app, orders, "sent"], t._staged[app, orders, "applied_once"]
    # the line item that is there twice comes with a place of its own and is applied once
    assert sent.columns == ["seq", "id", "amount"] and sent.count() == 9
    assert applied.columns == ["id", "amount"] and applied.count() == 8
    assert int(row["total"]) == sum(r["amount"]["hi"] * 10**18 + r["amount"]["lo"] for r in applied.collect())


def test_topic_of_a_stream_that_reads_times_holds_no_bodies(spark, orders):
    if not os.path.exists(f"{orders}/supplier.parquet"):
        spark.createDataFrame([(1, 0), (2, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{orders}/supplier.parquet")
    seen = sorted(r["timestamp"] for r in stream_queries.stream_deduplicated(spark, orders).collect())
    assert seen == sorted(r["timestamp"] for r in inputs.changes(spark, orders).collect())
    assert t._staged[spark.sparkContext.applicationId, orders, "topic"].columns == ["topic", "partition", "offset", "timestamp"]
