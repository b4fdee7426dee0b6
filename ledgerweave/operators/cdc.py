"""Change events → records with a self-describing, resumable checkpoint."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.operators.scan import number_rows, previous
from ledgerweave.session import stage

KEYS = ("debit_account_id", "credit_account_id", "ledger", "transfer_id")
MAX_WINDOW = 2730  # fixed value: the most events one window may ask for
#: Ends of windows that are sent to the tasks, at most (8 bytes each); more are joined.
SENT_ENDS = 1 << 18


def window_scan(events: DataFrame, checkpoint: int, limit: int) -> DataFrame:
    """The next window: events above the cursor, in order, at most ``limit``."""
    return events.filter(F.col("timestamp") > checkpoint).orderBy("timestamp").limit(limit)


def ascending_violations(events: DataFrame, order: str, keys: list[str] | None = None) -> DataFrame:
    """Events, in the order given, whose timestamp does not exceed the one before."""
    checked = previous(events, keys or [], order, "timestamp", "previous_timestamp")
    return checked.filter("timestamp <= previous_timestamp")


def checkpoints(events: DataFrame, size: int, start: int = 0) -> DataFrame:
    """Add ``window``, ``is_closing`` and ``checkpoint`` to change events.

    Every record claims the checkpoint its window started from; the closing one,
    written last, claims its own timestamp.
    """
    # only timestamps are numbered and written
    numbered = number_rows(events.select("timestamp"), ["timestamp"]).selectExpr(
        "timestamp", f"(rn - 1) div {size} as window")
    ends = numbered.groupBy("window").agg(F.max("timestamp").alias("_end"))
    rows, last = numbered.agg(F.count("timestamp"), F.max("window")).first()
    if last is not None and last < SENT_ENDS and numbered.filter("timestamp is not null").groupBy("timestamp").count().filter("count > 1").isEmpty():
        # the wide rows stay where they are: one number a window says which window a timestamp lies in
        sent = [r["_end"] for r in ends.filter("_end is not null").orderBy("window").collect()]
        first = int(last) + 1 - len(sent)  # rows without a timestamp come first and are left out
        return events.filter("timestamp is not null").select(*events.columns, _claim(sent, first, start)(F.col("timestamp")).alias("_claim")).select(
            *events.columns, F.col("_claim.window").alias("window"),
            F.expr("timestamp = _claim.end").alias("is_closing"),
            F.expr("if(timestamp = _claim.end, timestamp, _claim.start)").alias("checkpoint"))
    before = ends.selectExpr("window + 1 as window", "_end as _start")
    claims = numbered.join(ends, "window").join(before, "window", "left").selectExpr(
        "timestamp", "window", "timestamp = _end as is_closing",
        f"if(timestamp = _end, timestamp, coalesce(_start, {start}L)) as checkpoint",
    )
    return events.join(claims, "timestamp").select(*events.columns, "window", "is_closing", "checkpoint")


def _claim(ends: list[int], first: int, start: int):
    """(window, start, end) of a timestamp, by the sorted ends of the windows from ``first`` on."""
    known = np.array(ends, dtype="int64")
    starts = np.concatenate([[start], known[:-1]]).astype("int64")

    def claim(timestamps: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(known, timestamps.to_numpy())
        return pd.DataFrame({"window": at + first, "start": starts[at], "end": known[at]})

    return F.pandas_udf(claim, "window bigint, start bigint, end bigint")


def named(events: DataFrame, ledgers: DataFrame, codes: DataFrame) -> DataFrame:
    """Names for numbers; a gap in the registry keeps the number and unscaled amounts.

    The registry tables are configuration, a few rows, which Spark cannot know of
    a table made in the driver; they are sent to the events, which stay in place.
    """
    l = F.broadcast(ledgers.selectExpr("id as _l", "name as ledger_name", "scale"))
    out = events.join(l, F.expr("ledger = _l"), "left")
    for field in ("transfer_code", "debit_account_code", "credit_account_code"):
        c = F.broadcast(codes.selectExpr(f"value as _{field}", f"name as {field}_name"))
        out = out.join(c, F.expr(f"{field} = _{field}"), "left")
    return out.selectExpr(
        *events.columns,
        "coalesce(ledger_name, cast(ledger as string)) as ledger_name", "coalesce(scale, 0) as scale",
        *[
            f"coalesce({f}_name, cast({f} as string)) as {f}_name"
            for f in ("transfer_code", "debit_account_code", "credit_account_code")
        ],
    )


def _account(side: str) -> str:
    p = f"{side}_account"
    money = ", ".join(
        f"'{b}', {v.format_digits(f'_{p}_{b}', 'scale')}"
        for b in ("debits_pending", "debits_posted", "credits_pending", "credits_posted")
    )
    return (
        f"named_struct('id', {p}_id, {money}, 'user_data_128', {v.optional_id(f'{p}_user_data_128')},"
        f" 'user_data_64', nullif({p}_user_data_64, 0), 'user_data_32', nullif({p}_user_data_32, 0),"
        f" 'code', {p}_code_name, 'flags', {v.flag_names(f'{p}_flags', v.ACCOUNT_FLAGS)},"
        f" 'timestamp', cast({p}_timestamp as string))"
    )


AMOUNTS = ["transfer_amount"] + [
    f"{side}_account_{b}" for side in ("debit", "credit")
    for b in ("debits_pending", "debits_posted", "credits_pending", "credits_posted")
]


def with_digits(named_events: DataFrame) -> DataFrame:
    """Digit text of every amount, once, ahead of ``body``."""
    return named_events.selectExpr("*", *[f"{u128.digits(a)} as _{a}" for a in AMOUNTS])


def body() -> str:
    """JSON text of one change event ``with_digits``; absent optional fields are left out, ``flags`` never is."""
    transfer = (
        f"named_struct('id', transfer_id, 'amount', {v.format_digits('_transfer_amount', 'scale')},"
        f" 'pending_id', {v.optional_id('transfer_pending_id')},"
        f" 'user_data_128', {v.optional_id('transfer_user_data_128')},"
        " 'user_data_64', nullif(transfer_user_data_64, 0), 'user_data_32', nullif(transfer_user_data_32, 0),"
        f" 'timeout', {v.format_timeout('transfer_timeout')}, 'code', transfer_code_name,"
        f" 'flags', {v.flag_names('transfer_flags', v.TRANSFER_FLAGS)},"
        " 'timestamp', cast(transfer_timestamp as string))"
    )
    return (
        f"to_json(named_struct('type', {v.event_type_name('type')}, 'timestamp', cast(timestamp as string),"
        f" 'checkpoint', cast(checkpoint as string), 'ledger', ledger_name, 'transfer', {transfer},"
        f" 'debit_account', {_account('debit')}, 'credit_account', {_account('credit')}))"
    )


def key(choice: str = "debit_account_id") -> str:
    """SQL text of the record key."""
    if choice not in KEYS:
        raise ValueError(f"partition key must be one of {KEYS}")
    return "ledger_name" if choice == "ledger" else choice


def records(named_events: DataFrame, topic: str, partition_key: str = "debit_account_id") -> DataFrame:
    """Change events (with names and checkpoint) as topic records."""
    headers = ", ".join(
        f"named_struct('key', '{k}', 'value', cast({e} as binary))"
        for k, e in (
            ("event_type", v.event_type_name("type")), ("ledger", "ledger_name"),
            ("transfer_code", "transfer_code_name"), ("debit_account_code", "debit_account_code_name"),
            ("credit_account_code", "credit_account_code_name"), ("timestamp", "cast(timestamp as string)"),
        )
    )
    extra = [c for c in ("window", "is_closing") if c in named_events.columns]
    return with_digits(named_events).selectExpr(
        f"cast({key(partition_key)} as binary) as key", f"cast({body()} as binary) as value",
        f"{v.text(topic)} as topic", f"array({headers}) as headers", "timestamp as event_timestamp", *extra,
    )


def registry_gaps(events: DataFrame, ledgers: DataFrame, codes: DataFrame) -> DataFrame:
    """Every number without a name, once, with the first event that carried it."""
    seen = events.selectExpr(
        "timestamp",
        "inline(array(named_struct('kind', 'ledger', 'value', cast(ledger as bigint)),"
        " named_struct('kind', 'code', 'value', cast(transfer_code as bigint)),"
        " named_struct('kind', 'code', 'value', cast(debit_account_code as bigint)),"
        " named_struct('kind', 'code', 'value', cast(credit_account_code as bigint)),"
        " named_struct('kind', 'event_type', 'value', cast(type as bigint))))",
    ).groupBy("kind", "value").agg(F.min("timestamp").alias("first_timestamp"))
    known = (
        ledgers.selectExpr("'ledger' as kind", "id as value")
        .unionByName(codes.selectExpr("'code' as kind", "cast(value as bigint) as value"))
    )
    return seen.filter(f"kind <> 'event_type' or value >= {len(v.EVENT_TYPES)}").join(
        known, ["kind", "value"], "left_anti")


def tails(records_df: DataFrame) -> DataFrame:
    """The last record of every partition that has one.

    The last offsets come from the offset columns alone; the records are then
    picked by equality, so their values are read for one record a partition.
    """
    last = records_df.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    return records_df.join(F.broadcast(last), ["topic", "partition", "offset"]).select(*records_df.columns)


def resume_cursor(records_df: DataFrame) -> DataFrame:
    """Highest usable checkpoint among the partition tails, 0 when there is none."""
    return highest_claim(tails(records_df.select("topic", "partition", "offset", "value")))


def highest_claim(tail_records: DataFrame) -> DataFrame:
    """Highest usable checkpoint of these records, 0 when there is none."""
    text = "try_variant_get(try_parse_json(cast(value as string)), '$.checkpoint', 'string')"
    claims = tail_records.selectExpr(f"{text} as claim")
    usable = claims.selectExpr(f"{v.parse_checkpoint('claim')} as claim")
    return usable.agg(F.coalesce(F.max("claim"), F.lit(0)).cast("decimal(20,0)").alias("checkpoint"))


def deduplicated(published: DataFrame, key_column: str = "timestamp") -> DataFrame:
    """First copy per event timestamp; never a running maximum."""
    return published.dropDuplicates([key_column])


def _fingerprints(rows: DataFrame, width: int) -> DataFrame:
    """Count and hash sum of the timestamps of every range: a partial aggregate, one row a range."""
    return rows.groupBy(F.expr(f"timestamp div {width}").alias("range")).agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("timestamp").cast("decimal(38,0)")).alias("sum"))


#: Rows of one range, about; the result does not depend on it.
RANGE_ROWS = 1 << 16


def reconcile_ranges(applied: DataFrame, published: DataFrame, width: int | None = None) -> DataFrame:
    """``reconcile`` that opens only ranges of timestamps which differ.

    Both sides are reduced to a count and a hash sum per range ahead of any
    shuffle; equal ranges hold the same timestamps (but for a collision of 64-bit
    hash sums of equally many). What repeats or is missing makes its range differ, and
    the rows of such ranges are compared one by one.
    """
    if width is None:
        span = applied.agg(F.min("timestamp"), F.max("timestamp"), F.count("*")).first()
        width = max(1, int((span[1] - span[0]) * RANGE_ROWS // span[2])) if span[2] else 1
    a, p = _fingerprints(applied, width), _fingerprints(published, width).toDF("range", "p_n", "p_sum")
    differ = a.join(p, "range", "full").filter("not (n <=> p_n and sum <=> p_sum)").select("range")
    differ = stage(differ, "ranges")

    def opened(rows: DataFrame) -> DataFrame:
        return rows.select("timestamp", F.expr(f"timestamp div {width}").alias("range")).join(differ, "range", "left_semi").select("timestamp")

    return reconcile(opened(applied), opened(published))


def file_tails(spark: SparkSession, path: str) -> DataFrame:
    """The last record of every partition of a topic kept as files by ``topic=.../partition=...``.

    The last offsets come from the statistics in the files' footers, so no rows
    are scanned for them; of the records themselves only row groups that hold a
    last offset are read. One row a partition is collected.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    last = footers.read.parquet(path).groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    rows = spark.read.parquet(path)
    wanted = [(F.col("topic") == r["topic"]) & (F.col("partition") == r["partition"]) & (F.col("offset") == r["offset"]) for r in last.collect()]
    return rows.filter(reduce(lambda x, y: x | y, wanted)) if wanted else rows.limit(0)


def reconcile(applied: DataFrame, published: DataFrame) -> DataFrame:
    """Timestamps that were applied but not published, or published but not applied."""
    a = applied.select("timestamp").distinct().withColumn("a", F.lit(True))
    p = published.select("timestamp").distinct().withColumn("p", F.lit(True))
    return a.join(p, "timestamp", "full").filter("a is null or p is null").selectExpr(
        "timestamp", "if(p is null, 'missing', 'extra') as problem"
    )
