"""The command sink as a streaming query.

One micro-batch is one transaction: decode, classify, post, write, and only
then does the query's own checkpoint move the offsets. Everything is written
under the batch number and overwritten when the batch is run again, so a crash
anywhere costs a repeat and never a loss or a second posting.

What a batch must know of the batches before it costs what the batch touches,
not what was posted before: balances, and with them the room under spending
limits, and open pending transfers are keyed tables; ids posted earlier are
found by an index of filters, and only suspected ones are looked up.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerweave.functions import uint128 as u128
from ledgerweave.functions import values as v
from ledgerweave.operators import balances, batches, emit, expiry, limits, metrics, posting
from ledgerweave.operators.decode import CREATE_ACCOUNTS, CREATE_TRANSFERS, DecodeOptions, decode, explode_events
from ledgerweave.operators.scan import dense, number_rows
from ledgerweave.session import stage
from ledgerweave.streaming import outbox as out
from ledgerweave.streaming.state import KeyedTable, SeenIds

ACCOUNT_SCHEMA = "batch bigint, id string, ledger_id bigint, code int, flags int, created bigint"
_POSTED = (
    f"seq bigint, id string, debit_account_id string, credit_account_id string, pending_id string, amount {u128.LIMBS},"
    " ledger_id bigint, code int, flags int, timeout_s bigint, chain_id bigint, clock bigint, error string,"
    f" p_amount {u128.LIMBS}, p_debit string, p_credit string"
)
POSTED_SCHEMA = f"batch bigint, {_POSTED}"
POSTED_COLUMNS = [f.split(" ")[0] for f in _POSTED.split(", ")]
SEQ_PER_BATCH = 1 << 40
#: Suspected ids up to this number are looked up as literals, which Parquet's own filters see; more by a join.
LITERALS = 1000
TICKS = 1_000_000  # microseconds of record time


@dataclass(frozen=True)
class SinkTables:
    """Folders of one ledger."""

    root: str
    seen_bits: int = 1 << 20

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        """The table so far; an empty one before the first write."""
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        if not exists:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.path(name))

    def write(self, df: DataFrame, name: str, batch_id: int, **options: str) -> None:
        df.write.mode("overwrite").options(**options).parquet(f"{self.path(name)}/batch={batch_id}")

    def accounts(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "accounts", ACCOUNT_SCHEMA)

    def posted(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "posted", POSTED_SCHEMA)

    @property
    def balances(self) -> KeyedTable:
        return KeyedTable(self.path("balances"), "account_id", "account_id string, " + ", ".join(f"{n} {u128.LIMBS}" for n in posting.BUCKETS))

    @property
    def pending(self) -> KeyedTable:
        """Pending transfers that nothing has resolved."""
        return KeyedTable(self.path("pending"), "id", f"{_POSTED}, expires_at bigint")

    @property
    def clock(self) -> KeyedTable:
        return KeyedTable(self.path("clock"), "name", "name string, at bigint")

    @property
    def seen(self) -> SeenIds:
        return SeenIds(self.path("seen"), bits=self.seen_bits)


#: (transfers, accounts, earlier posted rows, opening balances) -> posted rows
Poster = Callable[[DataFrame, DataFrame, DataFrame, DataFrame], DataFrame]


def post(transfers: DataFrame, accounts: DataFrame, earlier: DataFrame, opening: DataFrame) -> DataFrame:
    """Posting with limits where any account has one; without, verdicts need no rounds."""
    if accounts.filter(f"(flags & {v.DEBITS_CAPPED | v.CREDITS_CAPPED}) <> 0").isEmpty():
        return posting.post(transfers, accounts, earlier)
    return limits.settle(transfers, accounts, earlier, opening)


def in_order(decoded: DataFrame, batch_id: int, most_events: int) -> DataFrame:
    """Events with ``seq`` by topic, partition, offset and index, above those of all batches before.

    Offsets of a partition count from the batch's lowest one; only where gaps
    spread them too far are the events numbered by rank. One row a partition is collected.
    """
    start, width = batch_id * SEQ_PER_BATCH, most_events + 1
    ends = decoded.groupBy("topic", "partition").agg(F.min("offset"), F.max("offset")).orderBy("topic", "partition").collect()
    firsts, total = [], 0
    for topic, partition, low, high in ends:
        firsts.append((topic, partition, total - low))
        total += high - low + 1
    events = explode_events(decoded, "unix_micros(timestamp) as time")
    if (total + 1) * width >= SEQ_PER_BATCH:
        return number_rows(events, ["topic", "partition", "offset", "idx"], "rn").withColumn("seq", F.expr(f"{start}L + rn")).drop("rn")
    # one row a topic partition
    places = F.broadcast(decoded.sparkSession.createDataFrame(firsts, "topic string, partition int, _first bigint"))
    return events.join(places, ["topic", "partition"]).withColumn("seq", F.expr(f"{start}L + (_first + offset) * {width} + idx + 1")).drop("_first")


def earlier_rows(spark: SparkSession, tables: SinkTables, wanted: DataFrame, open_: DataFrame, batch_id: int) -> DataFrame:
    """Posted rows of earlier batches with a ``wanted`` id, and the claims on them; ``open_`` are the pending ones of these."""
    unknown = wanted.join(open_.select("id"), "id", "left_anti")
    suspected = stage(tables.seen.suspected(unknown, batch_id), "suspected")
    n = suspected.count()
    rows = open_.select(*POSTED_COLUMNS)
    if not n:
        return rows
    history = tables.posted(spark).filter(F.col("batch") < batch_id)
    if n <= LITERALS:
        ids = [r["id"] for r in suspected.collect()]
        found = history.filter(F.col("id").isin(ids) | (F.col("pending_id").isin(ids) & F.expr(f"error is null and {posting.RESOLVES}")))
    else:
        claims = history.filter(f"error is null and {posting.RESOLVES}").join(
            suspected.withColumnRenamed("id", "pending_id"), "pending_id", "left_semi").select(*history.columns)
        found = history.join(suspected, "id", "left_semi").select(*history.columns).unionByName(claims)
    return rows.unionByName(found.select(*POSTED_COLUMNS)).dropDuplicates(["id"])


def process_batch(
    records: DataFrame, batch_id: int, options: DecodeOptions, tables: SinkTables, poster: Poster = post,
    dlq_topic: str = "ledger.dlq", results_topic: str = "ledger.results", outbox: out.Outbox | None = None,
    fail_after: str | None = None,
) -> None:
    """Apply one micro-batch. ``fail_after`` stops behind the named write, for crash tests."""
    spark, outbox = records.sparkSession, outbox or out.folders(tables.root)

    def done(step: str) -> None:
        if step == fail_after:
            raise RuntimeError(f"stopped after {step}")

    decoded = stage(decode(records, options), f"batch-{batch_id}")
    events = stage(batches.chains(in_order(decoded, batch_id, options.limits.max_events)), f"events-{batch_id}")
    before = next((r["at"] for r in tables.clock.read(spark, batch_id).collect()), None)
    transferring = f"op = '{CREATE_TRANSFERS}'"
    now, timed = events.agg(F.max("time"), F.expr(f"bool_or({transferring} and (flags & {v.PENDING}) <> 0 and timeout_s > 0)")).first()
    now = max(x for x in (before, now, 0) if x is not None)
    wanted = events.filter(transferring).selectExpr(
        "inline(array(named_struct('id', id), named_struct('id', pending_id)))").filter("id is not null").distinct()
    waiting = tables.pending.read(spark, batch_id).join(wanted.withColumn("_wanted", F.lit(True)), "id", "left")
    waiting = stage(waiting.filter(f"_wanted or expires_at <= {now}L").drop("_wanted"), f"waiting-{batch_id}")
    earlier = stage(earlier_rows(spark, tables, wanted, waiting, batch_id), f"earlier-{batch_id}")

    timers = None
    if not timed and waiting.filter("expires_at is not null").isEmpty():
        events = events.withColumn("clock", F.col("time"))
    else:
        clocked = stage(expiry.with_clock(events, "time", before, dense("seq")), f"clocked-{batch_id}")
        mine = expiry.timers(clocked.filter(transferring).join(earlier.select("id"), "id", "left_anti"), TICKS)
        timers = mine.select(*expiry.WAITING).unionByName(waiting.filter("expires_at is not null").select(*expiry.WAITING))
        timers = stage(timers, f"timers-{batch_id}")
        if not timers.filter(f"expires_at <= {now}L").isEmpty():
            clocked = expiry.merge(clocked, timers, now, batch_id * SEQ_PER_BATCH)
        events = clocked
    creating, transfers = events.filter(f"op = '{CREATE_ACCOUNTS}'"), events.filter(transferring)
    ordered = events.filter(f"{transferring} or {posting.EXPIRY}")

    old_accounts = tables.accounts(spark).filter(F.col("batch") < batch_id).drop("batch")
    created = creating.filter(f"not ({posting.BOTH_CAPS})").groupBy("id").agg(
        F.min_by(F.struct("ledger_id", "code", "flags", F.col("seq").alias("created")), "seq").alias("a")
    ).select("id", "a.*").join(old_accounts.select("id"), "id", "left_anti")
    tables.write(created, "accounts", batch_id)
    done("accounts")
    # only this batch's own directory is new: what a failed attempt left in it is overwritten
    accounts = old_accounts.unionByName(tables.accounts(spark).filter(F.col("batch") == batch_id).drop("batch"))
    touched = ordered.select("debit_account_id", "credit_account_id").unionByName(earlier.select("debit_account_id", "credit_account_id")).selectExpr(
        "inline(array(named_struct('account_id', debit_account_id), named_struct('account_id', credit_account_id)))").filter("account_id is not null")
    opening = stage(tables.balances.read(spark, batch_id, touched), f"opening-{batch_id}")
    posted = expiry.applied(poster(ordered, accounts, earlier, opening))
    # by id: a lookup of single ids skips all other pages
    tables.write(posted.select(*POSTED_COLUMNS).sortWithinPartitions("id"), "posted", batch_id, **{
        "parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.enabled#pending_id": "true"})
    done("posted")
    fresh = tables.posted(spark).filter(F.col("batch") == batch_id).drop("batch")

    verdicts = fresh.filter(f"not {posting.EXPIRY}").select("id", "error").unionByName(earlier.select("id", "error"))
    outcomes = posting.outcomes(transfers, verdicts).unionByName(
        creating.selectExpr("*", f"if({posting.BOTH_CAPS}, 'rejected', 'ok') as status",
                            f"if({posting.BOTH_CAPS}, 'flags_are_mutually_exclusive', null) as error"))
    outcomes = stage(outcomes, f"outcomes-{batch_id}")

    def keep_balances() -> None:
        tables.balances.write(balances.closing_balances(posting.legs(fresh), opening), batch_id)
        tables.clock.write(spark.createDataFrame([("clock", now)], "name string, at bigint"), batch_id)

    def keep_pending() -> None:
        resolved = fresh.filter(f"error is null and {posting.RESOLVES}").select(F.col("pending_id").alias("_r")).distinct()
        opened = fresh.filter(f"error is null and (flags & {v.PENDING}) <> 0")
        if timers is None:
            opened = opened.withColumn("expires_at", F.lit(None).cast("bigint"))
        else:
            opened = opened.join(timers.select(F.col("id").alias("_t"), "expires_at"), F.expr("id = _t"), "left").drop("_t")
        changed = opened.unionByName(waiting.join(fresh.select("id"), "id", "left_anti").select(*opened.columns))
        changed = changed.join(resolved, F.expr("id = _r"), "left")
        tables.pending.write(changed, batch_id, gone="_r is not null")

    def keep_seen() -> None:
        tables.seen.add(fresh.select("id"), batch_id)

    def keep_changes() -> None:
        tables.write(balances.change_events(fresh, accounts, opening=opening), "changes", batch_id)

    def count() -> None:
        for name, table in (("records_total", metrics.records_total(decoded, outcomes)), ("events_total", metrics.events_total(outcomes)),
                            ("dlq_total", metrics.dlq_total(decoded, outcomes))):
            tables.write(table.coalesce(1), name, batch_id)

    def send() -> None:
        out.deliver(spark, tables.root, "results", batch_id, lambda: outbox.results(emit.results(decoded, outcomes, results_topic), batch_id))
        done("results")
        letters = emit.in_source_order(emit.dead_letters(decoded, outcomes, dlq_topic))
        out.deliver(spark, tables.root, "dlq", batch_id, lambda: outbox.dlq(letters, batch_id))

    # they write different folders and only read what is written by now
    with ThreadPoolExecutor(6) as pool:
        for step in [pool.submit(f) for f in (send, keep_balances, keep_pending, keep_seen, keep_changes, count)]:
            step.result()


def start(
    source: DataFrame, options: DecodeOptions, tables: SinkTables, checkpoint: str, available_now: bool = False,
    every: str = "1 second", **more,
) -> StreamingQuery:
    """Run the sink over a stream of envelope records."""
    writer = (
        source.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, batch_id: process_batch(df, batch_id, options, tables, **more))
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()


def balances_now(spark: SparkSession, tables: SinkTables) -> DataFrame:
    """Current balances of every account that ever moved."""
    return tables.balances.read(spark, 1 << 62)


def totals_now(spark: SparkSession, tables: SinkTables, name: str, by: list[str]) -> DataFrame:
    """A counter over all batches; a batch that ran twice counts once."""
    return spark.read.parquet(tables.path(name)).groupBy(*by).agg(F.sum("n").alias("n"))
