"""Headline throughput: ``python bench.py`` prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Inputs that a
deployment would already have (the command topic, the transfer and change
tables) are written once beforehand; every timed query runs once untimed, then
computes its whole result and writes it to a sink that discards it.
``sink_end_to_end`` is one micro-batch of the sink over the whole topic: decode,
post, outcomes, dead letters and all its written tables.
"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


def main() -> None:
    from pyspark.sql import SparkSession

    from ledgerweave.operators import balances, cdc, decode, posting
    from ledgerweave.plans import catalog, inputs
    from ledgerweave.session import configure
    from ledgerweave.session import shared_folder
    from ledgerweave.sources import tables as t
    from ledgerweave.streaming import sink

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("ledgerweave-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    log = t.staged(spark, sf, "log", t.command_log)
    events = t.staged(spark, sf, "ledger_events", t.ledger_events)
    options = t.decode_options(spark, sf)
    n_log, n_events = log.count(), events.count()
    changes = inputs.changes(spark, sf)
    n_changes = changes.count()

    def encode():
        named = cdc.named(cdc.checkpoints(changes, cdc.MAX_WINDOW), t.ledgers(spark, sf), t.codes(spark))
        return cdc.records(named, "ledger.changes")

    def end_to_end():
        folder = f"{shared_folder(spark)}/bench-{time.time_ns()}"
        sink.process_batch(log, 0, options, sink.SinkTables(folder))

    timed = {
        "sink_end_to_end": (end_to_end, n_log),
        "decode_commands": (lambda: decode.decode(log, options), n_log),
        "post_transfers": (lambda: posting.post(events, t.accounts(spark, sf)), n_events),
        "balances": (lambda: posting.balances(posting.legs(inputs.posted(spark, sf))), n_events),
        "running_balances": (
            lambda: balances.running_balances(posting.legs(inputs.posted(spark, sf))), n_events),
        "encode_changes": (encode, n_changes),
        "account_balances_agg": (lambda: catalog.QUERIES["account_balances_agg"](spark, sf), n_events),
        "dlq_records": (lambda: catalog.QUERIES["dlq_records"](spark, sf), n_log),
        "results_messages": (lambda: catalog.QUERIES["results_messages"](spark, sf), n_log),
        "resume_cursor": (lambda: catalog.QUERIES["resume_cursor"](spark, sf), n_changes),
    }
    for name in ("dlq_records", "results_messages", "resume_cursor"):
        timed[name][0]().isEmpty()  # the tables these read are written now
    seconds, rates = {}, {}
    for name, (build, rows) in timed.items():
        best = None
        for warm in (True, False, False):
            started = time.perf_counter()
            result = build()
            if result is not None:
                result.write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            if warm:
                continue
            best = took if best is None else min(best, took)
            if took > 5:  # long enough to be its own measurement
                break
        print(f"{name} {best:.2f}s", file=sys.stderr, flush=True)
        seconds[name] = round(best, 3)
        rates[name] = round(rows / best)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rows_per_second": rates, "sf": os.path.basename(sf.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
