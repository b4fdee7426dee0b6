"""Dead letters and results: the output side of a command stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import values as v
from ledgerweave.schemas import header

PREFIX = "x-ledger-"
RECORD = ["topic", "partition", "offset"]


def poison_letters(decoded: DataFrame) -> DataFrame:
    return decoded.filter("error is not null").selectExpr(
        "key", "value", "'poison' as reason", "error", "detail",
        "topic", "partition", "offset", "-1 as idx", "timestamp",
    )


def reject_letters(records: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One dead letter per rejected event, all with the record's original bytes."""
    rejected = outcomes.filter("status = 'rejected'").selectExpr(
        *RECORD, "idx", "error", "concat('event ', idx, ' (id ', id_text, '): ', error) as detail"
    )
    return rejected.join(
        records.select("key", "value", "timestamp", *RECORD), RECORD
    ).selectExpr(
        "key", "value", "'reject' as reason", "error", "detail", *RECORD, "idx", "timestamp"
    )


def dead_letters(
    decoded: DataFrame, outcomes: DataFrame, dlq_topic: str, attempt_at: str = "current_timestamp()",
    prefix: str = PREFIX,
) -> DataFrame:
    """Poison and rejects as records: same key, same bytes, the story in the headers."""
    letters = poison_letters(decoded).unionByName(reject_letters(decoded, outcomes))
    fields = (
        ("reason", "reason"), ("error", "error"), ("detail", "detail"), ("src-topic", "topic"),
        ("src-partition", "cast(partition as string)"), ("src-offset", "cast(offset as string)"),
        ("src-timestamp", v.rfc3339("timestamp")), ("attempt-ts", v.rfc3339(attempt_at)),
    )
    headers = ", ".join(
        f"named_struct('key', '{prefix}{k}', 'value', cast({e} as binary))" for k, e in fields
    )
    return letters.selectExpr(
        "key", "value", f"{v.text(dlq_topic)} as topic", f"array({headers}) as headers",
        "partition as src_partition", "offset as src_offset", "idx",
    )


def in_source_order(letters: DataFrame) -> DataFrame:
    """Dead letters in offset order within each source partition."""
    order = ["src_partition", "src_offset", "idx"]
    return letters.repartitionByRange(*order).sortWithinPartitions(*order)


def replay(letters: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """Dead letters back as source records: original topic, key and bytes."""
    return letters.selectExpr(
        "key", "value", f"{header('headers', prefix + 'src-topic')} as topic",
        f"cast({header('headers', prefix + 'src-partition')} as int) as partition",
        f"cast({header('headers', prefix + 'src-offset')} as bigint) as src_offset",
    )


def results(
    records: DataFrame, outcomes: DataFrame, results_topic: str, emitted_at: str = "current_timestamp()"
) -> DataFrame:
    """One results message per applied record; an empty topic name switches them off.

    A record's events are bounded by the decoder's event limit, so the list is too.
    """
    per_record = outcomes.groupBy(*RECORD).agg(
        F.sort_array(F.collect_list(F.expr(
            "named_struct('index', idx, 'id', id_text, 'status', status, 'error', error)"
        ))).alias("results")
    )
    body = (
        "to_json(named_struct('source', named_struct('topic', topic, 'partition', partition, 'offset', offset),"
        f" 'results', results, 'emitted_at', {v.rfc3339(emitted_at)}))"
    )
    messages = per_record.join(records.select("key", *RECORD), RECORD).selectExpr(
        "key", f"cast({body} as binary) as value", f"{v.text(results_topic)} as topic",
        "topic as src_topic", "partition as src_partition", "offset as src_offset",
    )
    return messages if results_topic else messages.limit(0)
