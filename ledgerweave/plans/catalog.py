"""All queries and their independent SQL, by name."""

from ledgerweave.plans import cdc_queries, decode_queries, posting_queries, progress_queries, stream_queries, value_queries

_PARTS = (value_queries, decode_queries, posting_queries, cdc_queries, progress_queries, stream_queries)
QUERIES = {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
