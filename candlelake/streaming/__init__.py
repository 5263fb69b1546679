from candlelake.streaming.candles import (
    archive_columns,
    closed_candles,
    count_malformed,
    dedup_stream,
    hourly_stream,
    land_unsettled,
    message_stream,
    open_hours,
    parse_messages,
    run_available,
    run_batches,
    with_latency,
)
from candlelake.streaming.metrics import archive_with_metrics, load_with_metrics, write_observed
from candlelake.streaming.tails import store_features

__all__ = [
    "archive_columns",
    "archive_with_metrics",
    "closed_candles",
    "count_malformed",
    "dedup_stream",
    "hourly_stream",
    "land_unsettled",
    "load_with_metrics",
    "message_stream",
    "open_hours",
    "parse_messages",
    "run_available",
    "run_batches",
    "store_features",
    "with_latency",
    "write_observed",
]
