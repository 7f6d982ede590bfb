from connlens.streaming.growing import follow_lines
from connlens.streaming.lines import (
    await_stream,
    batch_counts,
    lines_to_table,
    skip_blank,
    start_batches,
    stream_lines,
)
from connlens.streaming.queries import query_errors, query_results, start_query_stream

__all__ = [
    "await_stream",
    "batch_counts",
    "follow_lines",
    "lines_to_table",
    "query_errors",
    "query_results",
    "skip_blank",
    "start_batches",
    "start_query_stream",
    "stream_lines",
]
