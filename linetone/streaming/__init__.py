from linetone.streaming.phrases import (
    keep_changes,
    phrase_changes,
    rank_value,
    surviving_phrases,
)
from linetone.streaming.report import (
    compact_totals,
    merge_batch,
    start_title_report,
    stream_title_report,
    title_totals,
)

__all__ = [
    "compact_totals",
    "keep_changes",
    "merge_batch",
    "phrase_changes",
    "rank_value",
    "start_title_report",
    "stream_title_report",
    "surviving_phrases",
    "title_totals",
]
