from waybill.streaming.activity import (
    stream_activity,
    stream_lines,
    stream_to_table,
    stream_windowed_counts,
)
from waybill.streaming.clock import stop_when_idle, stream_counts_by_clock
from waybill.streaming.sinks import MetricsLog, append_once, read_appended, read_metrics
from waybill.streaming.state import open_windows, state_settings

__all__ = [
    "MetricsLog",
    "append_once",
    "open_windows",
    "read_appended",
    "read_metrics",
    "state_settings",
    "stop_when_idle",
    "stream_activity",
    "stream_counts_by_clock",
    "stream_lines",
    "stream_to_table",
    "stream_windowed_counts",
]
