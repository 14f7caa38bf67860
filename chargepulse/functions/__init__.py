"""Scalar column expressions (all JVM-side, no Python per row)."""

from .ip import ip_to_long, long_to_ip
from .rates import pct_one_decimal
from .text import java_split_tokens, split_topic_partition
from .timefmt import compact_ts_millis, duration_ms, prefix

__all__ = [
    "ip_to_long", "long_to_ip", "pct_one_decimal", "java_split_tokens",
    "split_topic_partition", "compact_ts_millis", "duration_ms", "prefix",
]
