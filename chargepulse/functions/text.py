"""Text helpers: Java-compatible tokenising (PRJ10), topic-partition keys (FN11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_split_tokens(col, sep: str = " ") -> Column:
    """Array of tokens with the JVM ``String.split(sep)`` edge rules.

    Spark's ``split`` keeps trailing empty strings; the JVM drops them.  So:
    trailing separators are stripped first, an empty string yields one empty
    token and a string made only of separators yields no token.  ``sep`` is a
    single literal character.
    """
    import re

    c = _c(col)
    kept = F.rtrim(c, F.lit(sep))
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, re.escape(sep)))
    )


def split_topic_partition(col) -> tuple[Column, Column]:
    """Legacy ``<topic>-<partition>`` key -> (topic, partition INT).

    The partition is the digits after the *last* dash, so topics that contain
    dashes survive (splitting on every dash would not).
    """
    c = _c(col)
    topic = F.regexp_extract(c, r"^(.*)-([0-9]+)$", 1)
    part = F.regexp_extract(c, r"^(.*)-([0-9]+)$", 2)
    return (F.when(topic != "", topic),
            F.when(part != "", part.cast("int")))
