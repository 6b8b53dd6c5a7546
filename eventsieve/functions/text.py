"""String column expressions (PRJ-2, FLT-2, STR-1..5)."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventsieve.config import (
    NOTIFICATION_PREFIX,
    NOTIFICATION_TEMPLATES,
    UNSUPPORTED_EVENT_TEXT,
)

# Python's ``str.strip()`` removes every character with ``isspace()``; Spark's
# ``trim`` only removes spaces.  The set is derived from the same rule so that
# ``btrim`` (JVM-native, no regex) strips exactly what Python strips.
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Trim leading/trailing Unicode whitespace, as Python ``str.strip``."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def is_blank(c: str | Column) -> Column:
    """True when null, empty or whitespace only (never null itself)."""
    return F.coalesce(strip_ws(c), F.lit("")) == F.lit("")


def notification_text(event_type: str | Column, source_user: str | Column) -> Column:
    """Message per allowed type; anything else gets the fallback text."""
    et, src = col_of(event_type), col_of(source_user)
    expr = None
    for kind, suffix in NOTIFICATION_TEMPLATES.items():
        branch = F.concat(src, F.lit(suffix))
        expr = F.when(et == kind, branch) if expr is None else expr.when(et == kind, branch)
    return expr.otherwise(F.lit(UNSUPPORTED_EVENT_TEXT))


def notification_id(event_id: str | Column) -> Column:
    return F.concat(F.lit(NOTIFICATION_PREFIX), col_of(event_id))


def underscores_to_spaces(c: str | Column) -> Column:
    return F.translate(col_of(c), "_", " ")


def join_reasons(separator: str, *conditions_and_texts: tuple[Column, str]) -> Column:
    """Ordered failure list; ``concat_ws`` skips the nulls of passing rules."""
    parts = [F.when(cond, F.lit(text)) for cond, text in conditions_and_texts]
    return F.concat_ws(separator, *parts)
