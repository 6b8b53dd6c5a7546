"""Column-expression helpers: every function returns a ``Column``."""

from eventsieve.functions.hashing import pseudonymize
from eventsieve.functions.numeric import linear_score, parse_flag, parse_number, ratio, sigmoid
from eventsieve.functions.text import (
    WHITESPACE,
    is_blank,
    join_reasons,
    notification_id,
    notification_text,
    strip_ws,
    underscores_to_spaces,
)
from eventsieve.functions.timestamps import (
    add_seconds,
    epoch_seconds,
    format_millis,
    format_seconds,
    hour_or_missing,
    parse_timestamp,
    seconds_between,
    weekday_or_missing,
)

__all__ = [
    "WHITESPACE", "add_seconds", "epoch_seconds", "format_millis", "format_seconds",
    "hour_or_missing", "is_blank", "join_reasons", "linear_score", "notification_id",
    "notification_text", "parse_flag", "parse_number", "parse_timestamp", "pseudonymize",
    "ratio", "seconds_between", "sigmoid", "strip_ws", "underscores_to_spaces",
    "weekday_or_missing",
]
