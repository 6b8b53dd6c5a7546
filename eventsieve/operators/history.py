"""Per-user history signals and risk labels (REA-1, REA-3..5).

The reference draws these columns at random; here they are derived from
each user's own event history:

* ``interaction_velocity_5m``: events of the user in the trailing window
  ``[ts - 5 min, ts]`` (RANGE frame, peers included);
* ``account_age_days``: whole days since the user's first event;
* ``historical_report_rate``: share of the user's earlier events (by
  ``ts``, then id) that were reports; the first event gets 0.

Scale: a per-user window would put a user holding a third of all rows in
one task, and a sliding frame rebuilds its aggregate at every row of a burst.
Instead every event is a ``+1`` at its time and a ``-1`` just after its
window ends, and one segmented scan over ``(user, time)`` gives all three
signals: the running sum of steps is the number of events in the trailing
window, peers of one time are added from their total, and the running counts
before an event are its earlier events and reports.  Only user, time, id and
report flag are sorted; the signals go back to wide rows by one join on the id.
The cost is linear in the events, however they fall.  Null users are one user;
events without a time come first, are peers of each other, and have no age.
"""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve.config import DEFAULT_RULES, RuleConfig
from eventsieve.functions.numeric import parse_flag, parse_number
from eventsieve.functions.text import is_blank, strip_ws
from eventsieve.functions.timestamps import epoch_micros, parse_timestamp
from eventsieve.operators.scan import Scan, segmented_scan

_MICROS = 1_000_000
SIGNALS = ("interaction_velocity_5m", "account_age_days", "historical_report_rate")


def signals_by_event(
    events: DataFrame, user_col: str, ts_col: str, order_col: str, report_flag: Column, rules: RuleConfig = DEFAULT_RULES
) -> DataFrame:
    """``(order_col, interaction_velocity_5m, account_age_days, historical_report_rate)``, one row per event.

    ``order_col`` must tell all events apart."""
    window_us = rules.velocity_window_seconds * _MICROS
    long = F.lit(0).cast("long")
    base = events.select(
        F.col(user_col).alias("_user"), epoch_micros(ts_col).alias("_us"), F.col(order_col).alias("_id"),
        F.coalesce(report_flag.cast("long"), long).alias("_flag"),
    )
    adds = base.select("_user", F.col("_us").alias("_t"), (long + 1).alias("_step"), "_id", "_us", "_flag", (long + 1).alias("_one"))
    # An event leaves the window one microsecond after its end; those without a time leave before all others come.
    leaves = F.coalesce(F.col("_us") + F.lit(window_us + 1), F.lit(-(1 << 63)))
    ends = base.select("_user", leaves.alias("_t"), (long - 1).alias("_step"), "_id", F.lit(None).cast("long").alias("_us"), long.alias("_flag"), long.alias("_one"))
    run = segmented_scan(
        adds.unionByName(ends), ("_user", "_t"), [F.col("_step"), F.col("_id")],
        [
            Scan(("_user",), running={"_in_window": "_step", "_n": "_one", "_f": "_flag"}, lows={"_first": "_us"}),
            Scan(("_user", "_t"), running={"_peer": "_one"}, totals={"_peers": "_one"}),
        ],
    ).filter(F.col("_step") == 1)
    earlier_n, earlier_f = F.col("_n") - 1, F.col("_f") - F.col("_flag")
    return run.select(
        F.col("_id").alias(order_col),
        # At one time ends come first, so all peers still to come are in the window too.
        (F.col("_in_window") + F.col("_peers") - F.col("_peer")).cast("bigint").alias("interaction_velocity_5m"),
        F.floor((F.col("_us") - F.col("_first")) / F.lit(86_400 * _MICROS)).cast("bigint").alias("account_age_days"),
        F.coalesce(F.try_divide(earlier_f.cast("double"), F.nullif(earlier_n, F.lit(0)).cast("double")), F.lit(0.0)).alias("historical_report_rate"),
    )


def history_signals(
    events: DataFrame,
    user_col: str,
    ts_col: str,
    order_col: str,
    report_flag: Column,
    rules: RuleConfig = DEFAULT_RULES,
) -> DataFrame:
    """Add ``interaction_velocity_5m`` (bigint), ``account_age_days`` (bigint)
    and ``historical_report_rate`` (double) to every row of ``events``, joined
    back on ``order_col``, which is unique and not null."""
    return events.join(signals_by_event(events, user_col, ts_col, order_col, report_flag, rules), order_col).select(*events.columns, *SIGNALS)


def rule_risk(rules: RuleConfig = DEFAULT_RULES, kinds: Mapping[str, str] = MappingProxyType({})) -> Column:
    """Structural risk of a raw row: bad type, missing users, bad date, repeat; ``kinds``: column types that are known."""
    event_type = F.lower(F.coalesce(strip_ws(F.col("event_type").cast("string")), F.lit("")))
    return (
        ~event_type.isin(*rules.allowed_event_types)
        | is_blank("source_user_id")
        | is_blank("target_user_id")
        | parse_timestamp(F.col("created_at").cast("string")).isNull()
        | (parse_flag("is_duplicate", kinds.get("is_duplicate")) == 1)
    )


def feedback_risk(rules: RuleConfig = DEFAULT_RULES, kinds: Mapping[str, str] = MappingProxyType({})) -> Column:
    """History risk: high velocity, high report rate, or young and reported; ``kinds``: column types that are known."""
    velocity, age, rate = (F.coalesce(parse_number(c, kinds.get(c)), F.lit(0.0)) for c in SIGNALS)
    return (
        (velocity >= rules.velocity_risk_min)
        | (rate >= rules.report_rate_risk_min)
        | ((age <= rules.young_account_max_days) & (rate >= rules.young_account_report_rate_min))
    )


def risk_labels(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """REA-1: ``historical_feedback_risk`` (clean rows only) and
    ``label_risky_event`` = rule risk or feedback risk."""
    kinds = dict(df.dtypes)
    structural = rule_risk(rules, kinds)
    feedback = ~structural & feedback_risk(rules, kinds)
    return df.withColumn("historical_feedback_risk", feedback.cast("int")).withColumn(
        "label_risky_event", (structural | feedback).cast("int")
    )
