"""The rules, the scorer and the export key as SQL functions.

``register`` makes session functions whose bodies are SQL expressions.  Spark
puts the body in place of the call, so a query that uses them plans like one
over the DataFrame operators, with no UDF in it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventsieve.config import (
    DECISION_APPROVED,
    DECISION_REJECTED,
    DECISION_REVIEW,
    DEFAULT_RULES,
    EXPLANATION_APPROVED,
    EXPLANATION_REJECTED_PREFIX,
    EXPLANATION_REVIEW,
    MSG_DATE_INVALID,
    MSG_DUPLICATE,
    MSG_EVENT_ID_BLANK,
    MSG_SOURCE_BLANK,
    MSG_TARGET_BLANK,
    MSG_TYPE_INVALID,
    MSG_TYPE_OUT_OF_SCOPE,
    REASON_SEPARATOR,
    RuleConfig,
)
from eventsieve.functions.hashing import PSEUDONYM_HEX_CHARS, PSEUDONYM_PREFIX
from eventsieve.functions.numeric import NUMBER
from eventsieve.functions.text import WHITESPACE
from eventsieve.functions.timestamps import DATE_TIME
from eventsieve.operators.scoring import REFERENCE_MODEL, LinearModel


def literal(text: str) -> str:
    """A SQL string literal; everything but plain characters is written as an escape."""
    plain = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 _-.,;:|+*?()[]{}^$/=<>")
    return "'" + "".join(c if c in plain else f"\\u{ord(c):04x}" for c in text) + "'"


def _one_of(values) -> str:
    return ", ".join(literal(v) for v in values)


def definitions(rules: RuleConfig = DEFAULT_RULES, model: LinearModel = REFERENCE_MODEL, prefix: str = "es_") -> dict[str, str]:
    """``{name: "(parameters) RETURNS type RETURN body"}``; later ones use earlier ones."""
    p, sep, allowed = prefix, literal(REASON_SEPARATOR), _one_of(rules.allowed_event_types)
    score = " + ".join(
        [f"{float(model.intercept)!r}D", *(f"{w!r}D * (({c} - {m!r}D) / {s!r}D)" for c, w, m, s in zip(model.features, model.weights, model.mean, model.std, strict=True))]
    )
    arguments = ", ".join(f"{c} DOUBLE" for c in model.features)
    made = {
        "strip": f"(x STRING) RETURNS STRING RETURN btrim(x, {literal(WHITESPACE)})",
        "is_blank": f"(x STRING) RETURNS BOOLEAN RETURN coalesce({p}strip(x), '') = ''",
        "number": f"(x STRING) RETURNS DOUBLE RETURN CASE WHEN x RLIKE {literal(NUMBER)} AND NOT isnan(try_cast(x AS DOUBLE)) THEN try_cast(x AS DOUBLE) END",
        "event_time": f"(x STRING) RETURNS TIMESTAMP_NTZ RETURN CASE WHEN x RLIKE {literal(DATE_TIME)} THEN try_cast(x AS TIMESTAMP_NTZ) END",
        "millis": "(t TIMESTAMP_NTZ) RETURNS STRING RETURN CASE WHEN t IS NULL THEN '' ELSE format_string('%04d-%02d-%02d %02d:%02d:%02d.%03d', "
                  "year(t), month(t), dayofmonth(t), hour(t), minute(t), second(t), CAST(floor(date_part('SECOND', t) * 1000) AS INT) % 1000) END",
        "clean_type": f"(x STRING) RETURNS STRING RETURN lower(coalesce({p}strip(x), ''))",
        "error_reason": f"(event_id STRING, event_type STRING, source_user_id STRING, target_user_id STRING, created_at TIMESTAMP_NTZ) RETURNS STRING RETURN "
                        f"concat_ws({sep}, CASE WHEN {p}is_blank(event_id) THEN {literal(MSG_EVENT_ID_BLANK)} END, "
                        f"CASE WHEN NOT coalesce(event_type IN ({allowed}), false) THEN {literal(MSG_TYPE_INVALID)} END, "
                        f"CASE WHEN {p}is_blank(source_user_id) THEN {literal(MSG_SOURCE_BLANK)} END, "
                        f"CASE WHEN {p}is_blank(target_user_id) THEN {literal(MSG_TARGET_BLANK)} END, CASE WHEN created_at IS NULL THEN {literal(MSG_DATE_INVALID)} END)",
        "rule_reason": f"(event_id STRING, event_type STRING, source_user_id STRING, target_user_id STRING, created_at STRING, is_duplicate INT) RETURNS STRING RETURN "
                       f"concat_ws({sep}, CASE WHEN {p}is_blank(event_id) THEN {literal(MSG_EVENT_ID_BLANK)} END, "
                       f"CASE WHEN {p}clean_type(event_type) NOT IN ({allowed}) THEN {literal(MSG_TYPE_OUT_OF_SCOPE)} END, "
                       f"CASE WHEN {p}is_blank(source_user_id) THEN {literal(MSG_SOURCE_BLANK)} END, "
                       f"CASE WHEN {p}is_blank(target_user_id) THEN {literal(MSG_TARGET_BLANK)} END, "
                       f"CASE WHEN {p}event_time(created_at) IS NULL THEN {literal(MSG_DATE_INVALID)} END, CASE WHEN is_duplicate = 1 THEN {literal(MSG_DUPLICATE)} END)",
        "risk": f"({arguments}) RETURNS DOUBLE RETURN 1.0D / (1.0D + exp(-greatest(least({score}, 500.0D), -500.0D)))",
        "decision": f"(reason STRING, risk DOUBLE) RETURNS STRING RETURN CASE WHEN reason <> '' THEN {literal(DECISION_REJECTED)} "
                    f"WHEN round(risk, 4) >= {float(rules.threshold)!r}D THEN {literal(DECISION_REVIEW)} ELSE {literal(DECISION_APPROVED)} END",
        "explanation": f"(reason STRING, risk DOUBLE) RETURNS STRING RETURN CASE WHEN reason <> '' THEN concat({literal(EXPLANATION_REJECTED_PREFIX)}, reason) "
                       f"WHEN round(risk, 4) >= {float(rules.threshold)!r}D THEN {literal(EXPLANATION_REVIEW)} ELSE {literal(EXPLANATION_APPROVED)} END",
        "pseudonym": f"(id STRING, salt STRING) RETURNS STRING RETURN CASE WHEN {p}is_blank(id) OR lower({p}strip(id)) = 'nan' THEN '' "
                     f"ELSE concat({literal(PSEUDONYM_PREFIX)}, substring(sha2(concat(salt, ':', {p}strip(id)), 256), 1, {PSEUDONYM_HEX_CHARS})) END",
    }
    return {prefix + name: body for name, body in made.items()}


def register(spark: SparkSession, rules: RuleConfig = DEFAULT_RULES, model: LinearModel = REFERENCE_MODEL, prefix: str = "es_") -> list[str]:
    """Create the functions in the session, and return their names."""
    made = definitions(rules, model, prefix)
    for name, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(made)


def register_table_function(spark: SparkSession, view: str, name: str = "es_rejected", prefix: str = "es_") -> str:
    """A table function over the view of cleaned events ``view``: its rejected rows whose reason holds a text."""
    reason = f"{prefix}error_reason(event_id, event_type, source_user_id, target_user_id, created_at)"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING) RETURNS TABLE(seq BIGINT, event_id STRING, error_reason STRING) RETURN "
        f"SELECT seq, event_id, {reason} FROM {view} WHERE {reason} <> '' AND contains({reason}, wanted)"
    )
    return name
