"""DuckDB SQL that states each catalog query independently of Spark.

The SQL is the specification the Spark plans are checked against: plain
windows over whole tables (``row_number() OVER (ORDER BY ...)``, per-user
frames), which is exactly what the Spark side avoids at scale.  Building
blocks are CTEs composed per query.
"""

from __future__ import annotations

from itertools import combinations

from eventsieve.config import (
    ALLOWED_EVENT_TYPES,
    DEFAULT_RULES,
    FEATURE_COLUMNS,
    IMPUTATION_NOTE,
    LABEL_COLUMN,
    NOTIFICATION_TEMPLATES,
    STATISTIC_COLUMNS,
)
from eventsieve.operators.scoring import REFERENCE_MODEL
from eventsieve.operators.trees import STORED_FOREST

R = DEFAULT_RULES
ALLOWED = ", ".join(f"'{t}'" for t in ALLOWED_EVENT_TYPES)
EXPORT_SALT = "eventsieve-test-salt"
FILTER_TYPE, FILTER_DECISION = "follow", "rechazado_por_reglas"
REVIEW_TOP_N = 10
# Keys looked up: users and ids whose md5 comes before these, and the first few of each.
LOOKUP_USERS_BELOW, LOOKUP_IDS_BELOW, LOOKUP_POINTS = "1", "02", 14
GRADIENT_STEPS = 12


def _adapter(source: str, extra: str = "") -> str:
    return f"""
  SELECT event_id AS seq,
    CASE WHEN event_id % 25 = 24 THEN ' evt-' || CAST(event_id - 1 AS VARCHAR)
         ELSE 'evt-' || CAST(event_id AS VARCHAR) END AS event_id,
    CASE event_type WHEN 'click' THEN 'LIKE' WHEN 'view' THEN ' comment '
                    WHEN 'purchase' THEN 'follow' ELSE event_type END AS event_type,
    CASE WHEN event_id % 40 = 0 THEN '' ELSE 'u' || CAST(user_id AS VARCHAR) END AS source_user_id,
    CASE WHEN event_id % 9 = 0 THEN '  ' ELSE 't' || json_extract_string(props, '$.k') END AS target_user_id,
    CASE WHEN event_id % 10 = 3 THEN 'fecha-invalida' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created_at,
    props AS content{extra}
  FROM {source}"""


def _notification_case(type_col: str, src_col: str) -> str:
    branches = " ".join(
        f"WHEN '{t}' THEN {src_col} || '{suffix}'" for t, suffix in NOTIFICATION_TEMPLATES.items()
    )
    return f"CASE {type_col} {branches} ELSE 'evento no soportado' END"


def ms(col: str) -> str:
    return f"coalesce(strftime({col}, '%Y-%m-%d %H:%M:%S.%g'), '')"


CTE = {
    "raw": _adapter("events"),
    "norm": """
  SELECT seq, trim(event_id) AS event_id, lower(trim(event_type)) AS event_type,
         trim(source_user_id) AS source_user_id, trim(target_user_id) AS target_user_id,
         try_cast(trim(created_at) AS TIMESTAMP) AS created_at, trim(content) AS content
  FROM raw""",
    "processed": f"""
  SELECT *, {_notification_case('event_type', 'source_user_id')} AS notification_text
  FROM norm QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq) = 1""",
    "checked": f"""
  SELECT *, concat_ws('; ',
      CASE WHEN event_id = '' THEN 'event_id vacio' END,
      CASE WHEN event_type NOT IN ({ALLOWED}) THEN 'tipo de evento invalido' END,
      CASE WHEN source_user_id = '' THEN 'source_user_id vacio' END,
      CASE WHEN target_user_id = '' THEN 'target_user_id vacio' END,
      CASE WHEN created_at IS NULL THEN 'fecha invalida' END) AS error_reason
  FROM processed""",
    "valid": "SELECT * FROM checked WHERE error_reason = ''",
    "notes": f"""
  SELECT 'ntf-' || event_id AS notification_id, event_id, event_type, target_user_id,
         notification_text AS message, 'sent' AS delivery_status,
         {ms('created_at')} AS created_at,
         {ms(f"created_at + to_seconds({R.latency_base_seconds} + pos % {R.latency_cycle})")} AS delivered_at,
         CAST({R.latency_base_seconds} + pos % {R.latency_cycle} AS BIGINT) AS latency_seconds
  FROM (SELECT *, row_number() OVER (ORDER BY created_at DESC, event_id) - 1 AS pos FROM valid)""",
    "hist": f"""
  SELECT event_id, ts, user_id, event_type, props,
    count(*) OVER (PARTITION BY user_id ORDER BY ts
                   RANGE BETWEEN INTERVAL {R.velocity_window_seconds} SECONDS PRECEDING AND CURRENT ROW)
      AS interaction_velocity_5m,
    (epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY user_id))) // 86400000000 AS account_age_days,
    coalesce(avg(CASE WHEN event_type = '{R.report_event_type}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS historical_report_rate
  FROM events""",
    "mraw": _adapter("hist", ", interaction_velocity_5m, account_age_days, historical_report_rate"),
    "mdup": """
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY trim(event_id) ORDER BY seq) > 1 THEN 1 ELSE 0 END
    AS is_duplicate FROM mraw""",
    "mrisk": f"""
  SELECT *,
    (lower(trim(event_type)) NOT IN ({ALLOWED}) OR trim(source_user_id) = '' OR trim(target_user_id) = ''
     OR try_cast(created_at AS TIMESTAMP) IS NULL OR is_duplicate = 1) AS _rule,
    (interaction_velocity_5m >= {R.velocity_risk_min} OR historical_report_rate >= {R.report_rate_risk_min}
     OR (account_age_days <= {R.young_account_max_days}
         AND historical_report_rate >= {R.young_account_report_rate_min})) AS _hist
  FROM mdup""",
    "model": """
  SELECT seq, event_id, event_type, source_user_id, target_user_id, created_at, content,
         interaction_velocity_5m, account_age_days, historical_report_rate, is_duplicate,
         CASE WHEN NOT _rule AND _hist THEN 1 ELSE 0 END AS historical_feedback_risk,
         CASE WHEN _rule OR _hist THEN 1 ELSE 0 END AS label_risky_event
  FROM mrisk""",
    "feat": f"""
  SELECT seq, event_id, source_user_id, target_user_id, created_at, content,
    lower(trim(event_type)) AS event_type,
    CAST(length(content) AS BIGINT) AS content_length,
    coalesce(hour(try_cast(created_at AS TIMESTAMP)), -1) AS hour,
    coalesce(isodow(try_cast(created_at AS TIMESTAMP)) - 1, -1) AS day_of_week,
    {", ".join(f"coalesce(try_cast(CAST({c} AS VARCHAR) AS DOUBLE), (SELECT median(try_cast(CAST({c} AS VARCHAR) AS DOUBLE)) FROM model), 0.0::DOUBLE) AS {c}" for c in ("interaction_velocity_5m", "account_age_days", "historical_report_rate"))},
    is_duplicate, historical_feedback_risk, label_risky_event,
    CASE WHEN trim(source_user_id) <> '' THEN 1 ELSE 0 END AS has_source_user,
    CASE WHEN trim(target_user_id) <> '' THEN 1 ELSE 0 END AS has_target_user,
    CASE WHEN try_cast(created_at AS TIMESTAMP) IS NOT NULL THEN 1 ELSE 0 END AS has_valid_date,
    CASE WHEN lower(trim(event_type)) IN ({ALLOWED}) THEN 1 ELSE 0 END AS is_allowed_event_type,
    CASE WHEN lower(trim(event_type)) = 'like' THEN 1 ELSE 0 END AS event_type_like,
    CASE WHEN lower(trim(event_type)) = 'comment' THEN 1 ELSE 0 END AS event_type_comment,
    CASE WHEN lower(trim(event_type)) = 'follow' THEN 1 ELSE 0 END AS event_type_follow,
    CASE WHEN lower(trim(event_type)) NOT IN ({ALLOWED}) THEN 1 ELSE 0 END AS event_type_invalid
  FROM model""",
    "split": f"""
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY label_risky_event
                        ORDER BY md5(CAST(seq AS VARCHAR) || '|{R.seed}'), seq)
                      <= greatest(1, CAST(round_even(count(*) OVER (PARTITION BY label_risky_event)
                                                     * {R.test_fraction}::DOUBLE, 0) AS BIGINT))
                 THEN 'test' ELSE 'train' END AS split
  FROM feat""",
}


def _z_expr(model) -> str:
    terms = [f"{float(model.intercept)!r}::DOUBLE"]
    for c, w, m, s in zip(model.features, model.weights, model.mean, model.std):
        terms.append(f"{float(w)!r}::DOUBLE * ((CAST({c} AS DOUBLE) - {float(m)!r}::DOUBLE) / {float(s)!r}::DOUBLE)")
    return " + ".join(terms)


def sigmoid_sql(z: str) -> str:
    return f"1.0::DOUBLE / (1.0::DOUBLE + exp(-greatest(least({z}, 500.0::DOUBLE), -500.0::DOUBLE)))"


CTE["scored"] = f"SELECT *, {sigmoid_sql(_z_expr(REFERENCE_MODEL))} AS _p FROM split"
CTE["test"] = "SELECT *, label_risky_event AS label, _p AS probability FROM scored WHERE split = 'test'"
CTE["roc"] = """
  SELECT score, pos, neg,
         sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
         sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
  FROM (SELECT probability AS score, count_if(label = 1) AS pos, count_if(label = 0) AS neg
        FROM test GROUP BY probability)"""
# Decision-time rule reasons on the raw model table (own trim/parse).
CTE["reasons"] = f"""
  SELECT *, concat_ws('; ',
      CASE WHEN trim(event_id) = '' THEN 'event_id vacio' END,
      CASE WHEN lower(trim(event_type)) NOT IN ({ALLOWED}) THEN 'tipo de evento fuera del alcance' END,
      CASE WHEN trim(source_user_id) = '' THEN 'source_user_id vacio' END,
      CASE WHEN trim(target_user_id) = '' THEN 'target_user_id vacio' END,
      CASE WHEN try_cast(created_at AS TIMESTAMP) IS NULL THEN 'fecha invalida' END,
      CASE WHEN is_duplicate = 1 THEN 'evento duplicado' END) AS rule_error_reason
  FROM model"""
CTE["mscored"] = f"""
  SELECT r.*, f._pz FROM reasons r JOIN (SELECT seq, {sigmoid_sql(_z_expr(REFERENCE_MODEL))} AS _pz FROM feat) f USING (seq)"""
CTE["decisions"] = f"""
  SELECT seq, event_id, event_type, source_user_id, target_user_id, created_at, is_duplicate, rule_error_reason,
    round(_pz, 4) AS ai_risk_probability,
    CASE WHEN _pz >= {R.threshold} THEN 'riesgoso' ELSE 'valido' END AS ai_prediction,
    CASE WHEN rule_error_reason <> '' THEN 'rechazado_por_reglas'
         WHEN round(_pz, 4) >= {R.threshold} THEN 'revision_por_ia' ELSE 'aprobado_para_notificar' END AS final_decision,
    CASE WHEN rule_error_reason <> '' THEN 'No pasa reglas duras del pipeline: ' || rule_error_reason
         WHEN round(_pz, 4) >= {R.threshold} THEN 'Pasa reglas duras, pero el modelo IA estima riesgo alto.'
         ELSE 'Pasa reglas duras y el modelo IA estima riesgo bajo.' END AS decision_explanation
  FROM mscored"""

DEPENDS = {
    "norm": ["raw"], "processed": ["norm"], "checked": ["processed"], "valid": ["checked"],
    "notes": ["valid"], "mraw": ["hist"], "mdup": ["mraw"], "mrisk": ["mdup"], "model": ["mrisk"],
    "feat": ["model"], "split": ["feat"], "scored": ["split"], "test": ["scored"], "roc": ["test"],
    "reasons": ["model"], "mscored": ["reasons", "feat"], "decisions": ["mscored"],
}


def with_ctes(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            visit(dep)
        if name not in order:
            order.append(name)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in order) + "\n" + body


PROCESSED_COLS = "seq, event_id, event_type, source_user_id, target_user_id, " + ms("created_at") + \
    " AS created_at, content, notification_text"
FEATURE_LIST = ", ".join(FEATURE_COLUMNS)


_KPI_SQL = """
SELECT count(*) AS events_processed, CAST(count_if(error_reason = '') AS BIGINT) AS valid_events,
       CAST(count_if(error_reason <> '') AS BIGINT) AS rejected_events,
       (SELECT count(*) FROM notes) AS notifications_generated,
       round(coalesce(100.0::DOUBLE * (SELECT count_if(delivery_status = 'sent') FROM notes)
                      / nullif((SELECT count(*) FROM notes), 0), 0.0), 2) AS delivery_success_rate_pct,
       round(coalesce(100.0::DOUBLE * count_if(error_reason <> '') / nullif(count(*), 0), 0.0), 2) AS error_rate_pct,
       round(coalesce((SELECT avg(CAST(latency_seconds AS DOUBLE)) FROM notes), 0.0), 2) AS avg_latency_seconds,
       round(coalesce(100.0::DOUBLE * count_if(error_reason = '') / nullif(count(*), 0), 0.0), 2) AS completeness_rate_pct{more}
FROM {source}"""


_IMPUTED_SQL = f"""
SELECT seq, eid AS event_id, coalesce(v, quantile_cont(v, 0.5) OVER ()) AS interaction_velocity_5m,
       coalesce(a, quantile_cont(a, 0.5) OVER ()) AS account_age_days, 0.0::DOUBLE AS historical_report_rate,
       concat_ws('; ',
         CASE WHEN eid = '' THEN 'event_id vacio' END,
         CASE WHEN event_type NOT IN ({ALLOWED}) THEN 'tipo de evento invalido' END,
         CASE WHEN source_user_id = '' THEN 'source_user_id vacio' END,
         CASE WHEN target_user_id = '' THEN 'target_user_id vacio' END,
         CASE WHEN created_at IS NULL THEN 'fecha invalida' END) AS error_reason
FROM (SELECT *, CASE WHEN seq % 50 = 0 THEN '' ELSE event_id END AS eid,
             CASE WHEN seq % 11 >= 4 THEN CAST(seq % 61 AS DOUBLE) END AS v,
             CASE WHEN seq % 13 <> 0 THEN seq % 700 + 0.5::DOUBLE END AS a FROM norm)"""


def _metrics_sql(score_expr_table: str) -> str:
    """ML-7 over a table with ``score``/``pos``/``neg``/``cum_pos``/``cum_neg``."""
    t = R.threshold
    return f"""
SELECT round((tn + tp) / greatest(1, tn + fp + fn + tp)::DOUBLE, 4) AS accuracy,
       round(prec, 4) AS precision, round(rec, 4) AS recall,
       round(2 * prec * rec / greatest(1e-12, prec + rec), 4) AS f1_score,
       round(auc, 4) AS roc_auc, round(2 * auc - 1, 4) AS gini, {float(t)}::DOUBLE AS threshold,
       tn AS true_negatives_valid_detected, fp AS false_positives_valid_marked_risky,
       fn AS false_negatives_risky_marked_valid, tp AS true_positives_risky_detected
FROM (
  SELECT *, tp / greatest(1, tp + fp)::DOUBLE AS prec, tp / greatest(1, tp + fn)::DOUBLE AS rec
  FROM (
    SELECT CAST(P - tp AS BIGINT) AS fn, CAST(N - fp AS BIGINT) AS tn, CAST(tp AS BIGINT) AS tp,
           CAST(fp AS BIGINT) AS fp, area2 / (2.0 * greatest(1, N) * greatest(1, P)) AS auc
    FROM (
      SELECT sum(pos) AS P, sum(neg) AS N,
             coalesce(sum(CASE WHEN score >= {t} THEN pos ELSE 0 END), 0) AS tp,
             coalesce(sum(CASE WHEN score >= {t} THEN neg ELSE 0 END), 0) AS fp,
             coalesce(sum(CAST(neg * (2 * cum_pos - pos) AS DOUBLE)), 0.0) AS area2
      FROM {score_expr_table})))"""


def _quality_sql() -> str:
    counts = [
        ("rows", "count(*)"),
        ("missing_source_user", "count_if(has_source_user = 0)"),
        ("missing_target_user", "count_if(has_target_user = 0)"),
        ("invalid_dates", "count_if(has_valid_date = 0)"),
        ("duplicate_events", "coalesce(sum(is_duplicate), 0)"),
        ("invalid_event_types", "count_if(is_allowed_event_type = 0)"),
        ("valid_events", f"count_if({LABEL_COLUMN} = 0)"),
        ("risky_events", f"count_if({LABEL_COLUMN} = 1)"),
    ]
    parts = [
        f"SELECT '{name}' AS indicator, CAST({expr} AS DOUBLE) AS value, NULL::VARCHAR AS text_value, {i} AS position FROM feat"
        for i, (name, expr) in enumerate(counts)
    ]
    for ci, c in enumerate(STATISTIC_COLUMNS):
        base = 8 + 5 * ci
        x = f"CAST({c} AS DOUBLE)"
        stats = [
            ("mean", f"(SELECT avg({x}) FROM feat)"),
            ("median", f"(SELECT quantile_cont({x}, 0.5) FROM feat)"),
            ("mode", f"(SELECT v FROM (SELECT {x} AS v, count(*) AS c FROM feat WHERE {x} IS NOT NULL GROUP BY 1) ORDER BY c DESC, v LIMIT 1)"),
            ("p25", f"(SELECT quantile_cont({x}, 0.25) FROM feat)"),
            ("p75", f"(SELECT quantile_cont({x}, 0.75) FROM feat)"),
        ]
        for si, (stat, expr) in enumerate(stats):
            parts.append(
                f"SELECT '{c}_{stat}' AS indicator, coalesce(round({expr}, 4), 0.0) AS value, NULL::VARCHAR AS text_value, {base + si} AS position"
            )
    parts.append(
        f"SELECT 'imputation_strategy' AS indicator, NULL::DOUBLE AS value, '{IMPUTATION_NOTE}' AS text_value, {8 + 5 * len(STATISTIC_COLUMNS)} AS position"
    )
    return "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n)"


def _correlation_sql() -> str:
    cols = list(FEATURE_COLUMNS) + [LABEL_COLUMN]
    aggs, cells = [], []
    for i, j in combinations(range(len(cols)), 2):
        a, b = f"CAST({cols[i]} AS DOUBLE)", f"CAST({cols[j]} AS DOUBLE)"
        aggs.append(f"covar_pop({a}, {b}) AS c_{i}_{j}")
        aggs.append(f"stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) AS sa_{i}_{j}")
        aggs.append(f"stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END) AS sb_{i}_{j}")
        v = f"round(CASE WHEN sa_{i}_{j} > 0 AND sb_{i}_{j} > 0 THEN c_{i}_{j} / (sa_{i}_{j} * sb_{i}_{j}) END, 6)"
        cells.append(f"SELECT '{cols[i]}' AS row_feature, '{cols[j]}' AS column_feature, {v} AS correlation FROM m")
        cells.append(f"SELECT '{cols[j]}' AS row_feature, '{cols[i]}' AS column_feature, {v} AS correlation FROM m")
    for i, c in enumerate(cols):
        aggs.append(f"stddev_pop(CAST({c} AS DOUBLE)) AS s_{i}")
        cells.append(f"SELECT '{c}' AS row_feature, '{c}' AS column_feature, CASE WHEN s_{i} > 0 THEN 1.0::DOUBLE END AS correlation FROM m")
    return with_ctes(
        ", m AS (SELECT " + ", ".join(aggs) + " FROM feat)\n" + "\nUNION ALL\n".join(cells), "feat"
    ).replace("\n, m AS", ",\nm AS", 1)


def _roc_sql() -> str:
    return with_ctes(
        """
SELECT row_number() OVER (ORDER BY score DESC) AS point,
       cum_neg / greatest(1, (SELECT count_if(label = 0) FROM test))::DOUBLE AS false_positive_rate,
       cum_pos / greatest(1, (SELECT count_if(label = 1) FROM test))::DOUBLE AS true_positive_rate
FROM roc
UNION ALL SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
UNION ALL SELECT (SELECT count(*) + 1 FROM roc), count_if(label = 0) / greatest(1, count_if(label = 0))::DOUBLE,
                 count_if(label = 1) / greatest(1, count_if(label = 1))::DOUBLE FROM test""",
        "roc",
    )


def _selection_sql() -> str:
    """ML-10/11 on the SQL-expressible candidates: baseline and stored linear model."""
    base = """
  SELECT score, pos, neg,
         sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
         sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
  FROM (SELECT {score} AS score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM test GROUP BY 1)"""
    baseline = base.format(score="(SELECT avg(CAST(label_risky_event AS DOUBLE)) FROM scored WHERE split = 'train')")
    linear = base.format(score="probability")
    body = f"""
, cmp AS (
  SELECT 'baseline_clase_mayoritaria' AS model, * FROM ({_metrics_sql('(' + baseline + ')')})
  UNION ALL
  SELECT 'regresion_logistica' AS model, * FROM ({_metrics_sql('(' + linear + ')')}))
, best AS (SELECT model AS best_model, f1_score AS best_f1 FROM cmp ORDER BY f1_score DESC, roc_auc DESC, recall DESC, model LIMIT 1)
SELECT cmp.*, CASE WHEN cmp.model = (SELECT CASE WHEN (SELECT f1_score FROM cmp WHERE model = 'regresion_logistica')
                                              >= best_f1 - {0.03} THEN 'regresion_logistica' ELSE best_model END FROM best)
                   THEN 1 ELSE 0 END AS selected
FROM cmp"""
    return with_ctes(body, "test", "scored").replace("\n\n, cmp AS", ",\ncmp AS", 1).replace("\n, cmp AS", ",\ncmp AS", 1).replace("\n, best AS", ",\nbest AS", 1)


def _lookup_sql() -> str:
    tables = {
        "notifications": "SELECT event_id, event_type, target_user_id, created_at FROM notes",
        "validated_events": f"SELECT event_id, event_type, target_user_id, {ms('created_at')} AS created_at FROM valid",
        "rejected_events": f"SELECT event_id, event_type, target_user_id, {ms('created_at')} AS created_at FROM checked WHERE error_reason <> ''",
    }
    keys = {
        "user": ("target_user_id", f"SELECT DISTINCT target_user_id AS k FROM norm WHERE target_user_id <> '' AND md5(target_user_id) < '{LOOKUP_USERS_BELOW}'"),
        "id": ("event_id", f"SELECT DISTINCT event_id AS k FROM norm WHERE md5(event_id) < '{LOOKUP_IDS_BELOW}'"),
    }
    parts = []
    for kind, (column, of) in keys.items():
        for name, table in tables.items():
            for lookup, wanted in ((f"{kind}_set", of), (f"{kind}_value", f"SELECT k FROM ({of}) ORDER BY md5(k) LIMIT {LOOKUP_POINTS}")):
                parts.append(f"SELECT '{lookup}' AS lookup, '{name}' AS table_name, * FROM ({table}) WHERE {column} IN (SELECT k FROM ({wanted}))")
    return with_ctes("\nUNION ALL\n".join(parts), "notes", "valid", "checked", "norm")


def _contribution_sql() -> str:
    m = REFERENCE_MODEL
    parts = [
        f"SELECT '{c}' AS feature, round({float(w)!r}::DOUBLE, 6) AS weight, round(abs({float(w)!r}::DOUBLE), 6) AS abs_weight, "
        f"round(round({float(w)!r}::DOUBLE, 6) * avg((CAST({c} AS DOUBLE) - {float(a)!r}::DOUBLE) / {float(s)!r}::DOUBLE), 6) AS mean_contribution FROM feat"
        for c, w, a, s in zip(m.features, m.weights, m.mean, m.std, strict=True)
    ]
    return with_ctes("\nUNION ALL\n".join(parts), "feat")


def _subjects_sql() -> str:
    count = {
        "metricas_modelo": "1", "comparacion_modelos": "1", "matriz_confusion": "(SELECT count(DISTINCT label) FROM test)",
        "curva_roc": "(SELECT count(*) + 2 FROM roc)", "pesos_variables": str(len(FEATURE_COLUMNS)), "predicciones_nuevas": "0", "rendimiento_ia": "1",
        "calidad_datos": "9", "estadisticas_calidad": str(5 * len(STATISTIC_COLUMNS)), "decisiones_finales": "(SELECT count(*) FROM decisions)",
        "resumen_decisiones": "(SELECT count(DISTINCT final_decision) FROM decisions)",
    }
    users = "(SELECT count_if(trim(source_user_id) <> '') FROM decisions)"
    parts = [
        f"SELECT '{name}' AS subject, CAST({n} AS BIGINT) AS n_rows, CAST({users if name == 'decisiones_finales' else 0} AS BIGINT) AS n_user_keys"
        for name, n in count.items()
    ]
    return with_ctes("\nUNION ALL\n".join(parts), "roc", "decisions")


def _gradient_sql() -> str:
    """ML-4: the same steps as a recursion over one row of weights."""
    n = len(FEATURE_COLUMNS)
    weights = [f"w{i}" for i in range(n + 1)]
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, coalesce(nullif(stddev_pop(CAST({c} AS DOUBLE)), 0), 1.0) AS s{i}" for i, c in enumerate(FEATURE_COLUMNS, 1))
    z = ", ".join(f"(CAST({c} AS DOUBLE) - m{i}) / s{i} AS x{i}" for i, c in enumerate(FEATURE_COLUMNS, 1))
    score = " + ".join(["w0", *(f"w{i} * x{i}" for i in range(1, n + 1))])
    moved = ["any_value(w0) - 0.08 * sum(e) / count(*)", *(f"any_value(w{i}) - 0.08 * (sum(e * x{i}) + 0.01 * any_value(w{i})) / count(*)" for i in range(1, n + 1))]
    body = f"""
, tr AS (SELECT * FROM split WHERE split = 'train')
, st AS (SELECT {stats} FROM tr)
, zt AS MATERIALIZED (SELECT {LABEL_COLUMN}::DOUBLE AS y, {z} FROM tr, st)
, steps(k, {', '.join(weights)}) AS (
  SELECT 0, {', '.join('0.0::DOUBLE' for _ in weights)}
  UNION ALL
  SELECT any_value(k) + 1, {', '.join(moved)}
  FROM (SELECT steps.*, zt.*, {sigmoid_sql(score)} - y AS e FROM steps, zt WHERE k < {GRADIENT_STEPS}) HAVING count(*) > 0)
""" + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS feature, round({w}, 6) AS weight FROM steps WHERE k = {GRADIENT_STEPS}" for name, w in zip(("intercept", *FEATURE_COLUMNS), weights, strict=True)
    )
    return "WITH RECURSIVE" + with_ctes(body, "split").replace("\n\n, tr AS", ",\ntr AS", 1).replace("\n, tr AS", ",\ntr AS", 1).removeprefix("WITH")


def _tree_sql(tree) -> str:
    if isinstance(tree, float):
        return f"{tree!r}::DOUBLE"
    return f"CASE WHEN CAST({tree.feature} AS DOUBLE) <= {tree.threshold!r}::DOUBLE THEN {_tree_sql(tree.low)} ELSE {_tree_sql(tree.high)} END"


def _forest_sql() -> str:
    p = "(" + " + ".join(_tree_sql(t) for t in STORED_FOREST) + f") / {float(len(STORED_FOREST))!r}::DOUBLE"
    return with_ctes(
        f"SELECT seq, event_id, round(p, 6) AS risk_probability, CASE WHEN p >= {R.threshold} THEN 'riesgoso' ELSE 'valido' END AS prediction "
        f"FROM (SELECT seq, event_id, {p} AS p FROM feat)", "feat")


def _feed_sql() -> str:
    names = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "gini", "threshold", "true_positives_risky_detected", "false_positives_valid_marked_risky")
    parts = [f"SELECT 'metrics' AS section, '{m}' AS name, NULL::VARCHAR AS text_value, round(CAST({m} AS DOUBLE), 6) AS number_value FROM met" for m in names]
    parts.append(f"SELECT 'quality', indicator, text_value, round(value, 6) FROM ({_quality_sql()})")
    parts.append(
        "SELECT 'decisions', event_id || '|' || event_type || '|' || created_at, ai_prediction || '|' || final_decision, round(ai_risk_probability, 6) "
        "FROM (SELECT d.event_id, f.event_type, d.created_at, d.ai_prediction, d.final_decision, d.ai_risk_probability FROM decisions d JOIN feat f USING (seq))"
    )
    parts.append("SELECT 'selected_model', 'selected_model', 'regresion_logistica', NULL::DOUBLE")
    body = f", met AS ({_metrics_sql('roc')})\n" + "\nUNION ALL\n".join(parts)
    return with_ctes(body, "roc", "feat", "decisions").replace("\n, met AS", ",\nmet AS", 1)


def oracle_queries() -> dict[str, str]:
    allowed_views = " UNION ALL ".join(
        f"SELECT '{t}' AS view_name, *, row_number() OVER (PARTITION BY event_type ORDER BY created_at DESC, event_id) - 1 AS position FROM valid WHERE event_type = '{t}'"
        for t in ALLOWED_EVENT_TYPES
    )
    q = {
        "clean_events": with_ctes(f"SELECT {PROCESSED_COLS} FROM processed", "processed"),
        "duplicate_flags": with_ctes(
            "SELECT seq, event_id, CASE WHEN row_number() OVER (PARTITION BY trim(event_id) ORDER BY seq) > 1 "
            "THEN 1 ELSE 0 END AS is_duplicate FROM raw",
            "raw",
        ),
        "valid_events": with_ctes(f"SELECT {PROCESSED_COLS} FROM valid", "valid"),
        "rejected_events": with_ctes(f"SELECT {PROCESSED_COLS}, error_reason FROM checked WHERE error_reason <> ''", "checked"),
        "rejection_reasons": with_ctes(
            "SELECT error_reason, count(*) AS count FROM checked WHERE error_reason <> '' GROUP BY 1", "checked"
        ),
        "notifications": with_ctes("SELECT * FROM notes", "notes"),
        "kpi_report": with_ctes(_KPI_SQL.format(more="", source="checked"), "checked", "notes"),
        "etl_job_kpis": with_ctes(_KPI_SQL.format(more=", (SELECT count(*) FROM raw) AS input_rows", source="checked"), "checked", "notes"),
        "measured_run": with_ctes(
            "SELECT (SELECT count(*) FROM raw) AS input_rows, count(*) AS events_processed, CAST(count_if(error_reason = '') AS BIGINT) AS valid_events, "
            "CAST(count_if(error_reason <> '') AS BIGINT) AS rejected_events, (SELECT count(*) FROM notes) AS notifications_generated FROM checked",
            "checked", "notes",
        ),
        "table_lookups": _lookup_sql(),
        "feature_contributions": _contribution_sql(),
        "gradient_weights": _gradient_sql(),
        "forest_expression_scores": _forest_sql(),
        "feed_round_trip": _feed_sql(),
        "sql_function_decisions": with_ctes(
            "SELECT seq, event_id, rule_error_reason, ai_risk_probability, final_decision, decision_explanation, "
            f"CASE WHEN trim(coalesce(source_user_id, '')) = '' OR lower(trim(source_user_id)) = 'nan' THEN '' "
            f"ELSE 'usr_' || substr(sha256('{EXPORT_SALT}:' || trim(source_user_id)), 1, 10) END AS source_user_key, "
            f"{ms('try_cast(created_at AS TIMESTAMP)')} AS created_at FROM decisions",
            "decisions",
        ),
        "merged_increments": with_ctes(
            "\nUNION ALL\n".join(
                f"SELECT '{c}' AS \"column\", count({c}) AS n, count(*) - count({c}) AS nulls, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
                f"min(CAST({c} AS DOUBLE)) AS low, max(CAST({c} AS DOUBLE)) AS high, 1 AS quantiles_within_bound, 1 AS distinct_within_bound FROM feat"
                for c in STATISTIC_COLUMNS
            ),
            "feat",
        ),
        "streamed_signals": with_ctes(
            "SELECT event_id AS seq, interaction_velocity_5m, round(historical_report_rate, 6) AS historical_report_rate FROM hist WHERE ts IS NOT NULL", "hist"
        ),
        "bi_subjects": _subjects_sql(),
        "reloaded_scores": with_ctes(
            f"SELECT s.seq, s.event_id, m.event_type, round(_p, 4) AS risk_probability, CASE WHEN _p >= {R.threshold} THEN 'riesgoso' ELSE 'valido' END AS prediction "
            "FROM scored s JOIN (SELECT seq, event_type FROM model) m USING (seq)",
            "scored", "model",
        ),
        "recent_events": with_ctes(
            f"SELECT {PROCESSED_COLS}, row_number() OVER (ORDER BY created_at DESC, event_id) - 1 AS position FROM valid",
            "valid",
        ),
        "recent_by_type": with_ctes(
            f"SELECT view_name, {PROCESSED_COLS}, position FROM ({allowed_views})", "valid"
        ),
        "velocity": with_ctes("SELECT seq, interaction_velocity_5m FROM model", "model"),
        "account_age": with_ctes("SELECT seq, account_age_days FROM model", "model"),
        "report_rate": with_ctes("SELECT seq, round(historical_report_rate, 6) AS historical_report_rate FROM model", "model"),
        "risk_label": with_ctes(
            "SELECT seq, event_id, is_duplicate, historical_feedback_risk, label_risky_event FROM model", "model"
        ),
        "feature_matrix": with_ctes(f"SELECT seq, {FEATURE_LIST}, {LABEL_COLUMN} FROM feat", "feat"),
        "event_type_counts": with_ctes(
            "SELECT CASE WHEN event_type = '' THEN 'vacio' ELSE event_type END AS event_type, count(*) AS count FROM feat GROUP BY 1",
            "feat",
        ),
        "label_counts": with_ctes(
            f"SELECT CASE WHEN {LABEL_COLUMN} = 1 THEN 'riesgoso' ELSE 'valido' END AS label, count(*) AS count FROM feat GROUP BY 1",
            "feat",
        ),
        "risk_by_event_type": with_ctes(
            f"SELECT event_type, avg(CAST({LABEL_COLUMN} AS DOUBLE)) AS risk_rate FROM feat GROUP BY 1", "feat"
        ),
        "distinct_event_types": with_ctes("SELECT DISTINCT event_type FROM feat", "feat"),
        "quality_summary": with_ctes(_quality_sql(), "feat"),
        "quality_statistics": with_ctes(
            f"SELECT * FROM ({_quality_sql()}) WHERE regexp_matches(indicator, '_(?:mean|median|mode|p25|p75)$')", "feat"
        ),
        "quality_operational": with_ctes(
            f"SELECT * FROM ({_quality_sql()}) WHERE NOT regexp_matches(indicator, '_(?:mean|median|mode|p25|p75)$')", "feat"
        ),
        "correlation_matrix": _correlation_sql(),
        "stratified_split": with_ctes(f"SELECT seq, {LABEL_COLUMN}, split FROM split", "split"),
        "standardized_features": with_ctes(
            ", st AS (SELECT "
            + ", ".join(
                f"avg(CAST({c} AS DOUBLE)) AS m_{c}, CASE WHEN coalesce(stddev_pop(CAST({c} AS DOUBLE)), 0) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}"
                for c in FEATURE_COLUMNS
            )
            + " FROM split WHERE split = 'train')\nSELECT seq, split, "
            + ", ".join(f"round((CAST({c} AS DOUBLE) - m_{c}) / s_{c}, 6) AS {c}_z" for c in FEATURE_COLUMNS)
            + " FROM split, st",
            "split",
        ).replace("\n, st AS", ",\nst AS", 1),
        "linear_scores": with_ctes(
            f"SELECT seq, round(_p, 4) AS risk_probability, CASE WHEN _p >= {R.threshold} THEN 'riesgoso' ELSE 'valido' END AS prediction FROM scored",
            "scored",
        ),
        "new_event_scores": with_ctes(
            ", nf AS (SELECT seq, event_id, CAST(length(content) AS BIGINT) AS content_length, "
            "coalesce(hour(try_cast(created_at AS TIMESTAMP)), -1) AS hour, "
            "coalesce(isodow(try_cast(created_at AS TIMESTAMP)) - 1, -1) AS day_of_week, "
            "0.0::DOUBLE AS interaction_velocity_5m, 0.0::DOUBLE AS account_age_days, 0.0::DOUBLE AS historical_report_rate, "
            "0 AS is_duplicate, "
            "CASE WHEN trim(source_user_id) <> '' THEN 1 ELSE 0 END AS has_source_user, "
            "CASE WHEN trim(target_user_id) <> '' THEN 1 ELSE 0 END AS has_target_user, "
            "CASE WHEN try_cast(created_at AS TIMESTAMP) IS NOT NULL THEN 1 ELSE 0 END AS has_valid_date, "
            f"CASE WHEN lower(trim(event_type)) IN ({ALLOWED}) THEN 1 ELSE 0 END AS is_allowed_event_type, "
            "CASE WHEN lower(trim(event_type)) = 'like' THEN 1 ELSE 0 END AS event_type_like, "
            "CASE WHEN lower(trim(event_type)) = 'comment' THEN 1 ELSE 0 END AS event_type_comment, "
            "CASE WHEN lower(trim(event_type)) = 'follow' THEN 1 ELSE 0 END AS event_type_follow, "
            f"CASE WHEN lower(trim(event_type)) NOT IN ({ALLOWED}) THEN 1 ELSE 0 END AS event_type_invalid FROM raw)\n"
            f"SELECT seq, event_id, round(_p, 4) AS risk_probability, CASE WHEN _p >= {R.threshold} THEN 'riesgoso' ELSE 'valido' END AS prediction "
            f"FROM (SELECT *, {sigmoid_sql(_z_expr(REFERENCE_MODEL))} AS _p FROM nf)",
            "raw",
        ).replace("\n, nf AS", ",\nnf AS", 1),
        "test_predictions": with_ctes(
            f"SELECT seq, {FEATURE_LIST}, {LABEL_COLUMN} AS real_label_risky_event, round(_p, 4) AS risk_probability, "
            f"CASE WHEN _p >= {R.threshold} THEN 1 ELSE 0 END AS predicted_label_risky_event, "
            f"CASE WHEN _p >= {R.threshold} THEN 'riesgoso' ELSE 'valido' END AS prediction_text FROM scored WHERE split = 'test'",
            "scored",
        ),
        "confusion_matrix": with_ctes(
            f"SELECT CASE WHEN label = 1 THEN 'real_riesgoso' ELSE 'real_valido' END AS real_class, "
            f"CAST(count_if(probability < {R.threshold}) AS BIGINT) AS pred_valido, "
            f"CAST(count_if(probability >= {R.threshold}) AS BIGINT) AS pred_riesgoso "
            "FROM test GROUP BY 1",
            "test",
        ),
        "roc_curve": _roc_sql(),
        "model_metrics": with_ctes(_metrics_sql("roc"), "roc"),
        "model_selection": _selection_sql(),
        "rule_reasons": with_ctes("SELECT seq, event_id, rule_error_reason FROM reasons", "reasons"),
        "final_decisions": with_ctes("SELECT * FROM decisions", "decisions"),
        "decision_summary": with_ctes("SELECT final_decision, count(*) AS count FROM decisions GROUP BY 1", "decisions"),
        "bi_decision_summary": with_ctes(
            "SELECT final_decision, count(*) AS count, replace(final_decision, '_', ' ') AS decision_label FROM decisions GROUP BY 1", "decisions"
        ),
        "serialized_events": with_ctes(f"SELECT seq, event_id, {ms('created_at')} AS created_at, content FROM norm", "norm"),
        "imputed_signals": with_ctes(_IMPUTED_SQL, "norm"),
        "decision_group_counts": with_ctes(
            "SELECT CASE WHEN coalesce(rule_error_reason, '') = '' THEN 'sin_valor' ELSE rule_error_reason END AS rule_error_reason, "
            "count(*) AS count FROM decisions GROUP BY 1",
            "decisions",
        ),
        "decision_filter": with_ctes(
            f"SELECT * FROM decisions WHERE (CASE WHEN coalesce(event_type, '') = '' THEN 'sin_tipo' ELSE event_type END) = '{FILTER_TYPE}' "
            f"AND final_decision = '{FILTER_DECISION}'",
            "decisions",
        ),
        "review_top": with_ctes(
            f"SELECT * FROM decisions WHERE final_decision = 'revision_por_ia' ORDER BY ai_risk_probability DESC, seq LIMIT {REVIEW_TOP_N}",
            "decisions",
        ),
        "decision_feed": with_ctes(
            "SELECT seq, event_id, event_type, created_at, ai_risk_probability, ai_prediction, final_decision FROM decisions",
            "decisions",
        ),
        "pseudonymized_export": with_ctes(
            "SELECT seq, event_id, event_type, created_at, is_duplicate, rule_error_reason, ai_risk_probability, ai_prediction, "
            "final_decision, decision_explanation, "
            + ", ".join(
                f"CASE WHEN trim(coalesce({c}, '')) = '' OR lower(trim({c})) = 'nan' THEN '' "
                f"ELSE 'usr_' || substr(sha256('{EXPORT_SALT}:' || trim({c})), 1, 10) END AS {k}"
                for c, k in (("source_user_id", "source_user_key"), ("target_user_id", "target_user_key"))
            )
            + " FROM decisions",
            "decisions",
        ),
    }
    return q
