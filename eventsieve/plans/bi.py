"""JOB-3: BI export, one table per subject (SNK-6).

Reads the model job's tables (SRC-4), splits the quality table into
statistics and operational indicators (FLT-5 / SET-3), counts decisions
(AGG-6) and pseudonymises users (HSH-2).  Workbook styling is not built.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from eventsieve.functions.text import underscores_to_spaces
from eventsieve.operators.export import sanitize_decisions
from eventsieve.operators.stats import operational_part, statistics_part, value_counts
from eventsieve.sinks.writers import write_table
from eventsieve.sources.readers import read_stage_table

SUBJECTS = {
    "metricas_modelo": "model_metrics",
    "comparacion_modelos": "model_comparison",
    "matriz_confusion": "confusion_matrix",
    "curva_roc": "roc_curve_points",
    "pesos_variables": "feature_weights",
    "predicciones_nuevas": "new_event_predictions",
    "rendimiento_ia": "performance_summary",
}


def build_bi_dataset(spark: SparkSession, model_dir: str, output_dir: str, salt: str,
                     etl_kpi_path: str | None = None) -> dict[str, str]:
    paths: dict[str, str] = {}

    def put(name, df):
        paths[name] = os.path.join(output_dir, name)
        write_table(df, paths[name])

    for subject, source in SUBJECTS.items():
        put(subject, read_stage_table(spark, os.path.join(model_dir, source)))
    quality = read_stage_table(spark, os.path.join(model_dir, "quality_summary"))
    put("calidad_datos", operational_part(quality))
    put("estadisticas_calidad", statistics_part(quality))
    decisions = read_stage_table(spark, os.path.join(model_dir, "final_event_decisions"))
    put("decisiones_finales", sanitize_decisions(decisions, salt))
    summary = value_counts(decisions, "final_decision")
    put("resumen_decisiones", summary.withColumn("decision_label", underscores_to_spaces("final_decision")))
    if etl_kpi_path:  # a path that is given must be there, on any file system
        put("rendimiento_local", spark.read.json(etl_kpi_path))
    return paths
