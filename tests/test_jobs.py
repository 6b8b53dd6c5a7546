"""End-to-end jobs on the sf0.001 tables: outputs exist and agree."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eventsieve.plans.bi import build_bi_dataset
from eventsieve.plans.etl import run_etl
from eventsieve.plans.modeling import run_model_job
from eventsieve.session import ensure_checkpoint_dir, scratch_tables
from eventsieve.sinks.writers import verify_outputs
from eventsieve.sources.driver_tables import model_events, raw_events
from eventsieve.sources.readers import SourceFormatError, read_raw_csv, read_raw_events
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def out():
    return tempfile.mkdtemp(prefix="eventsieve-jobs-")


def test_etl_job_writes_and_verifies(spark, out):
    res = run_etl(spark, raw_events(spark, SF_SMALL), os.path.join(out, "etl"), bucketed_tables=True)
    k = res.kpis.first()
    assert k.input_rows == 1000 and k.events_processed == 960
    assert k.valid_events + k.rejected_events == k.events_processed
    assert all(verify_outputs(spark, {n: p for n, p in res.outputs.items() if n != "kpi_report"}).values())
    assert spark.read.json(res.outputs["kpi_report"]).first().latency_measurement_type == "simulada_para_demo"
    recent = spark.read.parquet(res.outputs["events_recent"])
    assert set(r[0] for r in recent.select("event_type").distinct().collect()) <= {"like", "comment", "follow"}
    assert spark.table("notifications").count() == k.notifications_generated


def test_model_and_bi_jobs(spark, out):
    res = run_model_job(spark, model_events(spark, SF_SMALL), output_dir=os.path.join(out, "model"), new_events=raw_events(spark, SF_SMALL).limit(40))
    assert res.new_event_predictions.count() == 40 and res.features.count() == 1000
    assert res.confusions.select("model").distinct().count() == 3
    cmp = res.comparison.collect()
    assert len(cmp) == 3 and sum(r.selected for r in cmp) == 1
    assert res.selected_model in {r.model for r in cmp}
    perf = res.performance.first()
    assert perf.train_rows + perf.test_rows == perf.dataset_rows == 1000
    counts = dict(res.decisions.groupBy("final_decision").count().collect())
    assert sum(counts.values()) == 1000
    paths = build_bi_dataset(spark, os.path.join(out, "model"), os.path.join(out, "bi"), "salt")
    exported = spark.read.parquet(paths["decisiones_finales"])
    assert "source_user_id" not in exported.columns and "content" not in exported.columns
    assert exported.filter(F.col("source_user_key").startswith("usr_") | (F.col("source_user_key") == "")).count() == 1000
    assert spark.read.json(os.path.join(out, "model", "model_metadata")).first().model == res.selected_model
    feed = spark.read.json(os.path.join(out, "model", "decision_feed"))
    assert "source_user_id" not in feed.columns and feed.count() == 1000
    labels = {r.decision_label for r in spark.read.parquet(paths["resumen_decisiones"]).collect()}
    assert labels <= {"rechazado por reglas", "revision por ia", "aprobado para notificar"}
    stats = spark.read.parquet(paths["estadisticas_calidad"]).count()
    ops = spark.read.parquet(paths["calidad_datos"]).count()
    assert (stats, ops) == (20, 9)


def test_readers(spark, out):
    path = os.path.join(out, "raw.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('event_id,event_type,content\nevt-1,like,"a, ""quoted""\nline"\nevt-2,NA,null\n')
    rows = {r.event_id: r for r in read_raw_csv(spark, path, multi_line=True).collect()}
    assert rows["evt-1"].content == 'a, "quoted"\nline'
    assert (rows["evt-2"].event_type, rows["evt-2"].content) == ("", "")
    xlsx = os.path.join(out, "raw.xlsx")
    open(xlsx, "wb").close()
    with pytest.raises(SourceFormatError):
        read_raw_events(spark, xlsx)
    with pytest.raises(FileNotFoundError):
        read_raw_events(spark, os.path.join(out, "missing.csv"))


def test_stored_copies_are_deleted_when_a_job_is_over(spark, out):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch_tables(spark):
        res = run_etl(spark, raw_events(spark, SF_SMALL), os.path.join(out, "etl2"), bucketed_tables=False)
        assert any(n.startswith("table-") for n in set(os.listdir(folder)) - before)
        assert res.processed.count() == 960
    assert not [n for n in set(os.listdir(folder)) - before if n.startswith("table-")]
    assert spark.read.parquet(res.outputs["events_processed"]).count() == 960


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    def session(master, registered=None, configured=None):
        conf = SimpleNamespace(get=lambda key, default=None: configured)
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: registered, setCheckpointDir=lambda p: None)
        return SimpleNamespace(conf=conf, sparkContext=context)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session("spark://host:7077"))
    assert ensure_checkpoint_dir(session("yarn", configured="hdfs:///ck")) == "hdfs:///ck"
    assert ensure_checkpoint_dir(session("yarn", "hdfs:///own", "hdfs:///ck")) == "hdfs:///own"
