import os
import shutil
import tempfile

from eventsieve.streaming import start_validation_stream
from tests.conftest import SF_SMALL


def test_stream_validates_and_deduplicates(spark):
    scratch = tempfile.mkdtemp(prefix="eventsieve-stream-")
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/events.parquet", os.path.join(src, "part-0.parquet"))
    query = start_validation_stream(spark, src, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    query.awaitTermination(300)
    valid = spark.read.parquet(os.path.join(scratch, "out", "valid"))
    rejected = spark.read.parquet(os.path.join(scratch, "out", "rejected"))
    # 1,000 rows, 40 of them repeat an id after trimming.
    assert valid.count() + rejected.count() == 960
    assert valid.groupBy("event_id").count().filter("count > 1").count() == 0
    assert rejected.filter("error_reason = ''").count() == 0
