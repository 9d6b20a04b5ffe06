import os
import tempfile

import pytest

from conftest import SF_SMALL
from ledgerlake.operators import bronze as B
from ledgerlake.operators import silver as S
from ledgerlake.plans import catalog as C
from ledgerlake.sources import sinks as K
from ledgerlake.streaming.ingest import start_silver_ingest


def test_streaming_ingest_matches_batch_and_resumes(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-stream-")
    source, silver_dir, ckpt = (os.path.join(root, p) for p in ("landing", "silver", "checkpoint"))
    raw = C.raw(spark, SF_SMALL)
    K.write_csv(raw, os.path.join(source, "batch1"))

    q = start_silver_ingest(spark, f"{source}/*", silver_dir, ckpt, "stream_run")
    q.awaitTermination(120)
    streamed = spark.read.parquet(silver_dir)
    batch = S.without_timestamps(C.silver(spark, SF_SMALL))
    cols = [c for c in batch.columns if c not in ("source_file_name", "pipeline_run_id")]
    assert streamed.count() == batch.count() == 946
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0

    # A second run with the same checkpoint picks up only the new file.
    K.write_csv(raw.limit(10), os.path.join(source, "batch2"))
    q2 = start_silver_ingest(spark, f"{source}/*", silver_dir, ckpt, "stream_run")
    q2.awaitTermination(120)
    added = spark.read.option("header", True).schema(raw.schema).csv(os.path.join(source, "batch2"))
    expected_new = S.silver_transactions(B.bronze_transactions(added)).count()
    assert spark.read.parquet(silver_dir).count() == 946 + expected_new
    assert {r.pipeline_run_id for r in spark.read.parquet(silver_dir).select("pipeline_run_id").distinct().collect()} == {"stream_run"}


def test_streaming_fails_on_a_line_that_does_not_parse(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-stream-")
    source, silver_dir, ckpt = (os.path.join(root, p) for p in ("landing", "silver", "checkpoint"))
    K.write_csv(C.raw(spark, SF_SMALL).limit(5), source)
    with open(os.path.join(source, "bad.csv"), "w") as f:
        f.write(",".join(C.raw(spark, SF_SMALL).columns) + "\n1,PAYMENT,not-a-number,C1,1.0,1.0,C2,1.0,1.0,0,0\n")
    q = start_silver_ingest(spark, source, silver_dir, ckpt, "stream_run")
    with pytest.raises(Exception):
        q.awaitTermination(120)
