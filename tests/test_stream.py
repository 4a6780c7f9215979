import json
import tempfile

from castwright.streaming.intake import read_intake_output, start_intake_stream


def test_stream_two_sinks_no_dedup(spark):
    base = tempfile.mkdtemp(prefix="castwright-stream-test-")
    body = json.dumps({"source_url": "https://e.com/a", "job_id": "same"})
    rows1 = [(1, body, False, {}), (2, "{bad", False, {})]
    rows2 = [(3, body, False, {})]  # the same job id again, in a later batch
    schema = "event_id long, body string, is_base64 boolean, query map<string,string>"
    spark.createDataFrame(rows1, schema).coalesce(1).write.parquet(f"{base}/in/a")
    spark.createDataFrame(rows2, schema).coalesce(1).write.parquet(f"{base}/in/b")
    q = start_intake_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    out = {r.event_id: r for r in read_intake_output(spark, f"{base}/out").collect()}
    assert out[1].outcome == "accepted" and out[3].outcome == "accepted"  # repeated job id is not dropped
    assert out[1].job_id == out[3].job_id == "same"
    assert out[2].outcome == "rejected" and out[2].error == "invalid JSON request body"
    assert len({out[1].batch_id, out[3].batch_id}) == 2  # two micro-batches
