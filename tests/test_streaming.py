import json

from tunefeed.operators.metrics import explode_metrics
from tunefeed.plans.views import damaged_log_rows
from tunefeed.streaming.metric_stream import LOG_SCHEMA, read_log_stream, write_metric_stream, write_reject_stream


def test_stream_equals_batch_and_does_not_repeat(spark, tmp_path):
    logs_dir, table, check = (str(tmp_path / n) for n in ("logs", "metrics", "check"))
    logs = damaged_log_rows(spark, "/root/testdata/sf0.001").cache()
    logs.filter("event_id % 2 = 0").write.json(logs_dir)

    def run():
        stream = read_log_stream(spark, logs_dir, max_files_per_trigger=1)
        write_metric_stream(stream, table, check).awaitTermination()
        return spark.read.parquet(table)

    def batch(df):
        return explode_metrics(df.withColumn("run_id", df.run_id.cast("string")))

    def same(a, b):
        a, b = (d.fillna(-1.0, ["value"]) for d in (a, b))
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(run(), batch(logs.filter("event_id % 2 = 0")))
    assert same(run(), batch(logs.filter("event_id % 2 = 0")))  # nothing new, nothing twice
    logs.filter("event_id % 2 = 1").write.mode("append").json(logs_dir)
    assert same(run(), batch(logs))
    logs.unpersist()


def test_each_line_is_in_metrics_in_rejects_or_empty(spark, tmp_path):
    source, base = tmp_path / "logs", str(tmp_path / "out")
    source.mkdir()
    texts = ['{"a": 1}', '{"a": 1} x', "{}", None, "null", "[1]", '{"a": 1, "a": 2, "b": 3}', '{"big": 9%s}' % ("9" * 400), '{"t": "x"}']
    lines = [json.dumps({"run_id": f"run-{i}", "step": i, "logs": t}) for i, t in enumerate(texts)]
    lines += ['{"run_id": "cut", "st', "no json", '{"run_id": "r", "step": "not a number", "logs": "{}"}']

    def run():
        logs = read_log_stream(spark, str(source), LOG_SCHEMA)
        write_metric_stream(logs, f"{base}/m", f"{base}/mc").awaitTermination()
        write_reject_stream(logs, f"{base}/r", f"{base}/rc").awaitTermination()
        metrics, rejects = spark.read.parquet(f"{base}/m"), spark.read.parquet(f"{base}/r")
        return (
            sorted((r.run_id, r.key, r.value) for r in metrics.collect()),
            sorted((r.key or "", r.reason, r.text) for r in rejects.collect()),
        )

    (source / "a.json").write_text("\n".join(lines[:5]) + "\n")
    run()
    (source / "b.json").write_text("\n".join(lines[5:]) + "\n")
    metrics, rejects = run()
    assert metrics == [("run-0", "a", 1.0), ("run-6", "b", 3.0)]
    assert rejects == sorted(
        [("", "broken line", t) for t in lines[-3:]]
        + [("", "not JSON", texts[1]), ("", "not a JSON object", "[1]")]
        + [("a", "duplicate key", texts[6])] * 2
        + [("big", "out of range", texts[7])]
    )
    assert run() == (metrics, rejects)  # a restart adds nothing
