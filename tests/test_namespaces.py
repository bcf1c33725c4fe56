"""Submissions of one namespace are dealt to all tasks."""

from pyspark.sql import functions as F

from pulseframe.operators import decode

NAMES = [("telemetry", 99, 99, ["docType"]), ("plain", 99, 99, None)]


def judged(spark, n=400):
    names = spark.createDataFrame(NAMES, "namespace string, max_data_length int, max_path_length int, dims array<string>")
    k = F.col("id")
    path = F.when(k % 10 == 0, None).when(k % 10 == 1, F.concat(F.lit("/submit/none/"), k)).otherwise(F.concat(F.lit("/submit/telemetry/"), k, F.lit("/main")))
    df = spark.range(n).withColumns({"path": path, "document": F.lit('{"clientId": "c"}')})
    return decode.validate_pings(df, names, {"main": {"required": ["clientId"]}})


def test_no_task_has_all_rows_of_a_namespace(spark, monkeypatch):
    plan = judged(spark)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    few = sorted(map(str, judged(spark).collect()))
    monkeypatch.setattr(decode, "MOST_NAMESPACES", 1)
    many = judged(spark)
    assert sorted(map(str, many.collect())) == few and len(few) == 400 and "_salt" not in many.columns
    assert "_salt" in many._jdf.queryExecution().optimizedPlan().toString()
    assert many.where("error_type is null").count() == 320
