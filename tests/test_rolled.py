"""Files of few rows are written by all cores, whatever they come from."""

import os

from pulseframe.sources import scan
from pulseframe.streaming import jobs


def test_rolled_files_of_one_input_file_have_several_writers(spark, tmp_path):
    path = str(tmp_path)
    spark.range(400).repartition(1).write.parquet(path + "/in")
    jobs.run(scan.stream_new_files(spark, path + "/in", spark.range(0).schema), path + "/out", path + "/checkpoint", roll_rows=10).awaitTermination()
    files = [n for n in os.listdir(path + "/out") if n.endswith(".parquet")]
    assert len({n.split("-")[1] for n in files}) > 1 and len(files) >= 40
    assert spark.read.parquet(path + "/out").distinct().count() == 400
