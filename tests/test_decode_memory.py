"""What Python workers hold while they unpack submissions."""

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from pulseframe.operators import decode


def status(pid, key):
    return next((int(line.split()[1]) for line in Path(f"/proc/{pid}/status").read_text().splitlines() if line.startswith(key)), 0)


def workers(of):
    """The Python workers below a process."""
    parents = {}
    for p in Path("/proc").glob("[0-9]*"):
        try:
            parents[int(p.name)] = status(p.name, "PPid:"), b"pyspark.daemon" in (p / "cmdline").read_bytes()
        except OSError:
            continue

    def below(pid):
        while pid in parents and pid != of:
            pid = parents[pid][0]
        return pid == of

    return [pid for pid, (_, own) in parents.items() if own and below(pid)]


def test_workers_hold_no_batch_of_unpacked_documents(spark):
    """300 documents of one task, each unpacked up to the cap, which together have 600 MB."""
    me = status("self", "Pid:")
    bomb = bytearray(gzip.compress(b"0" * (decode.MOST_BYTES + 9)))
    df = spark.range(300, numPartitions=1).withColumn("u", decode.gunzipped(F.lit(bytes(bomb))))
    for pid in workers(me):  # the most that they held starts anew
        Path(f"/proc/{pid}/clear_refs").write_text("5")
    before = {pid: status(pid, "VmHWM:") for pid in workers(me)}
    assert [tuple(r) for r in df.groupBy("u.size", F.col("u.document").isNull()).count().collect()] == [(decode.MOST_BYTES + 1, True, 300)]
    grown = {pid: status(pid, "VmHWM:") - before.get(pid, 0) for pid in workers(me)}
    assert grown and max(grown.values()) < 200_000  # kB


def test_unpacking_is_by_rows(spark):
    """Neither Arrow nor pandas, and nulls and bytes that are no text stay what they were."""
    df = spark.createDataFrame([(1, None), (2, bytearray(b"\xff\xe2\x82a\0")), (3, bytearray(gzip.compress("é".encode())))], "id long, b binary").withColumn("u", decode.gunzipped(F.col("b")))
    assert "Arrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r.u) for r in df.orderBy("id").collect()] == [(None, None), ("��a\0", 5), ("é", 2)]
