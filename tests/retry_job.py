"""Run by test_retry.py in its own JVM: local mode with task retries allowed."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from scanlake.sources.scanners import line_numbers, parse_lines, read_scan_lines  # noqa: E402
from scanlake.store import observations  # noqa: E402


def flaky(it):
    """Fail the first attempt of every other task, as a lost executor would."""
    from pyspark import TaskContext

    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 1:
        raise RuntimeError("simulated task loss")
    yield from it


def main():
    path, fail = sys.argv[1], sys.argv[2] == "fail"
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.files.maxPartitionBytes", "2048")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    lines = read_scan_lines(spark, path)
    obs = observations(parse_lines(lines, "generic")).select("seq", "ip", "port")
    numbered = line_numbers(lines).select("file_name", "line_no", "value")
    if fail:
        obs = obs.mapInPandas(flaky, obs.schema)
        numbered = numbered.mapInPandas(flaky, numbered.schema)
    a = sorted((r.seq.block_start, r.seq.row_id, r.ip, r.port) for r in obs.collect())
    b = sorted((r.line_no, r.value) for r in numbered.collect())
    print(json.dumps({"obs": a, "numbered": b}))


if __name__ == "__main__":
    main()
