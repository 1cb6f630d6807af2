"""The first N rows: against a plain sort, and what the jobs move."""

import json
import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators.selection import first_rows

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
MOVED = """
import sys
from pyspark.sql import SparkSession, functions as F
from tillroll.operators.selection import first_rows
spark = (SparkSession.builder.master("local[2]").config("spark.eventLog.enabled", "true").config("spark.ui.enabled", "false")
         .config("spark.eventLog.dir", sys.argv[1]).config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
df = spark.read.parquet(sys.argv[2])
got = first_rows(df, 3000, ["d", "c"], edge_rows=1000, sample_rows=500)
assert got.count() == 3000, got.count()
assert got.agg(F.max("n")).first()[0] == 2999
spark.stop()
"""


def key(t):
    return [(v is not None, v) for v in t]


@pytest.mark.parametrize("n", [1, 60, 700, 1499, 1500, 2000])
def test_equals_a_plain_sort(spark, n):
    rng = random.Random(n)
    rows = [(None if rng.random() < 0.05 else f"d{rng.randint(0, 40):02d}", rng.choice([None, 1, 2, 3, 4, 5, 99]), i)
            for i in range(1500)]
    df = spark.createDataFrame(rows, "d string, c int, other int").repartition(5)
    got = [(r["d"], r["c"], r["other"]) for r in first_rows(df, n, ["d", "c"], edge_rows=20, sample_rows=60).collect()]
    want = sorted(((d, c) for d, c, _ in rows), key=key)[:n]
    assert sorted(((d, c) for d, c, _ in got), key=key) == want
    assert not Counter(got) - Counter(rows)  # rows as they are, none twice


def test_one_key_only_and_edges(spark):
    same = spark.createDataFrame([("a", i) for i in range(300)], "d string, n int")
    assert first_rows(same, 120, ["d"], edge_rows=10, sample_rows=50).count() == 120
    assert first_rows(same, 0, ["d"]).count() == 0 and first_rows(same, 300, ["d"]).count() == 300
    none = same.withColumn("d", F.lit(None).cast("string"))
    assert first_rows(none, 7, ["d"], edge_rows=10, sample_rows=50).count() == 7
    assert first_rows(same.filter("false"), 5, ["d"]).count() == 0


def test_only_a_range_is_shuffled(spark, tmp_path):
    """100,000 rows, the first 3,000: the shuffles hold samples, counts and
    one range, and nothing is written."""
    data, log = f"{tmp_path}/rows", tmp_path / "log"
    log.mkdir()
    (spark.range(100_000, numPartitions=4).select(F.format_string("d%03d", (F.col("id") / 500).cast("int")).alias("d"),
                                                  (F.col("id") % 500).alias("c"), F.col("id").alias("n"))
     .orderBy(F.xxhash64("n")).write.parquet(f"file://{data}"))
    env = {**os.environ, "PYTHONPATH": TOP}
    run = subprocess.run([sys.executable, "-c", MOVED, f"file://{log}", f"file://{data}"], env=env, capture_output=True,
                         text=True)
    assert run.returncode == 0, run.stderr[-2000:]
    moved = written = 0
    for name in os.listdir(log):
        for line in open(log / name):
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                metrics = event["Task Metrics"]
                moved += metrics["Shuffle Write Metrics"]["Shuffle Records Written"]
                written += metrics["Output Metrics"]["Records Written"]
    assert moved < 3000 + 1000 + 4 * 500 and written == 0
