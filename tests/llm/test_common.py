"""Helpers: what a cut leaves on the disks of executors, shared keys, dealt joins."""

import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from factloom.llm import common
from factloom.llm.common import dealt_join, shared_rows


def test_a_cut_leaves_no_shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(key, None)
    out = common.cut(rows)
    for _ in range(50):  # executors are told, not waited for
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key, None) == setting
    assert out.count() == rows.count() == out.join(rows, ["k", "s"]).count() == 7  # plans made before and after still run


def test_shared_rows_across_batches():
    rng = random.Random(1)
    for _ in range(1000):
        rows = sorted((rng.randint(0, 4), rng.randint(0, 3)) for _ in range(rng.randint(0, 12)))
        want = sorted(r for r in set(rows) if any(o[0] == r[0] and o != r for o in rows))
        size = rng.randint(1, 5)
        batches = [pa.RecordBatch.from_pydict({"h": [r[0] for r in rows[i : i + size]], "s": [r[1] for r in rows[i : i + size]]}) for i in range(0, len(rows), size)]
        assert [tuple(x.values()) for b in shared_rows(iter(batches)) for x in b.to_pylist()] == want


def test_dealt_join_changes_nothing(spark):
    rows = spark.range(6000).selectExpr("id", "if(id % 3 = 0, id % 50, 7) k")
    table = spark.range(40).selectExpr("id % 20 k", "id t")
    same = lambda df: sorted(tuple(r) for r in df.select("k", "id", "t").collect())
    assert same(dealt_join(rows, table, "k", rows.id, least=100)) == same(rows.join(table, "k"))
