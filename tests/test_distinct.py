from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cargolens.operators import distinct

ROWS = [(datetime(2024, 1, 30 + k % 2, k % 24), "ab"[k % 2], (k * 7919) % 90_000 - 100) for k in range(400)]
ROWS += [(datetime(2024, 2, 1, 3), "a", 5), (datetime(2024, 2, 1, 3), "a", 5), (datetime(2024, 2, 1, 3), "c", None), (None, "a", 32768), (None, None, 32769)]


@pytest.mark.parametrize("grain", ["hour", "day", "week", "month"])
def test_counts_of_merged_partials_are_distinct_counts(spark, grain):
    rows = spark.createDataFrame(ROWS, "time timestamp, kind string, id long")
    parts = [distinct.partials(rows.where(c), ["kind"], "time", F.col("id")) for c in ("id % 3 = 0 OR id IS NULL", "id % 3 <> 0", "id % 5 = 0")]
    stored = distinct.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["kind"])
    got = distinct.counts(stored, ["kind"], grain, "ids")
    want = rows.groupBy(F.date_trunc(grain, "time").alias("period"), "kind").agg(F.count_distinct("id").alias("ids"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_rows(spark):
    rows = spark.createDataFrame([], "time timestamp, kind string, id long")
    assert distinct.counts(distinct.partials(rows, ["kind"], "time", F.col("id")), ["kind"], "day", "ids").count() == 0
