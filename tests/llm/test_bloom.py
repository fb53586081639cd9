"""The Bloom filter comes to the driver packed, in runs of blocks."""

import numpy as np
import pytest
from pyspark.sql import DataFrame

from lectern.llm.url_filter import BlockedBloom, build_bloom


@pytest.mark.parametrize(("count", "part_blocks"), [(5_000, 100), (5_000, 1 << 17), (3, 7), (0, 7)])
def test_filter_in_runs_of_blocks(spark, monkeypatch, count, part_blocks):
    for name in ("toPandas", "toArrow", "collect"):  # all blocks at once would take twice the filter's size and more

        def whole(self, *_, name=name):
            raise AssertionError(f"{name} holds all blocks")

        monkeypatch.setattr(type(spark.range(0)), name, whole)
        monkeypatch.setattr(DataFrame, name, whole)
    keys = (np.arange(count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    rows = spark.createDataFrame([(int(k),) for k in keys], "m long").repartition(5)
    got = build_bloom(rows, "m", count, 12, part_blocks)
    want = np.zeros(max(1, count * 12 // 64), np.uint64)
    h = keys.view(np.uint64)
    np.bitwise_or.at(want, BlockedBloom.block(h, len(want)), BlockedBloom.bits(h))
    assert (got.words == want).all() and got.may_hold(keys).all()
    assert BlockedBloom(want).may_hold(np.arange(1, 100_000)).mean() < 0.2 or count < 5_000
