"""Queries on ranked hits, their scores added up by slice, against DuckDB."""

import glob
from functools import partial
from pathlib import Path

import duckdb
import pytest

from lectern.operators.term_index import TermIndex
from lectern.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["bm25_batch_topk", "coverage_gaps", "drift_candidates", "drift_reconsider"])
def test_same_rows_by_slice(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "TermIndex", partial(TermIndex, most_skipping=0))
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {Path(p).stem} AS SELECT * FROM '{p}'")
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    r = c.execute(registry.SQL[name])
    names = [x[0] for x in r.description]
    want = sorted(repr(tuple(dict(zip(names, x))[k] for k in cols)) for x in r.fetchall())
    assert sorted(repr(tuple(x[k] for k in cols)) for x in df.collect()) == want
