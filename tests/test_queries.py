"""Every registered query of the library against DuckDB, on whole tables."""

import glob
from pathlib import Path

import duckdb
import numpy as np
import pytest

from lectern.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {Path(p).stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    r = duck.execute(registry.SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    assert got == sorted(repr(tuple(dict(zip(names, x))[c] for c in cols)) for x in r.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL) - {"topic_model", "density_topics"}))
def test_snippets(spark, name):
    rows = registry.QUERIES[name](spark, SF).collect()
    assert rows and all(r["snippet"] for r in rows)


def test_topics_against_plain_k_means(spark, duck):
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    centres = x[:8].copy()
    for k in range(10):
        near = np.round(((x[:, None] - centres) ** 2).sum(2), 9).argmin(1)
        if k < 9:
            centres = np.array([x[near == j].mean(0) if (near == j).any() else centres[j] for j in range(8)])
    want = {int(ids[j]): int((near == j).sum()) for j in range(8) if (near == j).any()}
    assert {r["topic"]: r["n"] for r in registry.QUERIES["topic_model"](spark, SF).collect()} == want
