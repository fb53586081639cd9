"""Runs that citing paragraphs share with the cited source, against a plain search."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.operators import overlap, writing


def words(text):
    return re.findall("[a-z0-9]+", text.lower())


def plain(paragraphs, sources, n, most):
    first = {}
    for citekey, page, text in sources:
        w = words(text)
        for i in range(len(w) - n + 1):
            at = (citekey, *w[i : i + n])
            first[at] = min(first.get(at, page), page)
    found = {}
    for draft, citekey, ord_, text in paragraphs:
        w, open_ = words(text), None
        for i in range(len(w) - n + 2):
            page = first.get((citekey, *w[i : i + n])) if i <= len(w) - n else None
            if page is not None:
                open_ = open_ or [i, page, 0]
                open_[2] += 1
            elif open_:
                found.setdefault(draft, []).append((open_[2] + n - 1, open_[1], citekey, ord_, open_[0]))
                open_ = None
    return sorted((d, c, o, s, k, p, r + 1) for d, runs in found.items() for r, (k, p, c, o, s) in enumerate(sorted(runs, reverse=True)[:most]))


@pytest.mark.parametrize(("n", "most", "part_bytes"), [(8, 25, 16 << 20), (3, 4, 200), (5, 100, 1), (1, 3, 500)])
def test_runs_against_a_plain_search(spark, n, most, part_bytes):
    """One source that most paragraphs cite, pages without grams, sources nobody cites, paragraphs without a source."""
    r = random.Random(n)
    vocabulary = [f"w{i}" for i in range(6)]
    sources = [(f"k{s}", page, " ".join(r.choices(vocabulary, k=r.choice([0, 2, 9, 30])))) for s in range(12) for page in range(1, 6)]
    own = {}
    for c, _, t in sources:
        own[c] = f"{own.get(c, '')}, {t}"
    paragraphs = []
    for draft in range(60):
        for o in range(2):
            citekey = "k0" if draft % 3 else f"k{r.randrange(14)}"
            text = own.get(citekey, "w1 w2 w3")
            at = r.randrange(max(1, len(text) - 80))
            paragraphs.append((draft, citekey, o, f"{text[at : at + 80]} Zebra {' '.join(r.choices(vocabulary, k=12))} @{citekey}"))
    paragraphs += [(70, "k1", 0, ""), (71, None, 0, "w1 w2 w3 w4 w5 w6 w7 w8 w9")]
    a = spark.createDataFrame(paragraphs, "draft_id long, citekey string, ord int, paragraph string").repartition(3)
    b = spark.createDataFrame([*sources, (None, 1, "w1 w2 w3 w4 w5 w6 w7 w8 w9")], "citekey string, page int, text string").repartition(2)
    got = overlap.citing_overlaps(a, b, n, most, part_bytes)
    rows = sorted((x["draft_id"], x["citekey"], x["ord"], x["start"], x["n_words"], x["page"], x["rank"]) for x in got.collect())
    assert rows == plain([p for p in paragraphs if p[1]], sources, n, most) and rows


def test_no_row_for_an_n_gram(spark):
    """Texts go to the tasks as words, each once: n-grams of text would be many times as much."""
    a = spark.createDataFrame([(1, "k1", 0, "a b c d e f g h i")], "draft_id long, citekey string, ord int, paragraph string")
    b = spark.createDataFrame([("k1", 3, "x a b c d e f g h i y")], "citekey string, page int, text string")
    got = overlap.citing_overlaps(a, b)
    assert [tuple(r) for r in got.collect()] == [(1, "k1", 0, 0, 9, 3, 1)]
    assert "posexplode" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_keep_groups_whole():
    """Groups larger than a chunk, and groups that lie in several batches."""
    rows = [(f"k{g}", g % 2, page, None if page else 10 * g, None if page else 0, " ".join(f"g{g}x{i}" for i in range(page or 0, 30))) for g in range(6) for page in (1, 4, None)]
    schema = pa.schema([("citekey", pa.string()), ("part", pa.int64()), ("page", pa.int32()), ("draft_id", pa.int64()), ("ord", pa.int32()), ("words", pa.string())])
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
    for size in (1, 2, 5, 100):
        for most in (1, 300, 1 << 20):
            got = [r for b in overlap._runs_by_source(8, most)(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
            assert [(r["draft_id"], r["start"], r["n_words"], r["page"]) for r in got] == [(10 * g, 1, 29, 1) for g in range(6)]


def test_keys_beside_the_text(spark):
    """The same paragraphs, whether keys come as a table or with the drafts."""
    texts = [(1, "one @a\n\ntwo @b @a\n \nthree"), (2, None), (3, "@b")]
    drafts = spark.createDataFrame(texts, "draft_id long, text string")
    keys = spark.createDataFrame([(d, k) for d, _ in texts for k in ("@a", "@b", "@c")], "draft_id long, citekey string")
    beside = drafts.withColumn("citekeys", F.array(*(F.lit(k) for k in ("@a", "@b", "@a", "@c"))))
    want, got = (sorted(map(tuple, rows.collect())) for rows in (writing.paragraphs_naming(drafts, keys), writing.paragraphs_naming(beside)))
    assert got == want and len(got) == 4
    assert "Join" not in writing.paragraphs_naming(beside)._jdf.queryExecution().optimizedPlan().toString()
