"""The stored term index: refreshes, crashes, and search that skips blocks against plain BM25."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest

from lectern.operators import retrieval, term_index
from lectern.operators.term_index import TermIndex
from lectern.sources.versions import CommitConflict, Versions, state_of

WORDS = [f"reef{chr(97 + i % 26)}{i}" for i in range(300)]


def corpus(seed, n):
    r = random.Random(seed)
    rows = [(f"k{i}", f"title {r.choice(WORDS)}", " ".join(r.choices(WORDS, weights=[1 / (j + 1) for j in range(300)], k=r.randint(0, 80)))) for i in range(n)]
    return [*rows, ("none", None, None), ("stop", "the of", "a an")]


def table(spark, rows):
    return spark.createDataFrame(rows, "citekey string, title string, text string").repartition(3)


def plain(rows, queries, k):
    """BM25 item by item."""
    stop = {"a", "an", "the", "of", "on", "in", "for", "and", "to", "with", "is", "are", "be", "this", "that", "as", "by", "from", "at"}
    tokens = {c: [w for w in f"{t or ''} {x or ''}".lower().split() if len(w) > 2 and w not in stop] for c, t, x in rows}
    mean, n = sum(map(len, tokens.values())) / len(tokens), len(tokens)
    df = Counter(w for t in tokens.values() for w in set(t))
    out = []
    for q, text in queries:
        scores = {}
        for c, t in tokens.items():
            tf = Counter(t)
            s = sum(math.log((n - df[w] + 0.5) / (df[w] + 0.5) + 1) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / mean)) for w in set(text.split()) if tf[w])
            if s > 0:
                scores[c] = round(s, 6)
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, c, pytest.approx(s, abs=2e-6), i + 1) for i, (c, s) in enumerate(ranked)]
    return sorted(out, key=lambda x: (x[0], x[3]))


def found(index, spark, queries, k):
    rows = index.search(spark.createDataFrame(queries, "query_id int, query string"), k).collect()
    return sorted(((r["query_id"], r["citekey"], r["score"], r["rank"]) for r in rows), key=lambda x: (x[0], x[3]))


QUERIES = [(1, f"{WORDS[0]} {WORDS[250]}"), (2, " ".join(WORDS[::7])), (3, "nowhere"), (4, WORDS[120])]


def test_only_changed_items_are_tokenised(spark, tmp_path):
    index, rows = TermIndex(spark, str(tmp_path / "i"), buckets=3), corpus(1, 400)
    first = index.refresh(table(spark, rows), "one")
    assert first["tokenised"] == len(rows) == first["n"] and found(index, spark, QUERIES, 9) == plain(rows, QUERIES, 9)
    assert index.refresh(table(spark, rows), "one")["tokenised"] == 0
    assert index.refresh(table(spark, rows), "two") | {"source": "two"} == index.current() | {"tokenised": 0}
    rows = [*rows[5:20], *[(c, t, f"{x} {WORDS[250]}") for c, t, x in rows[20:27]], *rows[27:], ("new", "reefa0", WORDS[250])]
    second = index.refresh(table(spark, rows), "three")
    assert (second["tokenised"], second["n"], len(second["segments"])) == (8, len(rows), 2)
    assert found(index, spark, QUERIES, 9) == plain(rows, QUERIES, 9)
    terms = {r["term"]: (r["df"], r["cf"]) for r in index.terms(second).collect()}
    want = Counter(w for _, t, x in rows for w in f"{t or ''} {x or ''}".split() if w not in ("the", "of", "a", "an"))
    assert {w: cf for w, (_, cf) in terms.items()} == want


def test_segments_are_merged(spark, tmp_path):
    index, rows = TermIndex(spark, str(tmp_path / "i"), buckets=2, most_segments=2), corpus(2, 60)
    for k in range(3):
        rows = [*rows[:-2], (f"more{k}", "t", f"{WORDS[1]} {WORDS[2]}"), *rows[-2:]]
        now = index.refresh(table(spark, rows), str(k))
    assert len(now["segments"]) == 1 and not now["segments"][0]["n_dead"]
    assert found(index, spark, QUERIES, 5) == plain(rows, QUERIES, 5)


def test_blocks_are_skipped(spark, tmp_path):
    """A rare word beside a common one: most of the common one's blocks can't matter."""
    rows = [(f"k{i:04d}", "t", " ".join(["reef"] * (1 + i % 3) + ["sand"] * (i % 90 + 5) + ["kelp"] * 5 * (i < 12))) for i in range(3000)]
    index = TermIndex(spark, str(tmp_path / "i"), buckets=1)
    now = index.refresh(table(spark, rows))
    blocks = index.needed(now, spark.createDataFrame([(1, "kelp reef")], "query_id int, query string"), 10)[0].collect()
    assert sum(len(r["citekeys"]) for r in blocks) == 3012 and sum(r["read"] for r in blocks) == 1
    assert max(len(r["citekeys"]) for r in blocks) == 128
    assert found(index, spark, [(1, "kelp reef")], 10) == plain(rows, [(1, "kelp reef")], 10)


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    index, rows = TermIndex(spark, str(tmp_path / "i"), buckets=2), corpus(3, 40)
    index.refresh(table(spark, rows))
    before = found(index, spark, QUERIES, 5)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(Versions, "commit", dies)
    with pytest.raises(KeyboardInterrupt):
        index.refresh(table(spark, rows[10:]))
    monkeypatch.undo()
    assert index.current()["version"] == 1 and found(index, spark, QUERIES, 5) == before
    assert index.refresh(table(spark, rows[10:]))["tokenised"] == 0
    assert found(index, spark, QUERIES, 5) == plain(rows[10:], QUERIES, 5)
    assert index.versions.vacuum(keep=1, age_s=0) and found(index, spark, QUERIES, 5) == plain(rows[10:], QUERIES, 5)


def test_two_writers(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "t"))
    assert v.current() is None and v.commit({"x": 1}, 0) == 1
    with pytest.raises(CommitConflict):
        v.commit({"x": 2}, 0)
    assert v.commit({"x": 3}, 1) == 2 and v.current() == {"x": 3, "version": 2}


def test_no_items_and_the_state_of_files(spark, tmp_path):
    index = TermIndex(spark, str(tmp_path / "i"))
    now = index.refresh(table(spark, corpus(1, 5)).limit(0))
    assert (now["n"], now["segments"]) == (0, []) and found(index, spark, QUERIES, 5) == []
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("1")
    one = state_of(spark, str(tmp_path / "a"))
    assert state_of(spark, str(tmp_path / "a")) == one
    (tmp_path / "a" / "x").write_text("12")
    assert state_of(spark, str(tmp_path / "a")) != one
    assert retrieval.K1 == 1.5


def test_scores_by_slice_are_those_by_skipping(spark, tmp_path, monkeypatch):
    """Many queries over several slices and segments, with dead items, equal texts and a key that comes back."""
    monkeypatch.setattr(term_index, "SLICE_ITEMS", 50)
    monkeypatch.setattr(term_index, "GROUP_QUERIES", 7)
    rows = corpus(4, 260)
    rows += [(f"same{i:02d}", "t", f"{WORDS[0]} {WORDS[250]}") for i in range(40)]
    index = TermIndex(spark, str(tmp_path / "i"), buckets=3, most_skipping=0)
    index.refresh(table(spark, rows))
    rows = [*rows[30:], *[(c, t, f"{x} {WORDS[3]}") for c, t, x in rows[:25]]]
    now = index.refresh(table(spark, rows))
    assert len(now["segments"]) == 2 and now["segments"][0]["n_dead"] == 30
    r = random.Random(8)
    queries = QUERIES + [(10 + i, " ".join(r.choices(WORDS, k=r.randint(1, 20)))) for i in range(40)]
    got = found(index, spark, queries, 6)
    assert got == plain(rows, queries, 6)
    index.most_skipping = 1 << 60
    assert [(a, b, d) for a, b, _, d in found(index, spark, queries, 6)] == [(a, b, d) for a, b, _, d in got]


def test_a_slice_passes_on_its_best_alone(spark, tmp_path):
    """One common word in every query: the rows that are scored follow the items and queries, not their product."""
    rows = [(f"k{i:04d}", "t", " ".join(["reef"] * (1 + i % 3) + ["sand"] * (i % 90 + 5))) for i in range(1500)]
    index = TermIndex(spark, str(tmp_path / "i"), buckets=1, most_skipping=0)
    index.refresh(table(spark, rows))
    queries = spark.createDataFrame([(i, f"reef w{i}") for i in range(300)], "query_id int, query string")
    assert index.scores(queries, 5).count() < 300 * 40
    assert found(index, spark, [(1, "reef")], 5) == plain(rows, [(1, "reef")], 5)


def test_long_texts_are_counted_in_small_batches(spark):
    sizes = [3, 0, 5, 400, 1, 0, 90, 90]
    rows = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(8)]), pa.array(["f"] * 8), pa.array([[f"w{j % 7}" for j in range(n)] for n in sizes], pa.list_(pa.string()))], names=["citekey", "fingerprint", "tokens"])
    for most, batches in ((100, 4), (1 << 18, 1)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(term_index, "COUNT_TOKENS", most)
            out = list(term_index._counted([rows.slice(0, 8)]))
        assert len(out) == batches
        got = [r for b in out for r in b.to_pylist()]
        assert [r["length"] for r in got] == sizes
        assert [dict(zip(r["terms"], r["tfs"])) for r in got] == [dict(Counter(f"w{j % 7}" for j in range(n))) for n in sizes]


def test_texts_are_fetched_where_they_lie(spark):
    """Few hits go to the texts, so no text is shuffled; many give the same snippets."""
    items = table(spark, [(f"k{i}", "t", f"{'dune ' * 200}reef{i} {'sand ' * 200}") for i in range(50)])
    queries = spark.createDataFrame([(1, "reef7"), (2, "reef9")], "query_id int, query string")
    hits = spark.createDataFrame([(1, "k7", 1.0, 1), (2, "k9", 1.0, 1), (2, "k7", 0.5, 2)], "query_id int, citekey string, score double, rank int")
    few, many = (retrieval.snippets(hits, items, queries, most_broadcast=n) for n in (10, 0))
    assert sorted(few.collect()) == sorted(many.collect()) and few.count() == 3
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
