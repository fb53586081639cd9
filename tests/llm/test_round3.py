"""Exact dedup, the manifest and the prefix trie against brute force: nulls, empty and long texts, ties, repeats, hot keys, clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import exact_dedup, manifest, prefix_trie, scan
from lectern.llm.common import scratch_path

LONG = "long words " * 300_000


@pytest.fixture(scope="module")
def rows():
    r = random.Random(7)
    texts = [None, "", " ", "a", "a", "A", LONG, LONG, "é🙂"] + [r.choice(["hot", f"t{r.randint(0, 60)}"]) for _ in range(900)]
    out = [(i * 3, t, ["en", None, "de", ""][i % 4], "s" if i % 5 else None, i if i % 6 else None) for i, t in enumerate(texts)]
    return out + [out[3], out[3], out[20], (None, "a", "en", None, 1), (None, "b", None, None, None), (None, "b", None, None, None), (30, "other", "en", "s", 2), (-70_000, "t1", "en", "x", 5), (1 << 40, "t1", None, "x", 5)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns named like those used inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("own") for c in ("digest", "row", "batch", "keep", "leaf", "key", "pos", "chunk", "salt", "image")}).repartition(5).cache()


def test_copies_against_a_dictionary(spark, docs, rows):
    signed = exact_dedup.sign(docs)
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"), 3)
    index.add(signed.where("doc_id > 300"))
    index.add(signed.where("doc_id <= 300 or doc_id is null"))
    got = Counter(tuple(r) for r in exact_dedup.verdicts(signed, index).collect())
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    want = Counter()
    for t, ids in groups.items():
        keep = max(ids, key=lambda d: (d is not None, d or 0))
        own = sorted(ids, key=lambda d: (d is not None, d or 0))
        for k, d in enumerate(own):
            want[(d, keep, len(ids), k == len(own) - 1, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert got == want


def test_the_index_stays_and_grows(spark, docs):
    path = scratch_path(spark, "index")
    first = exact_dedup.sign(docs.where("text <> 'hot'"))
    index = exact_dedup.DigestIndex(spark, path, 3)
    index.add(first)
    index.add(first)
    n = index.entries().count()
    assert n == docs.where("text <> 'hot'").select("text").distinct().count() == index.entries().select("digest").distinct().count()
    spark.sql(f"DROP TABLE {index.name}")  # as in another session: the files stay
    again = exact_dedup.DigestIndex(spark, path, 99)
    assert again.entries().count() == n
    fresh = again.fresh(exact_dedup.sign(docs.withColumn("doc_id", F.col("doc_id") + 10_000)))
    assert fresh.count() == 1  # hot; a null text equals the empty one
    again.add(exact_dedup.sign(docs))
    assert again.entries().count() == n + 1
    rows = exact_dedup.verdicts(exact_dedup.sign(docs.where("text = 'hot'")), again)
    assert rows.where("kept").count() == 0  # the indexed one stays
    plan = again.fresh(first)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1  # none on the index's side
    assert exact_dedup.verdicts(exact_dedup.sign(docs.limit(0)), again).isEmpty()


def plain_manifest(rows):
    h = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    f = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, t, lang, source, n):
        return h(f(d), f(source), f(lang), f(n), f(t))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    groups = defaultdict(list)
    for d, t, lang, source, n in rows:
        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        groups[lang].append(((d is not None, d or 0, leaf(d, t, lang, source, n)), d, leaf(d, t, lang, source, n), leaf(d, t, lang, source, n + 1) if hit else None))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([g[2] for g in sorted(groups[x])]) for x in names}
    high = levels([trees[x][-1][0] for x in names])
    out = Counter()
    for k, x in enumerate(names):
        for i, (_, d, own, bad) in enumerate(sorted(groups[x])):
            node, proof = bad or own, ""
            for tree, at in ((trees[x], i), (high, k)):
                for level in tree[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    node, proof, at = h(other, node) if at & 1 else h(node, other), proof + other, at >> 1
            out[(d, own, trees[x][-1][0], high[-1][0], h(proof), node, node == high[-1][0])] += 1
    return out


@pytest.mark.parametrize("many", [False, True])
def test_manifest_against_plain_trees(spark, docs, rows, many):
    """With many rows, trees of one group and over all groups take several rounds of blocks."""
    if many:
        rows = [(i * 5, f"t{i}", "en", None, i) for i in range(9000)] + [(i, "x", f"l{i}", "s", None) for i in range(4200)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = manifest.manifest(docs, F.when(hit & F.col("n_chars").isNotNull(), manifest.leaf(F.col("n_chars") + 1)))
    assert Counter(tuple(r) for r in got.collect()) == plain_manifest(rows)


def test_hot_ids_are_dealt_out(spark, monkeypatch):
    """A third of the rows share one id: their container is asked by several tasks."""
    monkeypatch.setattr(manifest, "HOT_ROWS", 50)
    rows = [(7 if i % 3 == 0 else i, f"t{i}", "en", None, 1) for i in range(600)] + [(None, f"n{i}", "en", None, 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = manifest.manifest(docs, F.lit(None).cast("string"))
    assert Counter(tuple(r) for r in got.collect()) == Counter({k[:5] + (k[3], True): n for k, n in plain_manifest(rows).items()})
    assert manifest.manifest(docs.limit(0), F.lit(None).cast("string")).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 5, 255, 256, 257, 3000, 4096])
def test_containers(n):
    low = np.sort(np.random.default_rng(n).permutation(4096)[:n])
    counts = np.random.default_rng(n).integers(1, 4, n)
    c = manifest.Container(manifest.Container.image(low, counts))
    assert [x.tolist() for x in c.numbers()] == [low.tolist(), counts.tolist()]
    rank, several = c.rank(low)
    assert rank.tolist() == (np.cumsum(counts) - counts).tolist() and several.tolist() == (counts > 1).tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 20_000])
def test_perfect_slots(n):
    a, b = np.random.default_rng(n).integers(0, 1 << 63, (2, n), dtype=np.uint64)
    slots = prefix_trie.PerfectSlots(a, b)
    assert sorted(slots(a, b).tolist()) == list(range(n))
    other = slots(b + np.uint64(1), a)
    assert ((other >= -1) & (other < max(n, 1))).all()


def test_slots_of_equal_keys():
    with pytest.raises(ValueError, match="twice"):
        prefix_trie.PerfectSlots(np.ones(2, np.uint64), np.ones(2, np.uint64))


def plain_trie(rows):
    words = lambda t: len([w for w in t.translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5)).split(" ") if w])
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    turns = {c: [t[2] for t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        whole[c] = turns.get(base, [])[:h] + t[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
        ends[tuple(t)].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in sorted(members.items(), key=lambda x: -len(x[0])):
        leaves[p] += not kids[p]
        saved[p] += (len(m) - 1) * (words(p[-1][1]) if p else 0)
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


@pytest.fixture(scope="module")
def talks():
    r, out = random.Random(5), []
    for c in [*range(60), -7, -20, 205, 1007]:
        out += [(c, t if r.random() < 0.9 else None, r.choice(["u", "a", None]), r.choice(["x y", "z", "", None, "w w\tw"])) for t in range(r.randint(1, 5))]
    out += [(77, t, "u", f"t{t}") for t in range(500)] + [(80, t, "u", f"t{t}") for t in range(490)]
    return out + [(None, 1, "u", "x"), (3, 0, "u", "x y"), (3, 0, "u", "x y"), (9, 1, "u", LONG)] + [(c, t, "u", f"s{t}") for c in range(300, 420) for t in range(3)]


@pytest.mark.parametrize(("shard_rows", "most_broadcast"), [(None, 100_000), (2, 100_000), (40, 3)])
def test_trie_against_plain_prefixes(spark, talks, shard_rows, most_broadcast):
    """Small shards leave most nodes above them, on chains of 500 turns; then top nodes are joined, not broadcast."""
    df = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("own") for c in ("a", "b", "digest", "words", "index", "depth", "length", "part")}).repartition(7)
    got = prefix_trie.prefix_trie(df, shard_rows, most_broadcast)
    assert Counter(tuple(r) for r in got.collect()) == plain_trie(talks)
    if shard_rows is None:
        assert prefix_trie.prefix_trie(df.limit(0)).isEmpty()


def test_running_places_over_many_shares(spark):
    """Groups that span several shares, and several batches."""
    r = random.Random(2)
    rows = [(r.choice([None, "hot", "hot", "hot", f"g{r.randint(0, 30)}"]), i, r.randint(0, 9), hashlib.sha256(str(i).encode()).digest()) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, i int, v long, d binary").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {x["i"]: (x["index"], x["before"], x["a"] % 2**64, x["pb"] % 2**64) for x in scan.running(df, "g", [F.col("i")], "v", "d").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    state, want = defaultdict(lambda: [0, 0, 0, 0]), {}
    for g, i, v, d in rows:
        s = state[g]
        term = [int.from_bytes(d[8 * k : 8 * k + 8], "little") * pow(scan.BASES[k], s[0], 2**64) % 2**64 for k in (0, 1)]
        want[i] = (s[0], s[1], (s[2] + term[0]) % 2**64, s[3])
        state[g] = [s[0] + 1, s[1] + v, (s[2] + term[0]) % 2**64, (s[3] + term[1]) % 2**64]
    assert got == want
