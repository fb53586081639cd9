"""The training-data operators against brute force, on texts that are null, empty, long, tied and repeated."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import common, decontaminate, graph, line_dedup, minhash, packing, quality, quality_rules, registry, substring, token_files, tokens, url_filter, warc

SPACE = "[^\x20\x09-\x0d]+"
SCHEMA = "doc_id long, text string, lang string, quality int, key string"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(r.choice(vocab) for _ in range(r.randint(20, 120))) for _ in range(30)]
    texts = [None, "", " \n\t", "One.", "one.", "Hé 🙂 naïve\x85\xa0x", base[0], base[0], base[1], base[1].replace(" ", "\n", 3)]
    for b in base[2:10]:
        w = b.split()
        w[r.randrange(len(w))] = "changed"
        texts += [b, " ".join(w), "intro words " + b[: len(b) // 2]]
    texts += base[10:] + [" ".join(base) * 3, "a b c d e " * 30]
    out = [(i, t, ["en", None, "de"][i % 3], 1, "x") for i, t in enumerate(texts)]
    return out + [out[6], (None, base[0], None, None, None), (6, base[12], "en", 1, "x")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_piece_encoder_equals_the_library():
    from tokenizers import Tokenizer

    whole, ours, r = Tokenizer.from_file(tokens.default_path()), tokens.PieceEncoder(tokens.default_path(), 2000), random.Random(1)
    parts = ["a", "the", "The,", " ", "  ", "\n", "\t", "é", "'s", "1", "!", "ab.", "\u2003", "\x1c", "\x00", "<|endoftext|>", "\xa0", "²", "x" * 300]
    for _ in range(3000):
        x = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert ours.encode([x])[0] == np.array(whole.encode(x, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000])
def test_elias_fano(n):
    v = np.sort(np.random.default_rng(n).integers(0, 1 << 40, n, dtype=np.uint64))
    ef = token_files.EliasFano(token_files.ef_encode(v, int(v[-1]) if n else 0))
    assert ef.all().tolist() == v.tolist() and [ef[i] for i in range(n)] == v.tolist()


def test_token_files_round_trip(spark, docs, rows, none):
    path = common.scratch_path(spark, "t")
    token_files.write_token_files(docs, path, shard_tokens=500)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    enc = tokens.encoder(tokens.default_path())
    want = sorted(((-1 if d is None else d), zlib.crc32(x := enc.encode([t or ""])[0] + b"\2\0\0\0"), len(x) // 4) for d, t, *_ in rows)
    assert sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["ids_crc32"], r["n_tokens"]) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()
    assert [(-1 if r["doc_id"] is None else r["doc_id"]) for r in got] == [w[0] for w in want]
    token_files.write_token_files(none, path + "0")
    assert token_files.read_token_files(spark, path + "0").count() == 0


def test_packing(docs, rows, none):
    got = packing.pack_documents(docs, 64).collect()
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        s.sort()
        assert [a for a, _ in s] == np.cumsum([0] + [n for _, n in s[:-1]]).tolist() and sum(n for _, n in s) <= 64
    enc = tokens.encoder(tokens.default_path())
    total = sum(len(enc.encode([t or ""])[0]) // 4 + 1 for _, t, *_ in rows)
    assert sum(r["length"] for r in got) == total and len(seqs) <= 1.1 * total / 64 + 2
    assert packing.pack_documents(none).count() == 0


def test_plan_uses_every_piece():
    r = random.Random(5)
    for _ in range(30):
        counts = {r.randint(1, 100): r.randint(1, 50) for _ in range(r.randint(1, 40))}
        plan = packing.plan_bins(counts, 100, groups=5)
        used = defaultdict(int)
        for lengths, n in plan.items():
            assert sum(lengths) <= 100
            for s in lengths:
                used[s] += n
        assert dict(used) == counts


@pytest.mark.parametrize("counts", [{150: 6000}, {s: 100 for s in range(130, 251)}, {s: 1 + s * s % 59 for s in range(129, 256)}, {150: 5000} | {s: 1 + s % 20 for s in range(1, 1025) if s != 150}])
def test_plan_needs_no_more_bins_than_best_fit(counts):
    plan, bins, gaps = packing.plan_bins(counts, 1024), 0, defaultdict(int)
    for s in sorted(counts, reverse=True):
        for _ in range(counts[s]):
            gap = min((g for g, n in gaps.items() if n and g >= s), default=1024)
            bins, gaps[gap] = bins + (not gaps[gap]), max(gaps[gap] - 1, 0)
            gaps[gap - s] += gap > s
    used = defaultdict(int)
    for lengths, n in plan.items():
        assert sum(lengths) <= 1024
        for s in lengths:
            used[s] += n
    assert dict(used) == counts and sum(plan.values()) <= bins


def ngrams(words, n):
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


def test_substrings(docs, rows, none):
    texts = {(d, t): re.findall(SPACE, t or "") for d, t, *_ in rows}
    first = {}
    for (d, _), w in texts.items():
        for g in ngrams(w, 13) if d is not None else ():
            first[g] = min(d, first.get(g, d))
    want = []
    for d, t, *_ in rows:
        w = texts[d, t]
        gone = {i + j for i, g in enumerate(ngrams(w, 13)) if d is not None and first[g] < d for j in range(13)}
        want.append((str(d), len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    for most in (64 << 20, 0):
        spans = substring.repeated_spans(docs.withColumn("key", common.text_key()), most_bytes=most)
        assert spans.count() > 5
    got = substring.drop_repeats(docs).collect()
    assert sorted((str(r["doc_id"]), r["_n_words"], r["_n_removed"], r["_kept_sha256"]) for r in got) == sorted(want)
    assert substring.drop_repeats(none).count() == 0


def check_near_duplicates(docs, rows, sketches, **more):
    def shingles(t):
        w = re.findall(SPACE, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(ngrams(w, 2)) if len(w) > 1 else frozenset([tuple(w)] if w else [])

    sets = [(d, shingles(t)) for d, t, *_ in rows]
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {g: min((d for (d, _), h in zip(sets, group) if h == g and d is not None), default=None) for g in group}
    want = [(str(d), len(s), str(low[g] if s else d), d == (low[g] if s else d)) for (d, s), g in zip(sets, group)]
    for k, least in sketches:
        got = minhash.near_duplicates(docs, k, least, **more).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == sorted(want)
    return len({g for g, (_, s) in zip(group, sets) if s})


def test_near_duplicates(docs, rows, none):
    check_near_duplicates(docs, rows, ((96, 52), (16, 8)))
    assert minhash.near_duplicates(none).count() == 0


def test_near_duplicates_away_from_pivots(spark):
    """Copies of one text that are linked in chains and in small groups, in several blocks."""
    r, rows = random.Random(8), []
    base = [f"v{i}" for i in range(90)]
    for i in range(60):
        w = list(base)
        for at in r.sample(range(90), i % 9):
            w[at] = f"new{at}" if i % 2 else f"own{i}"
        rows.append((i, " ".join(w)))
    for i in range(8):  # linked to the copy before it, and to none of the others
        w = rows[-1][1].split()
        for at in r.sample(range(90), 4):
            w[at] = f"chain{i}"
        rows.append((60 + i, " ".join(w)))
    for i in range(12):  # both sets fit a sketch, their union doesn't; 82 of 102 shingles in common
        w = [f"p{i}x{j}" for j in range(93)]
        v = [f"q{i}x{j}" if j % 18 == 9 else x for j, x in enumerate(w)]
        rows += [(100 + 2 * i, " ".join(w)), (101 + 2 * i, " ".join(v))]
    assert check_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rows, ((96, 52),), block=1000) > 3


def test_near_duplicates_stage_compares_five_words(spark):
    import corpus_pipeline

    r, rows = random.Random(12), []
    for i in range(12):
        w = [f"u{i}x{r.randrange(500)}" for _ in range(100)]
        rows.append((10 * i, " ".join(w)))
        for k, edits in enumerate((1, 2, 4, 5), 1):
            v = list(w)
            for at in range(edits):
                v[10 + 19 * at] = f"new{k}"
            rows.append((10 * i + k, " ".join(v)))
    texts = ["one two three four", "One two three four", "one two three", "four", "four", "", "", None, "one two three four five", "one two three four five"]
    rows += [(1000 + i, t) for i, t in enumerate(texts)]

    def shingles(t):
        w = (t or "").lower().split()
        return frozenset(ngrams(w, 5) if len(w) > 4 else [tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = {min(d for (d, _), h in zip(rows, group) if h == g) for g in group}
    assert len(want) > 18
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x["doc_id"] for x in corpus_pipeline.near(spark, docs, "").collect()} == want


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randint(200, 260), r.randint(200, 260)) for _ in range(50)]
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30))
    assert all(got[a] == got[b] for a, b in edges if a != b)


def test_lines(spark, none):
    line = "one two three four five six seven eight nine ten eleven twelve"
    texts = [line + "\nshort line\nother words that are not repeated anywhere else", "SHORT line\n" + line.upper() + "!", None, "", line, line.replace("three", "3rd") + "\nkeep this one line of plain words", line]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id line of seven plain words", "y")], "doc_id long, text string, lines string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs.drop("lines")).collect()}
    assert got[0]["_n_removed"] == 0 and got[1]["_text"] == "SHORT line" and got[2]["_text"] is None and got[3]["_text"] == "" and got[4]["_text"] == "" and got[6]["_n_removed"] == 1
    assert got[5]["_text"].endswith("keep this one line of plain words") and got[None]["_n_removed"] == 0
    assert line_dedup.dedup_lines(none).count() == 0


def kept_lines(texts, least_words, percent=80):
    """The kept lines of each text, by edit similarity of all pairs of lines."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    at = [(d, i, tuple(re.findall(r"[^\W_]+", x.lower()))) for d, t in enumerate(texts) for i, x in enumerate(t.split("\n"))]
    first = {}
    for d, i, w in at:
        first.setdefault(w, (d, i))
    words = [w for w in first if len(w) >= least_words]
    group = {w: w for w in words}
    for i, a in enumerate(words):
        for b in words[:i]:
            most = (100 - percent) * max(len(a), len(b)) // 100
            if abs(len(a) - len(b)) <= most and group[a] != group[b] and distance(a, b) <= most:
                old, new = group[a], group[b]
                group = {w: new if g == old else g for w, g in group.items()}
    keep = {}
    for w in words:
        keep[group[w]] = min(keep.get(group[w], first[w]), first[w])
    gone = {(d, i) for d, i, w in at if w in group and keep[group[w]] != (d, i)}
    return ["\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in enumerate(texts)]


def similar_lines():
    """Lines of 4 to 60 words and copies with edits up to the limit and beyond, dealt to texts."""
    r = random.Random(11)
    lines = []
    for n in [*range(4, 31), 45, 60] * 3:
        w = [f"v{r.randrange(900)}" for _ in range(n)]
        lines.append(" ".join(w))
        for most in (n // 5, n // 5, n // 4 + 1):
            v = list(w)
            for _ in range(most):
                k, at = r.randrange(3), r.randrange(len(v))
                v[at : at + (k > 0)] = [f"n{r.randrange(9000)}"] * (k < 2)
            lines.append(" ".join(v))
    lines += ["a b a b a b a b a b", "a b a b a b a b", "one two three four five", "one two four five", "one two 3rd four five", "one two 3rd four 5th"]
    r.shuffle(lines)
    return ["\n".join(lines[i : i + 5]) for i in range(0, len(lines), 5)]


def test_lines_against_all_pairs(spark):
    texts = similar_lines()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["_text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert [got[i] for i in range(len(texts))] == kept_lines(texts, 5)
    got = {r["doc_id"]: r["_text"] for r in line_dedup.dedup_lines(docs, similarity=0.7).collect()}
    assert [got[i] for i in range(len(texts))] == kept_lines(texts, 5, 70)


def test_query_and_stage_remove_short_lines(spark, tmp_path):
    import corpus_pipeline

    texts = ["all rights reserved\n\none", "All rights reserved!\n\ntwo words here now", "two words here\n--\nOne.", "two words here now\nlast\n--"] + similar_lines()
    want = kept_lines(texts, 1)
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.op2_line_dedup(spark, str(tmp_path)).collect()}
    assert [got[i] for i in range(len(texts))] == [hashlib.sha256(t.encode()).hexdigest() for t in want]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {i: t for i, t in enumerate(want) if re.search(r"\w", t)}


def test_word_edit_distance(spark):
    row = spark.createDataFrame([("a b c d", "a x c d e")], "x string, y string")
    words = [line_dedup.word_codes(F.split(c, " ")) for c in ("x", "y")]
    assert row.select(line_dedup.edit_distance(*words, 1024)).first()[0] == 2


def test_long_lines_with_a_shift(spark):
    words = [f"w{i}" for i in range(2000)]
    new = [f"n{i}" for i in range(501)]
    rows = [(" ".join(words), " ".join(new[:k] + words), k) for k in (0, 200, 500, 501)]
    pairs = spark.createDataFrame(rows, "x string, y string, k int")
    x, y = (line_dedup.word_codes(F.split(c, " ")) for c in ("x", "y"))
    got = {r["k"]: r["d"] for r in pairs.select("k", line_dedup.edit_distance(x, y, line_dedup.most_edits(F.size(F.split("y", " ")), 80)).alias("d")).collect()}
    assert got == {0: 0, 200: 200, 500: 500, 501: -1}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate((rows[1][0], rows[1][1]))], "doc_id long, text string")
    assert {r["doc_id"]: r["_n_removed"] for r in line_dedup.dedup_lines(docs).collect()} == {0: 0, 1: 1}


def test_rules(spark, docs, rows, none):
    got = {(r["doc_id"], r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) for r in quality_rules.measure(docs).collect()}
    for d, t, *_ in rows:
        w = re.findall(SPACE, t or "")
        g = ngrams(w, 5)
        lines = [x for x in (t or "").split("\n") if re.search(SPACE, x)]
        assert (d, len(w), len({i + j for i, x in enumerate(g) if g.count(x) > 1 for j in range(5)}), len(lines) - len(set(lines))) in got
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert quality_rules.apply_rules(docs, labels).count() == len(rows)
    assert quality_rules.apply_rules(none, labels.limit(0)).count() == 0


def test_binomial_bound(spark):
    from math import comb, log

    want = log(sum(comb(500, i) * 0.01**i * 0.99 ** (500 - i) for i in range(3)))
    row = spark.createDataFrame([(2, 500)], "k long, n long").select(quality_rules._log_binomial_cdf(F.col("k"), F.col("n"), 0.01)).first()
    assert abs(row[0] - want) < 1e-9


def test_urls(spark):
    urls = ["https://A.Example.ORG/es/x?y#z", "http://example.org/en/12", "http://notexample.org/es/", "ftp://org/", "http://x.com/de/1", "http://com/fr/", "x.com/de/1", "", None, "http://a.net", "http://x.com/de/1"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, extra string")
    rules = spark.createDataFrame(url_filter.OP6_RULES, "host string, path string, verdict string")
    for most in (64 << 20, 0):
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, rules, most).collect()}
        assert got[0] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[1][2:] == ("example.org/en/1", "block") and got[2][2:] == ("org/", "allow")
        assert got[3][2:] == ("org/", "allow") and got[4][3] == got[10][3] == "block" and got[5][3] == "allow" and got[6] == got[7] == got[8] == ("", "", None, "allow") and got[9] == ("a.net", "", None, "allow")
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_benchmark_items(spark, docs, none):
    items = [(1, " ".join(f"t{i}" for i in range(20))), (2, "just three words"), (3, None), (4, "..."), (None, "just three words"), (5, "t3 t4 t5")]
    items = spark.createDataFrame(items, "item_id long, text string")
    texts = ["x " + " ".join(f"T{i}," for i in range(3, 18)) + " y", "it is Just Three WORDS here", None, "", "t0 t1 t2"]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (4 << 20, 10):
        got = {r["doc_id"]: r for r in decontaminate.judge(decontaminate.mark(given, items, block_bytes=size)).collect()}
        assert (got[0]["n_hit"], got[0]["_items"]) == (15, ["1", "5"]) and (got[1]["n_hit"], got[1]["_items"]) == (3, ["2"])
        assert [got[i]["n_hit"] for i in (2, 3, 4)] == [0, 0, 0] and got[4]["n_words"] == 3 and got[0]["contaminated"] and not got[2]["contaminated"]
    clean = {r["doc_id"]: r["clean_text"] for r in decontaminate.decontaminate(given, items).collect()}
    assert clean[1] == "it is  here" and clean[2] is None and clean[4] == "t0 t1 t2"
    assert decontaminate.judge(decontaminate.mark(none, items.limit(0))).count() == 0


def test_classifier(spark, docs, rows):
    r = random.Random(4)
    good = ["Plain words that follow " + " ".join(r.choice(["river", "stone", "green"]) for _ in range(200)) for _ in range(60)]
    bad = ["$$$ ### %%% " * 60 + str(i) for i in range(60)]
    both = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    model = quality.fit_quality(both, labels)
    got = {x["doc_id"]: x["_score"] for x in quality.score_quality(both, model).collect()}
    assert min(got[i] for i in range(60)) > max(got[i] for i in range(60, 120))
    odd = [x["_score"] for x in quality.score_quality(docs, model).collect()]
    assert len(odd) == len(rows) and all(0 <= x <= 1 for x in odd)
    assert {x["_score"] for x in quality.score_quality(both, quality.fit_quality(both, labels.limit(0))).collect()} == {0.5}


def test_fixity(spark):
    pages = spark.createDataFrame([(i if i % 7 else None, f"http://x/{i}", "h" * (i * 50)) for i in range(600)] + [(3000, None, None)], "page_id long, url string, html string")
    left = common.materialize(warc.index(warc.archive(pages)), "l")
    assert warc.audit(left, left).count() == 0
    spoilt = left.withColumn("digest", F.when(F.col("key") == 11, F.lit("bad")).otherwise(F.col("digest"))).where("key is null or key <> 500")
    extra = spark.createDataFrame([(9, 99, "new", 5)], "segment long, offset long, digest string, length long")
    right = spoilt.select("segment", "offset", "digest", "length").unionByName(extra)
    assert sorted(r["status"] for r in warc.audit(left, right).collect()) == ["corrupt", "extra", "missing"]
    assert warc.audit(left.limit(0), left.limit(0)).count() == 0


def test_warc_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>é{i}\r\n\r\n</p>") for i in range(20)], "page_id long, url string, html string")
    warc.write_warc(warc.archive(pages), str(tmp_path / "w"))
    got = {(r["uri"], r["body"]) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    assert got == {(f"http://x/{i}", f"<p>é{i}\r\n\r\n</p>") for i in range(20)}


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows_as_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    r = c.execute(registry.SQL[name])
    assert [x[0] for x in r.description] == got.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, r.fetchall()))


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "sequence_id"} <= set(rows[0].asDict())
