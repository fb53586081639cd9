"""Groups of near copies make pairs and links in proportion to their size."""

import random

from lectern.llm import line_dedup, minhash


def counted(monkeypatch, module, *labels):
    """The rows of the tables that ``module`` writes under ``labels``, one number a table."""
    counts, write = [], module.materialize

    def watch(df, label):
        out = write(df, label)
        if label in labels:
            counts.append(out.count())
        return out

    monkeypatch.setattr(module, "materialize", watch)
    return counts


def test_links_of_lines(spark, monkeypatch):
    base = [f"w{i}" for i in range(24)]
    lines = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in range(24)] + [" ".join(base + [f"y{k}"]) for k in range(16)]
    links = counted(monkeypatch, line_dedup, "links")
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    gone = line_dedup.dedup_lines(docs, least_words=1).where("_n_removed > 0").count()
    assert gone == len(lines) - 1
    assert sum(links) <= 6 * len(lines)  # 780 pairs are similar


def test_pairs_of_texts(spark, monkeypatch):
    r = random.Random(2)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for k in range(160):
        w = list(base)
        for j in range(3):
            w[r.randrange(90)] = f"x{k}y{j}"
        texts.append(" ".join(w))
    pairs = counted(monkeypatch, minhash, "pairs")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = minhash.near_duplicates(docs).collect()
    sets = [{(a, b) for a, b in zip(t.split(), t.split()[1:], strict=False)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if x == old else x for x in root]
    assert {x["doc_id"]: x["component_id"] for x in out} == dict(enumerate(root))
    assert sum(pairs) <= 12 * len(texts)


def test_pairs_of_lines_with_a_passage(spark, monkeypatch):
    """Lines that share a passage, or a phrase and no other words, make pairs in proportion to their number."""
    r = random.Random(4)
    passage, words = [f"p{i}" for i in range(60)], [f"w{i}" for i in range(4000)]
    lines = [" ".join(r.sample(words, 20 + k % 4) + passage) for k in range(160)]
    lines += [" ".join(["q0 q1 q2 q3", *r.sample(words, 240)]) for k in range(160)]
    copies = [" ".join([*x.split()[:-3], "x", "y", "z"]) for x in lines[::20]]
    pairs = counted(monkeypatch, line_dedup, "pairs")
    docs = spark.createDataFrame(list(enumerate(lines + copies)), "doc_id long, text string")
    gone = sorted(x["doc_id"] for x in line_dedup.dedup_lines(docs, least_words=1).where("_n_removed > 0").collect())
    assert gone == list(range(len(lines), len(lines + copies)))
    assert sum(pairs) <= 20 * len(lines)  # 25,440 pairs share the passage or the phrase
