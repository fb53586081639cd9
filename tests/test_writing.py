"""Structure of drafts, references, bibliographies, dossiers, runs: small cases and plain Python beside them."""

import random
import re
import statistics

import pytest

from lectern.operators import dossier, ledger, references, retrieval, runs, writing
from lectern.sources import bibliography, passages


def drafts(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "draft_id int, text string")


def test_blocks_and_paragraphs_of_odd_texts(spark):
    r = random.Random(1)
    parts = ["", " ", "plain words", "- item", "| a | b |", "# Head", r"\item x", r"a & b \\", "1) one", "\t"]
    texts = ["\n".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(40)] + [None, ""]
    rows = writing.draft_lines(drafts(spark, *texts))
    got = sorted((x["draft_id"], x["start"], x["stop"]) for x in writing.paragraph_spans(rows).collect())
    want = []
    for d, t in enumerate(texts):
        own = (t or "").split("\n")
        full = [i + 1 for i, x in enumerate(own) if x.strip()]
        for i in full:
            if want and want[-1][0] == d and want[-1][2] == i - 1:
                want[-1] = (d, want[-1][1], i)
            else:
                want.append((d, i, i))
    assert got == sorted(want)
    spans = writing.blocks(rows).collect()
    covered = sorted((x["draft_id"], i) for x in spans for i in range(x["start"], x["stop"] + 1))
    assert covered == sorted((d, i) for d, a, b in want for i in range(a, b + 1))


def test_claims_of_prose_lists_and_tables(spark):
    text = "A first point. A second one @reef1 spans\ntwo lines! Third.\n\n* item [@moss2]\n* other\n\n| x | tide \\| y [@kelp3] |\n\n\\section{On tides @fern4}\nAfter it."
    got = {r["citekey"]: (r["line"], r["claim"]) for r in writing.claims(drafts(spark, text, None, "")).collect()}
    assert got == {"reef1": (1, "A second one @reef1 spans two lines!"), "moss2": (4, "item"), "kelp3": (7, "x -- tide \\| y"), "fern4": (9, "On tides @fern4")}


def test_outline_skips_code_and_balances_braces(spark):
    text = "# One #\n```\n# no\n```\n\\begin{minted}{x}\n# no\n\\end{minted}\n\\subsection{A {b} \\{c}\\label{d}\n\\chapter{open\n### Three\nend"
    got = [(r["title"], r["level"], r["start"], r["stop"]) for r in writing.headings(drafts(spark, text)).orderBy("start").collect()]
    assert got == [("One", 1, 1, 7), ("A {b} \\{c", 3, 8, 8), ("open", 1, 9, 9), ("Three", 3, 10, 11)]


@pytest.mark.parametrize(
    ("field", "names"),
    [
        ("Reef, Kelp Moss and Tide Fern", "K. M. Reef and T. Fern"),
        ("{The Kelp Group}", "The Kelp Group"),
        ("Cher", "Cher"),
        ("A One and B Two and C Three", "A. One, B. Two, and C. Three"),
        (" and ".join(f"N{i} L{i}" for i in range(7)), "N. L0 et al."),
        ("Reef, Jean-Paul", "J.-P. Reef"),
        ("", ""),
    ],
)
def test_ieee_authors(field, names):
    assert references.ieee_authors(field) == names


def test_entries_degrade(spark):
    rows = [("k1", "A_b.", "2001", {"booktitle": "P", "author": "X Y", "pages": "3"}), ("k2", None, None, {}), ("k3", "T", "n.d.", {"editor": "E F", "school": "", "publisher": "Q"})]
    out = spark.createDataFrame(rows, "citekey string, title string, year string, fields map<string,string>")
    got = [r["entry"] for r in references.entries(out).orderBy("citekey").collect()]
    assert got == ['X. Y, "A\\_b," in *P*, p. 3, 2001.', "k2.", "E. F, Eds., *T*, Q, n.d."]


def test_renumbering_leaves_code_and_unknown_keys():
    numbers = {"a": 1, "b": 2, "c": 3, "d": 9}
    assert references.renumbered_text("[@a; @c; @b] [@a; @zz] see [p @d] `@a` x@a -@b", numbers) == "[1]–[3] [@a; @zz] see [p [9]] `@a` x@a [2]"


def test_bibliography_reader(spark):
    text = '@comment{x}\n@book{k1, title = "A {"}q{"} b", year=1999, note = {a\n {b} c}}\n@misc{k2, title={open}\n@misc(k3, file={:C:\\x.pdf:application/pdf})\n@misc{a/b, title={x}}\n'
    files = spark.createDataFrame([("f", text), ("g", None), ("h", "no entries")], "path string, text string")
    parsed = bibliography.entries(files)
    rows = {r["citekey"]: r["fields"] for r in parsed.collect()}
    assert rows["k1"] == {"title": 'A {"}q{"} b', "year": "1999", "note": "a {b} c"} and None in rows and "k2" not in rows
    assert [tuple(r) for r in bibliography.dropped(parsed).collect()] == [("f", 4, 1)]
    lib = {r["citekey"]: (r["pdf_path"], r["pdf_resolution"]) for r in bibliography.library(parsed, spark.createDataFrame([("C:\\x.pdf",)], "path string")).collect()}
    assert lib == {"k1": (None, "no_file_field"), "k3": ("C:\\x.pdf", "resolved")}


def test_sidecars_of_odd_shapes(spark):
    rows = [("a", "["), ("b", None), ("c", "{}"), ("d", "[]"), ("e", '[1, null, {"text": 5, "page": 2}, {"text": "x", "label": "A.Text", "page": "p"}]')]
    got = [tuple(r) for r in passages.sidecar(spark.createDataFrame(rows, "citekey string, json string")).select("citekey", "text", "page").orderBy("ord").collect()]
    assert got == [("e", "5", 2), ("e", "x", None)]


def test_upper_fence_against_exclusive_quantiles(spark):
    r = random.Random(2)
    groups = {f"g{n}": [r.randint(1, 30) for _ in range(n)] for n in (1, 3, 4, 5, 6, 7, 50)}
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v int")
    got = {x["g"]: x["fence"] for x in runs.upper_fence(rows, "g", "v").collect()}
    for g, vs in groups.items():
        if len(vs) < 4:
            assert got[g] == float("inf")
        else:
            q = statistics.quantiles(vs, n=4)
            assert abs(got[g] - (q[2] + 1.5 * (q[2] - q[0]))) < 1e-9


def test_index_refresh_equals_a_rebuild(spark):
    now = spark.createDataFrame([("a", "t", "kelp reef kelp"), ("b", "u", "moss"), ("c", "", "")], "citekey string, title string, text string")
    was = spark.createDataFrame([("a", "t", "kelp reef kelp"), ("b", "u", "old words"), ("z", "v", "gone")], "citekey string, title string, text string")
    fresh = retrieval.refresh_index(retrieval.term_index(was), retrieval.fingerprints(was), now)
    assert sorted(map(repr, map(tuple, fresh.collect()))) == sorted(map(repr, map(tuple, retrieval.term_index(now).collect())))
    assert {r["citekey"]: r["change"] for r in retrieval.index_changes(retrieval.fingerprints(was), now).collect()} == {"a": "kept", "b": "changed", "c": "new", "z": "gone"}


def test_postings_of_queries_score_as_the_whole_index(spark):
    items = spark.createDataFrame([("a", "t", "kelp reef kelp"), ("b", "u", "moss reef tide"), ("c", "", "")], "citekey string, title string, text string")
    queries = spark.createDataFrame([(1, "kelp reef"), (2, "nothing here"), (3, "tide tide")], "query_id int, query string")
    whole, few = (sorted(map(tuple, retrieval.bm25(i, queries).collect())) for i in (retrieval.term_index(items), retrieval.term_index(items, queries)))
    assert whole == few and len(whole) == 4 - 1


def test_evidence_and_missing_ledger_keys(spark):
    files = spark.createDataFrame([(1, "intro\n## plain head\nx\n\n## `a_1` y\nz"), (2, ""), (3, None)], "dossier int, text string")
    got = {(r["dossier"], r["citekey"]): r["block"] for r in dossier.evidence_blocks(files).collect()}
    assert got == {(1, "plain head"): "## plain head\nx\n", (1, "a_1"): "## `a_1` y\nz\n"}
    items = spark.createDataFrame([("a",), ("b",)], "citekey string")
    assert ledger.named(items, ["b"]).count() == 1
    with pytest.raises(Exception, match="x, y"):
        ledger.named(items, ["y", "a", "x"]).collect()


def test_sentences_follow_the_pattern():
    text = "See Fig. 3 for it. Then more! (Aside) ends. lower stays? [Yes] no."
    assert re.split(writing.SENTENCE_END, text) == ["See Fig. 3 for it.", "Then more!", "(Aside) ends. lower stays?", "[Yes] no."]
