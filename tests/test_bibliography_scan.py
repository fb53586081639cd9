"""Bibliographies of any size: the same entries, however the file is split; lookup of single entries."""

import random

import pytest

from lectern.sources import bibliography


def library(n):
    r, out = random.Random(3), ["% a preamble\n", "more before any entry\n"]
    for i in range(n):
        out.append(f"@article{{key{i},\n  title = {{On {{r}}eefs {i}}},\n  author = {{Reef, Kelp}},\n  note = {{{'x' * r.randint(0, 200)}\n  second line}}\n}}\n" + "\n" * (i % 3))
        if i % 9 == 0:
            out.append("@comment{nothing @here\n@string{jan = 1}\n")
    out.insert(40, "@book{long,\n  title = {" + "\n".join(f"line {j} of one entry" for j in range(400)) + "}\n}\n")
    out.append("@misc{open, title = {never closed")
    return "".join(out)


def rows_of(df):
    return sorted((r["citekey"] or "", r["item_type"] or "", tuple(sorted((r["fields"] or {}).items()))) for r in df.collect())


@pytest.mark.parametrize("split", [700, 3_000, None])
def test_the_same_entries_in_any_splits(spark, tmp_path, split):
    """Some splits hold no entry's start: the long entry spans them."""
    text = library(120)
    (tmp_path / "lib.bib").write_text(text)
    (tmp_path / "two.bib").write_text("@misc{only, title = {x}}")
    raw = bibliography.scan_files(spark, str(tmp_path / "*.bib"), split)
    want = bibliography.entries(spark.createDataFrame([("lib", text), ("two", "@misc{only, title = {x}}")], "path string, text string"))
    assert rows_of(bibliography.parsed(raw)) == rows_of(want)
    order = [r["citekey"] for r in bibliography.parsed(raw.where("path like '%lib.bib'")).orderBy("n").collect() if r["citekey"]]
    assert order == [r["citekey"] for r in want.where("path = 'lib'").orderBy("n").collect() if r["citekey"]]
    if split == 700:
        assert raw.where("path like '%lib.bib'").selectExpr("max(n) > 5000").first()[0]


def test_lookup(spark):
    text = "@article{a1, title={x {y} z},\n year=1}\ntrailing\n@book(b, title={(})\n@misc{a1, title={later}}\n@misc{open, title={"
    raw = bibliography.raw_entries(spark.createDataFrame([("f", text)], "path string, text string"))
    ask = lambda *keys: {r["citekey"]: r["source"] for r in bibliography.lookup(raw, spark.createDataFrame([(k,) for k in keys], "citekey string")).collect()}
    assert ask("a1", "b", "open") == {"a1": "@article{a1, title={x {y} z},\n year=1}", "b": "@book(b, title={(})", "open": "@misc{open, title={"}
    assert ask("nokey", "b") == {"nokey": "", "b": "@book(b, title={(})"}
