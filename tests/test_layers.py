"""Text ladders, reuse by file times, and the mapping between drafts and dossiers."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import dossier
from lectern.sources import layers


def test_best_text(spark):
    rows = [("a", "x\n![Image](y.png)\nz", "p", "f"), ("b", None, "p", "f"), ("c", None, None, "f"), ("d", None, None, None), ("e", "", "p", None)]
    got = {r["citekey"]: (r["source"], r["text"]) for r in layers.best_text(spark.createDataFrame(rows, "citekey string, layout string, parsed string, fresh string")).collect()}
    assert got == {"a": ("layout", "x\n\nz"), "b": ("parsed", "p"), "c": ("fresh", "f"), "d": (None, None), "e": ("layout", "")}


def test_page_source(spark):
    rows = [("a", "one\ftwo", "other"), ("b", None, "only"), ("c", None, None)]
    got = sorted((r["citekey"], r["source"], r["page"], r["text"]) for r in layers.page_source(spark.createDataFrame(rows, "citekey string, file_text string, parsed string")).collect())
    assert got == [("a", "file", 1, "one"), ("a", "file", 2, "two"), ("b", "parsed", 1, "only")]


def test_reuse(spark):
    rows = spark.createDataFrame([("new", 5, 5, 6), ("old", 5, 4, 6), ("bare", 5, 6, None), ("lost", None, 6, 6)], "citekey string, pdf_time long, text_time long, sidecar_time long")
    assert {r["citekey"] for r in layers.reusable(rows).where("reuse").collect()} == {"new"}
    assert layers.reusable(rows, images=True).where("reuse").isEmpty()
    assert spark.createDataFrame([("a\fb\n\n\n\nc",)], "t string").select(layers.taken_over("t")).first()[0] == "a\n\nb\n\nc"
    now = spark.createDataFrame([("a", 1, 2, True), ("b", 1, 3, True), ("c", 1, 2, False), ("d", None, 2, True), ("e", 1, 2, True)], "citekey string, size long, modified long, present boolean")
    stored = spark.createDataFrame([("a", 1, 2), ("b", 1, 2), ("c", 1, 2), ("d", None, 2)], "citekey string, size long, modified long")
    assert {r["citekey"] for r in layers.fits_cache(now, stored).where("hit").collect()} == {"a", "d"}


def test_drafts_and_dossiers_by_path(spark, tmp_path):
    root, other = tmp_path / "drafts", tmp_path / "dossiers"
    for path, text in {"a.md": "one", "sub/b.tex": "two", "sub/b.md": "three", "c.txt": "no draft", "v1.2.tex": "four"}.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_text(text)
    found = layers.drafts(spark, str(root))
    assert {r["name"]: r["text"] for r in found.collect()} == {"a": "one", "sub/b": "three", "v1.2": "four"}
    for path in ("a/evidence.md", "sub/b/rejected.md", "gone/scope.md", "a/notes.md"):
        (other / path).parent.mkdir(parents=True, exist_ok=True)
        (other / path).write_text("## x\n| a | b |")
    files = layers.dossier_files(spark, str(other), [*dossier.FILE_KINDS, "scope.md"])
    rows = layers.with_drafts(files, found).collect()
    assert {(r["dossier"], r["name"], (r["draft"] or "").rpartition("/")[2]) for r in rows} == {("a", "evidence.md", "a.md"), ("sub/b", "rejected.md", "b.md"), ("gone", "scope.md", "")}
    assert {(r["dossier"], r["kind"], r["entries"]) for r in dossier.file_counts(files).collect()} == {("a", "blocks", 1), ("sub/b", "rows", 0), ("gone", "prose", 1)}


@pytest.mark.parametrize("path", ["/elsewhere/a.md", "/root/drafts/../x.md", "/root/draftsx/a.md", None])
def test_paths_outside_the_root(spark, path):
    rows = spark.createDataFrame([(path,)], "p string").select(layers.relative_name(F.col("p"), "/root/drafts"))
    with pytest.raises(Exception, match="is not under /root/drafts"):
        rows.collect()
