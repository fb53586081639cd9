import pytest
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import citations, ledger, retrieval


def one(spark, x, f):
    return spark.createDataFrame([(x,)], "x string").select(f("x").alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "x", "y"),
    [
        (T.search_tokens, "Digital Twins ARE great", ["digital", "twins", "great"]),
        (T.search_tokens, "of the and", []),
        (T.search_tokens, None, []),
        (T.normal_title, "An {Example} Paper: 2", "an example paper 2"),
        (T.normal_doi, " https://doi.org/10.1/X ", "10.1/x"),
        (T.page_count, "a\fb\n", 2),
        (T.citekey_problem, "CON.txt", "a reserved device name"),
        (T.citekey_problem, "smith_2024", None),
        (T.collection_slug, "a b/c", "a-b-c"),
        (T.strip_images, "a\n![x](y.png)\n\n\nb", "a\n\nb"),
    ],
)
def test_function(spark, f, x, y):
    assert one(spark, x, f) == y


def test_authors(spark):
    got = one(spark, "Smith, Jane and  and Doe, John and Cher and Ann Lee", T.author_names)
    assert [tuple(a) for a in got] == [("Jane", "Smith"), ("John", "Doe"), ("", "Cher"), ("Ann", "Lee")]


def test_pages_and_chunks(spark):
    assert [tuple(p) for p in one(spark, "a\f \fc", T.pages)] == [(1, "a"), (3, "c")]
    chunks = one(spark, "tide reef kelp  moss\nfern sand crab", lambda x: T.word_chunks(x, 5, 2))
    assert [c["chunk"] for c in chunks] == ["tide reef kelp moss fern", "moss fern sand crab", "crab"]


@pytest.mark.parametrize(("n", "y"), [([1], "[1]"), ([1, 2], "[1], [2]"), ([6, 3, 4, 5, 1], "[1], [3]–[6]")])
def test_contraction(spark, n, y):
    assert spark.createDataFrame([(n,)], "n array<int>").select(T.contract_numbers(F.col("n"))).first()[0] == y


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("\\autocite[][7]{kelp-3, reef_1}\n\nsee -@moss9 and @fern.", [(1, "kelp-3"), (1, "reef_1"), (3, "moss9"), (3, "fern")]),
        ("a \\textcite\n[ch. 2]{tide88} b", [(1, "tide88")]),
        ("  text ```sh\ncurl @reef\n``` @moss9 `@fern` \\begin{lstlisting}@kelp\\end{lstlisting}", [(3, "moss9")]),
        ("- item\n  ```\n  @kelp\n  ```\n  @reef_1", [(5, "reef_1")]),
        ("~~~\n@seen\n~~~", [(2, "seen")]),
        ("100%@no a.b@no \\@no x@no (@yes)", [(1, "yes")]),
    ],
)
def test_citations(spark, text, found):
    rows = citations.cited(spark.createDataFrame([(1, text)], "draft_id int, text string")).orderBy("offset", "place").collect()
    assert [(r["line"], r["citekey"]) for r in rows] == found


def test_ledger_states(spark):
    bib = spark.createDataFrame([("new", "h"), ("nofile", None), ("same", "h"), ("gone", "h"), ("changed", "h2"), ("soft", "h"), ("hard", "h")], "citekey string, pdf_hash string")
    items = [("same", "h", "parsed", None, True), ("gone", "h", "parsed", None, False), ("changed", "h", "parsed", None, True), ("soft", "h", "parse_failed", None, False), ("hard", "h", "parse_failed", "deterministic", False)]
    items = spark.createDataFrame(items, "citekey string, old_hash string, old_status string, failure_kind string, output_present boolean")
    got = {r["citekey"]: (r["needs_parse"], r["status"]) for r in ledger.decide(bib, items).collect()}
    assert got == {"new": (True, "discovered"), "nofile": (False, "no_pdf"), "same": (False, "parsed"), "gone": (True, "discovered"), "changed": (True, "discovered"), "soft": (True, "discovered"), "hard": (False, "parse_failed")}
    with pytest.raises(ValueError):
        ledger.prune(items, bib.limit(0))


def test_windows():
    text = "kelp " + "water " * 50 + "a reef of kelp and moss below " + "water " * 50 + "moss"
    found = retrieval.best_windows(text, ["kelp", "reef", "moss"], 60, 2)
    assert "reef of kelp and moss" in " ".join(found) and len(found) == 2
