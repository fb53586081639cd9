"""Text columns: tokens, normal forms, citation markers, pages and quality shares.

All are built-in expressions, so they stay inside code generation. A null text
counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that search ignores.
SEARCH_STOPWORDS = "a an the of on in for and to with is are be this that as by from at".split()
#: Words that support scoring ignores besides.
CLAIM_STOPWORDS = SEARCH_STOPWORDS + "it its can has have was were which such these those their than then but not also".split()
#: Prefixes of a DOI.
DOI_PREFIXES = ["https://doi.org/", "http://doi.org/", "doi:"]
#: Citation markers of LaTeX (any command with "cite") and Pandoc.
_GAP = r"[ \t]*\n?[ \t]*"
LATEX_CITE = rf"\\[A-Za-z]*[Cc]ite[A-Za-z]*{_GAP}\*?(?:{_GAP}\[[^\]]*\])*{_GAP}\{{([^}}]+)\}}"
PANDOC_CITE = r"(?<![A-Za-z0-9._%+\-\\])-?@([A-Za-z][A-Za-z0-9_-]*)"
#: Fenced blocks, verbatim environments and inline spans, in the order they are blanked.
CODE = [r"(?s)```.*?```", r"(?s)\\begin\{(verbatim|lstlisting|minted)\*?\}.*?\\end\{\1\*?\}", r"`[^`\n]+`"]


def _text(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def alphanumeric_words(x: Column | str) -> Column:
    """Lower-case runs of a-z and 0-9."""
    return F.regexp_extract_all(F.lower(_text(x)), F.lit("[a-z0-9]+"), F.lit(0))


def search_tokens(x: Column | str) -> Column:
    """Words of over two characters that aren't stop words."""
    return F.filter(alphanumeric_words(x), lambda w: (F.length(w) > 2) & ~w.isin(SEARCH_STOPWORDS))


def distinctive_words(x: Column | str) -> Column:
    """The set of words that tell one claim from another."""
    return F.array_distinct(F.filter(alphanumeric_words(x), lambda w: (F.length(w) > 2) & ~w.isin(CLAIM_STOPWORDS)))


def normal_title(x: Column | str) -> Column:
    plain = F.regexp_replace(F.lower(F.translate(_text(x), "{}", "")), r"[^a-z0-9\s]", " ")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def normal_doi(x: Column | str) -> Column:
    out = F.lower(F.trim(_text(x)))
    for p in DOI_PREFIXES:
        out = F.when(out.startswith(p), F.substring(out, len(p) + 1, 1 << 30)).otherwise(out)
    return out


def author_names(x: Column | str) -> Column:
    """(first, last) of each author of a field like ``Last, First and First Last``."""

    def name(a: Column) -> Column:
        comma = F.split(a, r"\s*,\s*", 2)
        words = F.split(a, r"\s+(?=\S+$)")
        given = F.when(a.contains(","), F.get(comma, F.lit(1))).otherwise(F.when(F.size(words) > 1, F.get(words, F.lit(0))).otherwise(""))
        return F.struct(given.alias("first"), F.when(a.contains(","), F.get(comma, F.lit(0))).otherwise(F.element_at(words, -1)).alias("last"))

    parts = F.filter(F.transform(F.split(_text(x), r"\s+and(?=\s)"), lambda a: F.trim(a)), lambda a: a != "")
    return F.transform(parts, name)


def _spans(x: Column, pattern: str) -> tuple[Column, Column]:
    return F.split(x, pattern, -1), F.regexp_extract_all(x, F.lit(pattern), F.lit(0))


def blank_spans(x: Column | str, pattern: str) -> Column:
    """What ``pattern`` matches turned to spaces; all else, and line ends, keep their place."""
    between, found = _spans(_text(x), pattern)
    blanks = F.transform(found, lambda m: F.regexp_replace(m, r"[^\n]", " "))
    out = F.array_join(F.flatten(F.transform(F.arrays_zip(between.alias("a"), blanks.alias("b")), lambda z: F.array(F.coalesce(z["a"], F.lit("")), F.coalesce(z["b"], F.lit(""))))), "")
    return F.when(F.regexp_like(_text(x), F.lit(pattern)), out).otherwise(_text(x))


def blank_code(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with the code of a text column blanked, one kind of code a projection."""
    for pattern in CODE:
        rows = rows.withColumn(column, blank_spans(column, pattern))
    return rows


def citations(x: Column | str) -> Column:
    """offset, place, line and citekey of each citation of a text with blanked code, in document order.

    Offsets and lines are running sums over the pieces between the markers.
    """
    text = _text(x)

    def lines(t: Column) -> Column:
        return F.length(t) - F.length(F.translate(t, "\n", ""))

    def found(pattern: str) -> Column:
        between, whole = _spans(text, pattern)
        keys = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        steps = F.arrays_zip(between.alias("a"), whole.alias("b"), keys.alias("k"))
        none = F.array().cast("array<struct<offset:int,place:int,line:int,citekey:string>>")
        start = F.struct(F.lit(0).alias("offset"), F.lit(1).alias("line"), none.alias("out"))

        def step(acc: Column, z: Column) -> Column:
            a, b = F.coalesce(z["a"], F.lit("")), F.coalesce(z["b"], F.lit(""))
            offset, line = acc["offset"] + F.length(a), acc["line"] + lines(a)
            parts = F.filter(F.transform(F.split(F.coalesce(z["k"], F.lit("")), ","), lambda k: F.trim(k)), lambda k: k != "")
            own = F.transform(parts, lambda k, j: F.struct(offset.alias("offset"), j.alias("place"), line.alias("line"), k.alias("citekey")))
            return F.struct((offset + F.length(b)).alias("offset"), (line + lines(b)).alias("line"), F.concat(acc["out"], own).alias("out"))

        return F.aggregate(steps, start, step, lambda acc: acc["out"])

    return F.array_sort(F.concat(found(LATEX_CITE), found(PANDOC_CITE)))


def pages(x: Column | str, mark: str = "\f") -> Column:
    """(page, text) of the pages that aren't blank; blank ones are counted."""
    parts = F.transform(F.split(_text(x), mark, -1), lambda p, i: F.struct((i + 1).alias("page"), p.alias("text")))
    return F.filter(parts, lambda p: F.trim(p["text"]) != "")


def page_count(x: Column | str, mark: str = "\f") -> Column:
    text = F.regexp_replace(_text(x), r"\s+$", "")
    return F.length(text) - F.length(F.translate(text, mark, "")) + 1


def letter_runs(x: Column | str) -> Column:
    return F.regexp_extract_all(_text(x), F.lit(r"\p{L}+"), F.lit(0))


def word_chunks(x: Column | str, size: int = 200, overlap: int = 40) -> Column:
    """(i, chunk) of windows of ``size`` words that share ``overlap`` with the next."""
    words = F.filter(F.split(_text(x), r"\s+"), lambda w: w != "")
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1, F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s, i: F.struct(i.alias("i"), F.array_join(F.slice(words, s + 1, size), " ").alias("chunk")))


def collection_slug(x: Column | str) -> Column:
    return F.substring(F.regexp_replace(_text(x), r"[^A-Za-z0-9._-]+", "-"), 1, 63)


def strip_images(x: Column | str) -> Column:
    """Markdown without lines that hold an image or an image comment only, runs of blank lines shortened to one."""
    line = F.transform(F.split(_text(x), "\n", -1), lambda t: F.when(F.trim(t).rlike(r"^(!\[[^\]]*\]\([^)]*\)|<!--\s*image\s*-->)$"), "").otherwise(t))
    return F.regexp_replace(F.array_join(line, "\n"), r"\n\n\n+", "\n\n")


#: Names that Windows keeps for devices, and characters that no file name may hold.
DEVICES = "^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$"
ILLEGAL = r'[/\\:*?"<>|\x00-\x1f]'


def citekey_problem(x: Column | str) -> Column:
    """Why a citekey can't name a file; null if it can."""
    key = _text(x)
    device = F.upper(F.split(key, r"\.", 2)[0]).rlike(DEVICES)
    return (
        F.when(key == "", "empty")
        .when(key.isin(".", ".."), "a directory name")
        .when(key.rlike(ILLEGAL), "an illegal character")
        .when(key.rlike(r"[. ]$"), "a trailing dot or space")
        .when(device, "a reserved device name")
    )


def contract_numbers(numbers: Column) -> Column:
    """Distinct numbers as text; runs of three or more as ``[a]–[b]``."""
    ordered = F.array_sort(F.array_distinct(numbers))
    starts = F.filter(ordered, lambda n: ~F.array_contains(ordered, n - 1))

    def run(a: Column) -> Column:
        end = F.aggregate(F.filter(ordered, lambda n: n > a), a, lambda e, n: F.when(n == e + 1, n).otherwise(e))
        one, two = F.concat(F.lit("["), a, F.lit("]")), F.concat(F.lit("["), end, F.lit("]"))
        return F.when(end - a >= 2, F.concat(one, F.lit("–"), two)).when(end > a, F.concat(one, F.lit(", "), two)).otherwise(one)

    return F.array_join(F.transform(starts, run), ", ")


#: How a caption names what it stands under.
CAPTION = r"(?i)^\s*(Figure|Fig\.?|Table|Scheme)\s*(\d+(?:\.\d+)*[a-z]?)\b"


def figure_citation(caption: Column | str, page: Column | str, citekey: Column | str) -> Column:
    """How to cite a picture: by the label of its caption, else by its page."""
    kind, label = (F.regexp_extract(_text(caption), CAPTION, k) for k in (1, 2))
    at = F.col(page) if isinstance(page, str) else page
    ref = F.concat(F.lit("[@"), F.col(citekey) if isinstance(citekey, str) else citekey, F.lit("]"))
    name = F.when(F.lower(kind).startswith("fig"), "Figure").otherwise(F.initcap(kind))
    labelled = F.concat(name, F.lit(" "), label, F.lit(" of "), ref, F.coalesce(F.concat(F.lit(", p."), at.cast("string")), F.lit("")))
    placed = F.coalesce(F.concat(F.lit("the figure on p."), at.cast("string"), F.lit(" of "), ref), F.concat(F.lit("an unplaced figure in "), ref))
    return F.when(label != "", labelled).otherwise(placed)


def first_errors(errors: Column | str, most: int = 3) -> Column:
    """The first different messages of a list, and how many more there are."""
    different = F.array_distinct(F.col(errors) if isinstance(errors, str) else errors)
    more = F.size(different) - most
    return F.concat(F.array_join(F.slice(different, 1, most), "; "), F.when(more > 0, F.concat(F.lit(" (and "), more.cast("string"), F.lit(" more)"))).otherwise(""))
