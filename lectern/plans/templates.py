"""Texts derived from ``documents``, written once as lines with places to fill in, for Spark and as SQL.

{id} is the doc_id, {next} and {twice} follow from it, {w} are the first five
words of a-z of the document's text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = re.compile(r"\{(id|next|twice|w)\}")
SQL_WORDS = "coalesce(nullif(array_to_string(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')[1:5], ' '), ''), 'word')"
_SQL = {"id": "CAST(doc_id AS VARCHAR)", "next": "CAST(doc_id + 1 AS VARCHAR)", "twice": "CAST(doc_id * 2 AS VARCHAR)", "w": SQL_WORDS}


def _columns() -> dict[str, Column]:
    words = F.array_join(F.slice(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0)), 1, 5), " ")
    own = {"id": F.col("doc_id"), "next": F.col("doc_id") + 1, "twice": F.col("doc_id") * 2}
    return {k: c.cast("string") for k, c in own.items()} | {"w": F.coalesce(F.nullif(words, F.lit("")), F.lit("word"))}


def filled(lines: list[str]) -> Column:
    parts, own = PLACES.split("\n".join(lines)), _columns()
    return F.concat(*(own[p] if k % 2 else F.lit(p) for k, p in enumerate(parts)))


def filled_sql(lines: list[str]) -> str:
    def quoted(text: str) -> str:
        return " || chr(10) || ".join("'" + t.replace("'", "''") + "'" for t in text.split("\n"))

    parts = PLACES.split("\n".join(lines))
    return " || ".join(_SQL[p] if k % 2 else quoted(p) for k, p in enumerate(parts) if p or k % 2)


def one_of(templates: list[list[str]]) -> Column:
    """The doc_id chooses the template."""
    out = filled(templates[-1])
    for k, t in enumerate(templates[:-1]):
        out = F.when(F.col("doc_id") % len(templates) == k, filled(t)).otherwise(out)
    return out


def one_of_sql(templates: list[list[str]]) -> str:
    cases = " ".join(f"WHEN {k} THEN {filled_sql(t)}" for k, t in enumerate(templates))
    return f"CASE doc_id % {len(templates)} {cases} END"


#: Drafts in Markdown and in LaTeX, and one that cites nothing; keys are a{id}x, b{next}x, c{twice}x.
DRAFTS = [
    [
        "# Report {id}",
        "",
        "Opening words. As in Fig. 2, {w} holds [@a{id}x; @b{next}x]. Last words",
        "continue here (see @c{twice}x, p. 3).",
        "",
        "## Methods",
        "Right below the heading [@b{next}x].",
        "- item alpha [@a{id}x]",
        r"- item beta \citep{b{next}x,c{twice}x} wraps",
        "  to the next line",
        "1. numbered item [-@c{twice}x]",
        "",
        "| cell one | {w} [@c{twice}x] |",
        "|---|:--:|",
        r"| `code @doc_1` | other \| pipe |",
        "",
        "```",
        "# Not a heading [@hidden]",
        "```",
        "### 2. references",
        "",
        "[1] old entry",
    ],
    [
        r"\section{Report {id}}",
        r"Prose under it \citet[p.~2]{a{id}x} and mail x@doc_0.org here.",
        r"\begin{itemize}",
        r"\item First {w} \cite{b{next}x}",
        r"\item Second, e.g. Plain [@a{id}x]! Third one",
        r"\end{itemize}",
        r"\begin{tabular}{ll}",
        r"one & {w} \citep{c{twice}x} \\",
        r"\hline",
        r"two & three \\",
        r"\end{tabular}",
        "",
        r"\subsection*{Code \emph{in} use}\label{sec}",
        r"\begin{verbatim}",
        r"\section{Hidden} @doc_5",
        r"\end{verbatim}",
        "Closing. {w} again @b{next}x",
    ],
    ["# Only {id} ##", "", "{w}.", "", "   ", "> quoted {w}", "~~~", "## hidden", "~~~", "#### Deep"],
]

#: What each draft claims: template, line, key and claim, as the rules give them.
CLAIMS = [
    (0, 3, "a{id}x", "As in Fig. 2, {w} holds."),
    (0, 3, "b{next}x", "As in Fig. 2, {w} holds."),
    (0, 4, "c{twice}x", "Last words continue here (see @c{twice}x, p. 3)."),
    (0, 7, "b{next}x", "Right below the heading."),
    (0, 8, "a{id}x", "item alpha"),
    (0, 9, "b{next}x", "item beta wraps to the next line"),
    (0, 9, "c{twice}x", "item beta wraps to the next line"),
    (0, 11, "c{twice}x", "numbered item [-@c{twice}x]"),
    (0, 13, "c{twice}x", "cell one -- {w}"),
    (1, 2, "a{id}x", r"Prose under it \citet[p.~2]{a{id}x} and mail x@doc_0.org here."),
    (1, 4, "b{next}x", "First {w}"),
    (1, 5, "a{id}x", "Plain!"),
    (1, 8, "c{twice}x", "one -- {w}"),
    (1, 17, "b{next}x", "Closing. {w} again @b{next}x"),
]

#: The drafts with numbers for keys.
NUMBERED = [
    [
        *DRAFTS[0][:2],
        "Opening words. As in Fig. 2, {w} holds [1], [2]. Last words",
        "continue here (see [3], p. 3).",
        *DRAFTS[0][4:6],
        "Right below the heading [2].",
        "- item alpha [1]",
        *DRAFTS[0][8:10],
        "1. numbered item [3]",
        "",
        "| cell one | {w} [3] |",
        *DRAFTS[0][13:],
    ],
    [*DRAFTS[1][:4], r"\item Second, e.g. Plain [1]! Third one", *DRAFTS[1][5:16], "Closing. {w} again [2]"],
    DRAFTS[2],
]

#: A dossier's files: what was turned down, which section cites what, evidence, and its scope.
REJECTED = ["# Turned down", "| citekey | by | reason |", "|---|---|---|", "| `doe_{id}` | {w} | too old |", r"| `roe-x_{next}` and `poe:y_1` | a \| b | off topic |", "| `bad` | two cells |", "no row | at | all"]
SECTIONS = ["| section | citekeys | notes |", "|---|---|---|", "| 1. Failure  Modes | `doe_{id}`, `roe-x_{next}` | |", "| 2. {w} | `doe_{id}` | n |", "| 3. Summary of modes | `poe:y_1` | |"]
EVIDENCE = ["<!-- a comment", "## not counted", "-->", "intro", "## `doe_{id}` -- kept", "support: {w}", "", "## A heading of `its` own", "text", "## `doe_{id}`", "later: {w}", "", ""]
SCOPE = ["# Scope", "- corpus: {id} citekeys, digest `abc{next}`", "- corpus: 1 citekey, digest ff"]
