"""Queries on drafts derived from ``documents``: claims, outlines, blocks, references; and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import blank_code
from lectern.operators import citations, references, writing
from lectern.plans.templates import CLAIMS, DRAFTS, NUMBERED, SQL_WORDS, filled_sql, one_of, one_of_sql

QUERIES: dict = {}
SQL: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _drafts(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select(F.col("doc_id").alias("draft_id"), one_of(DRAFTS).alias("text"))


_LINES = f"""d AS (SELECT doc_id AS draft_id, {one_of_sql(DRAFTS)} AS text FROM documents),
s AS (SELECT draft_id, string_split(text, chr(10)) AS l FROM d),
x AS (SELECT draft_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS line, len(l) AS last FROM s)"""


_CLAIM_ROWS = " UNION ALL ".join(
    f"SELECT doc_id AS draft_id, CAST({line} AS INTEGER) AS line, {filled_sql([key])} AS citekey, {filled_sql([claim])} AS claim FROM documents WHERE doc_id % 3 = {t}" for t, line, key, claim in CLAIMS
)


@_query(_CLAIM_ROWS)
def draft_claims(spark: SparkSession, d: str) -> DataFrame:
    """Every citation with the sentence, row, item or heading that makes the claim."""
    return writing.claims(_drafts(spark, d)).select("draft_id", "line", "citekey", "claim")


@_query(rf"""WITH {_LINES},
m AS (SELECT *, regexp_matches(t, '^\s*(?:```|~~~)') AS fence, CASE WHEN regexp_matches(t, '\\end\{{(verbatim|lstlisting|minted|Verbatim)\*?\}}') THEN 0 WHEN regexp_matches(t, '\\begin\{{(verbatim|lstlisting|minted|Verbatim)\*?\}}') THEN 1 END AS mark FROM x),
o AS (SELECT *, sum(CAST(fence AS INT)) OVER w AS fences, coalesce(last_value(CASE WHEN NOT fence THEN mark END IGNORE NULLS) OVER w, 0) AS inside FROM m WINDOW w AS (PARTITION BY draft_id ORDER BY line ROWS UNBOUNDED PRECEDING)),
h AS (SELECT draft_id, line, last, CASE WHEN t LIKE '#%' THEN trim(regexp_extract(t, '^(#{{1,6}})\s+(.*?)\s*#*\s*$', 2)) WHEN t LIKE '%Code%' THEN 'Code \emph{{in}} use' ELSE regexp_extract(t, '\{{(.*)\}}', 1) END AS title,
        CASE WHEN t LIKE '#%' THEN length(regexp_extract(t, '^#+')) WHEN t LIKE '\sub%' THEN 3 ELSE 2 END AS level
      FROM o WHERE NOT fence AND fences % 2 = 0 AND inside = 0 AND coalesce(mark, 1) = 1 AND regexp_matches(t, '^(#{{1,6}})\s|^\s*\\(chapter|(?:sub){{0,2}}section|paragraph)\*?\{{'))
SELECT draft_id, title, CAST(level AS INTEGER) AS level, CAST(line AS INTEGER) AS start, CAST(coalesce(lead(line) OVER (PARTITION BY draft_id ORDER BY line) - 1, last) AS INTEGER) AS stop FROM h""")
def draft_outline(spark: SparkSession, d: str) -> DataFrame:
    """Headings of Markdown and LaTeX outside code, with the lines of their sections."""
    return writing.headings(_drafts(spark, d))


@_query(r"""WITH l AS (SELECT doc_id AS draft_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT draft_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS line FROM l),
p AS (SELECT *, sum(CAST(NOT regexp_matches(t, '\S') AS INT)) OVER (PARTITION BY draft_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS g FROM x)
SELECT draft_id, CAST(min(line) AS INTEGER) AS start, CAST(max(line) AS INTEGER) AS stop FROM p WHERE regexp_matches(t, '\S') GROUP BY draft_id, g""")
def paragraph_spans(spark: SparkSession, d: str) -> DataFrame:
    """Runs of lines between blank ones, of all documents."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").alias("draft_id"), "text")
    return writing.paragraph_spans(writing.draft_lines(docs))


@_query(rf"""WITH {_LINES},
p AS (SELECT draft_id, line, t, sum(CAST(NOT regexp_matches(t, '\S') AS INT)) OVER w AS g FROM x WINDOW w AS (PARTITION BY draft_id ORDER BY line ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, lag(g) OVER w AS before, lag(regexp_matches(t, '^\s*(?:\||#{{1,6}}\s|\\(?:chapter|(?:sub){{0,2}}section|paragraph)\*?\{{)|\\\\\s*$')) OVER w AS after,
        regexp_matches(t, '^\s*(?:\||[-*+]\s|\d+[.)]\s|#{{1,6}}\s|\\item\b|\\(?:begin|end)\{{|\\(?:chapter|(?:sub){{0,2}}section|paragraph)\*?\{{)') AS opens FROM p WHERE regexp_matches(t, '\S') WINDOW w AS (PARTITION BY draft_id ORDER BY line)),
n AS (SELECT *, sum(CAST(before IS NULL OR before <> g OR opens OR after AS INT)) OVER (PARTITION BY draft_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS k FROM b)
SELECT draft_id, CAST(min(line) AS INTEGER) AS start, CAST(max(line) AS INTEGER) AS stop FROM n GROUP BY draft_id, k""")
def block_spans(spark: SparkSession, d: str) -> DataFrame:
    """Rows, items, headings and prose as blocks of lines."""
    return writing.blocks(writing.draft_lines(_drafts(spark, d))).select("draft_id", "start", "stop")


@_query(rf"""WITH {_LINES},
p AS (SELECT draft_id, regexp_split_to_array(text, '\n\s*\n') AS p FROM d),
q AS (SELECT draft_id, unnest(p) AS paragraph, unnest(range(len(p))) AS ord FROM p),
k AS (SELECT doc_id AS draft_id, unnest(['a' || doc_id || 'x', 'b' || (doc_id + 1) || 'x', 'c' || doc_id * 2 || 'x']) AS citekey FROM documents WHERE doc_id % 3 < 2)
SELECT draft_id, citekey, CAST(ord AS INTEGER) AS ord, sha256(paragraph) AS paragraph_sha FROM q JOIN k USING (draft_id) WHERE contains(paragraph, citekey)""")
def citing_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    drafts = _drafts(spark, d)
    keys = citations.cited(drafts).select("draft_id", "citekey").distinct()
    rows = writing.paragraphs_naming(drafts, keys)
    return rows.select("draft_id", "citekey", "ord", F.sha2("paragraph", 256).alias("paragraph_sha"))


@_query(f"""WITH l AS (SELECT doc_id AS draft_id, doc_id % 3 AS t FROM documents)
SELECT draft_id, CAST({1 + DRAFTS[0].index("### 2. references")} AS INTEGER) AS line FROM l WHERE t = 0""")
def references_headings(spark: SparkSession, d: str) -> DataFrame:
    return writing.references_heading(blank_code(_drafts(spark, d), "text"))


_NAMES = "list_transform(range(1, doc_id % 8 + 2), lambda k: CASE k % 3 WHEN 0 THEN '{Group ' || k || '}' WHEN 1 THEN 'Doe' || k || ', Jean-Paul M.' ELSE 'Ann B. Roe' || k END)"
_IEEE = "list_transform(range(1, doc_id % 8 + 2), lambda k: CASE k % 3 WHEN 0 THEN 'Group ' || k WHEN 1 THEN 'J.-P. M. Doe' || k ELSE 'A. B. Roe' || k END)"
_WHO = "CASE WHEN len(n) > 6 THEN n[1] || ' et al.' WHEN len(n) = 1 THEN n[1] WHEN len(n) = 2 THEN n[1] || ' and ' || n[2] ELSE array_to_string(n[1:len(n) - 1], ', ') || ', and ' || n[len(n)] END"
_ENTRIES = f"""own AS (SELECT doc_id, {SQL_WORDS} AS w, {_IEEE} AS n FROM documents),
entries AS (SELECT 'a' || doc_id || 'x' AS citekey, {_WHO} || ', "On ' || w || '," *J\\_Name*, vol. ' || doc_id % 9 || ', ' || CASE WHEN doc_id % 2 = 0 THEN 'pp. 1–' ELSE 'p. 7' END || CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE '' END || ', ' || (1990 + doc_id % 30) || '.' AS entry FROM own
  UNION ALL SELECT 'b' || doc_id || 'x', {_WHO} || ', Eds., "Talks \\[' || doc_id || '\\]," in *Proc. X*, no. 4, n.d.' FROM own
  UNION ALL SELECT 'c' || doc_id || 'x', '*Book ' || doc_id || '*, School, ' || (1990 + doc_id % 30) || '.' FROM own)"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Three ledger entries a document: an article, a paper in proceedings, a book."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    words = F.array_join(F.slice(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0)), 1, 5), " ")
    i = F.col("doc_id")

    def name(k):
        n = k.cast("string")
        return F.when(k % 3 == 0, F.concat(F.lit("{Group "), n, F.lit("}"))).when(k % 3 == 1, F.concat(F.lit("Doe"), n, F.lit(", Jean-Paul M."))).otherwise(F.concat(F.lit("Ann B. Roe"), n))

    names = F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), i % 8 + 1), name), " and ")
    pages = F.when(i % 2 == 0, F.concat(F.lit("1--"), i.cast("string"))).otherwise("7")
    article = F.create_map(F.lit("author"), names, F.lit("journal"), F.lit("J_Name"), F.lit("volume"), (i % 9).cast("string"), F.lit("pages"), pages)
    paper = F.create_map(F.lit("editor"), names, F.lit("booktitle"), F.lit("Proc. X"), F.lit("number"), F.lit("4"))
    book = F.create_map(F.lit("publisher"), F.lit("Press"), F.lit("school"), F.lit("School"))
    year = (1990 + i % 30).cast("string")
    title = F.concat(F.lit("On "), F.coalesce(F.nullif(words, F.lit("")), F.lit("word")), F.lit("."))
    kinds = [("a", title, year, article), ("b", F.concat(F.lit("Talks ["), i.cast("string"), F.lit("]")), F.lit("n.d."), paper), ("c", F.concat(F.lit("Book "), i.cast("string")), year, book)]
    rows = F.array(*(F.struct(F.concat(F.lit(k), i.cast("string"), F.lit("x")).alias("citekey"), t.alias("title"), y.alias("year"), f.alias("fields")) for k, t, y, f in kinds))
    return docs.select(F.explode(rows).alias("r")).select("r.*")


@_query(f"""WITH {_ENTRIES},
k AS (SELECT doc_id AS draft_id, unnest(['a' || doc_id || 'x', 'b' || (doc_id + 1) || 'x', 'c' || doc_id * 2 || 'x']) AS citekey, unnest([1, 2, 3]) AS number FROM documents WHERE doc_id % 3 < 2)
SELECT draft_id, CAST(number AS INTEGER) AS number, citekey, entry FROM k LEFT JOIN entries USING (citekey)""")
def draft_references(spark: SparkSession, d: str) -> DataFrame:
    """The numbered entries of each draft; entries that the ledger lacks are null."""
    return references.reference_list(_drafts(spark, d), _items(spark, d))


@_query("""WITH k AS (SELECT doc_id AS draft_id, unnest(['b' || (doc_id + 1) || 'x', 'c' || doc_id * 2 || 'x']) AS citekey, unnest([doc_id + 1, doc_id * 2]) AS of, unnest([1, 2]) AS o FROM documents WHERE doc_id % 3 < 2)
SELECT draft_id, string_agg(citekey, ', ' ORDER BY o) AS missing FROM k WHERE of NOT IN (SELECT doc_id FROM documents) GROUP BY draft_id""")
def references_missing(spark: SparkSession, d: str) -> DataFrame:
    """Drafts that can't be given a section, and the keys that the ledger lacks."""
    return references.unlisted(references.reference_list(_drafts(spark, d), _items(spark, d)))


@_query(f"SELECT doc_id AS draft_id, sha256({one_of_sql(NUMBERED)}) AS text_sha FROM documents")
def numbered_drafts(spark: SparkSession, d: str) -> DataFrame:
    """Drafts with numbers for keys; code, and LaTeX commands, stay."""
    return references.renumber(_drafts(spark, d)).select("draft_id", F.sha2("text", 256).alias("text_sha"))


@_query(f"""WITH {_ENTRIES},
d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN {filled_sql(DRAFTS[0][: DRAFTS[0].index("### 2. references")])} ELSE {one_of_sql(DRAFTS)} END AS head, {one_of_sql(DRAFTS)} AS whole FROM documents),
s AS (SELECT d.doc_id, '[1] ' || ea.entry || ' `' || ea.citekey || '`' || repeat(chr(10), 2) || '[2] ' || eb.entry || ' `' || eb.citekey || '`' || repeat(chr(10), 2) || '[3] ' || ec.entry || ' `' || ec.citekey || '`' AS list
  FROM d JOIN entries ea ON ea.citekey = 'a' || doc_id || 'x' JOIN entries eb ON eb.citekey = 'b' || (doc_id + 1) || 'x' JOIN entries ec ON ec.citekey = 'c' || doc_id * 2 || 'x' WHERE doc_id % 3 < 2)
SELECT doc_id AS draft_id, sha256(CASE WHEN list IS NULL THEN whole ELSE rtrim(head, chr(10) || ' ') || repeat(chr(10), 2) || '## References' || repeat(chr(10), 2) || list || chr(10) END) AS text_sha FROM d LEFT JOIN s USING (doc_id)""")
def sectioned_drafts(spark: SparkSession, d: str) -> DataFrame:
    """Drafts with a References section in place of an old one, or at the end."""
    drafts = _drafts(spark, d)
    built = references.sections(references.reference_list(drafts, _items(spark, d)))
    out = references.with_section(drafts, built, writing.references_heading(blank_code(drafts, "text")))
    return out.select("draft_id", F.sha2("text", 256).alias("text_sha"))
