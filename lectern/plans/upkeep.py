"""Queries on bibliographies, sidecars, dossiers, indexes and runs derived from the tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import figure_citation, first_errors
from lectern.operators import dossier, ledger, retrieval, runs
from lectern.plans.templates import EVIDENCE, REJECTED, SCOPE, SECTIONS, SQL_WORDS, filled, one_of, one_of_sql
from lectern.sources import bibliography, passages

QUERIES: dict = {}
SQL: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


# --- bibliographies: each document is a file of six blocks -------------------

BIB = [
    "@comment{made for {id}}",
    "@article{key_{id},",
    "  title = {The {{w}} of {T}wins},",
    "  author = {Doe, Jane and Ann Roe},",
    "  year = {2001}, journal = {J of X},",
    '  doi = "10.1/{id}",',
    "  file = {Full Text:files/{id}/a:b.pdf:application/pdf;Snap:files/{id}/s.html:text/html},",
    "}",
    '@misc(other_{next}, title="Untitled {id}", file="Snap:x.html:text/html")',
    "@book{../bad{id}, title={No}, author={X}}",
    "@article{broken{id}, title = {not closed,",
    "  author = {Y}",
    '@string{jan = "January"}',
    "@misc{last_{twice}, title = {Last one}, author = {}, file={nonsense}, publisher = { }}",
]


def _library(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    files = docs.select(F.col("doc_id").cast("string").alias("path"), filled(BIB).alias("text"))
    there = docs.where("doc_id % 2 = 0").select(F.concat(F.lit("files/"), F.col("doc_id").cast("string"), F.lit("/a:b.pdf")).alias("path"))
    return bibliography.library(bibliography.entries(files), there)


_LIBRARY = f"""lib AS (SELECT 'key_' || doc_id AS citekey, 'article' AS item_type, 'The ' || {SQL_WORDS} || ' of Twins' AS title, 2 AS n_authors, 'Doe' AS last, '2001' AS year, '10.1/' || doc_id AS doi,
    CASE WHEN doc_id % 2 = 0 THEN 'resolved' ELSE 'pdf_path_gone' END AS pdf_resolution, CASE WHEN doc_id % 2 = 0 THEN 'files/' || doc_id || '/a:b.pdf' END AS pdf_path, '{{"author":"Doe, Jane and Ann Roe","journal":"J of X"}}' AS kept FROM documents
  UNION ALL SELECT 'other_' || (doc_id + 1), 'misc', 'Untitled ' || doc_id, 0, NULL, 'n.d.', NULL, 'non_pdf_attachment', NULL, NULL FROM documents
  UNION ALL SELECT 'last_' || doc_id * 2, 'misc', 'Last one', 0, NULL, 'n.d.', NULL, 'malformed_file_field', NULL, NULL FROM documents)"""


@_query(f"WITH {_LIBRARY} SELECT * FROM lib")
def bib_library(spark: SparkSession, d: str) -> DataFrame:
    """The entries of all files, parsed; those whose citekey can't name a file are left out."""
    lib = _library(spark, d)
    last = F.get(F.col("authors"), F.lit(0))["last"]
    return lib.select("citekey", "item_type", "title", F.size("authors").alias("n_authors"), last.alias("last"), "year", "doi", "pdf_resolution", "pdf_path", bibliography.kept_fields().alias("kept"))


@_query("SELECT CAST(doc_id AS VARCHAR) AS path, CAST(5 AS BIGINT) AS found, CAST(1 AS BIGINT) AS dropped FROM documents")
def bib_dropped(spark: SparkSession, d: str) -> DataFrame:
    files = _docs(spark, d).select(F.col("doc_id").cast("string").alias("path"), filled(BIB).alias("text"))
    return bibliography.dropped(bibliography.entries(files))


@_query(f"WITH {_LIBRARY} SELECT pdf_resolution, count(*) AS n FROM lib WHERE pdf_resolution <> 'resolved' GROUP BY 1")
def bib_missing_reasons(spark: SparkSession, d: str) -> DataFrame:
    return bibliography.missing_reasons(_library(spark, d))


@_query(f"WITH {_LIBRARY} SELECT citekey FROM lib WHERE n_authors = 0")
def bib_authorless(spark: SparkSession, d: str) -> DataFrame:
    return bibliography.without_authors(_library(spark, d))


# --- passages ---------------------------------------------------------------

SIDECAR = [
    '[{"text": " {w}", "label": "DocItemLabel.TEXT", "page": 1}, {"text": "  ", "label": "text", "page": 2}, "no record",',
    ' {"text": "head {id}", "label": "section_header", "page": true}, {"text": "foot", "label": "page_footer", "page": 3},',
    ' {"text": "item {next}", "label": "List_Item", "page": 0}, {"label": "text"}, {"text": "t", "label": "title", "page": 2.5}]',
]


def _sidecars(spark: SparkSession, d: str) -> DataFrame:
    other = F.when(F.col("doc_id") % 5 == 0, '{"text": "no list"}').when(F.col("doc_id") % 5 == 1, "[{").otherwise(filled(SIDECAR))
    return _docs(spark, d).select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("citekey"), other.alias("json"))


@_query(f"""WITH s AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents WHERE doc_id % 5 > 1),
r AS (SELECT doc_id, unnest([' ' || w, 'head ' || doc_id, 'item ' || (doc_id + 1), 't']) AS text, unnest([0, 3, 5, 7]) AS ord, unnest([1, NULL, NULL, NULL]) AS page FROM s)
SELECT 'doc_' || doc_id AS citekey, CAST(ord AS INTEGER) AS ord, text, CAST(page AS INTEGER) AS page FROM r""")
def sidecar_passages(spark: SparkSession, d: str) -> DataFrame:
    """Records of JSON sidecars that may be quoted."""
    rows = passages.sidecar(_sidecars(spark, d))
    return rows.where(passages.quotable(F.col("label"))).select("citekey", "ord", "text", "page")


@_query("""WITH p AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
q AS (SELECT doc_id, len(list_filter(p, lambda x: trim(x) <> '')) AS n FROM p)
SELECT 'doc_' || doc_id AS citekey, CASE WHEN doc_id % 4 = 0 THEN 'enrichment' WHEN doc_id % 5 > 1 THEN 'sidecar' WHEN n > 1 THEN 'pages' END AS source,
  CASE WHEN doc_id % 4 = 0 THEN 1 WHEN doc_id % 5 > 1 THEN 5 WHEN n > 1 THEN n ELSE 0 END AS passages FROM q""")
def passage_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Where each item's passages come from: enrichment, sidecar, pages of the text, or nowhere. Lines stand for pages."""
    items = _docs(spark, d).select("doc_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("citekey"), F.translate(F.coalesce("text", F.lit("")), "\n", "\f").alias("text"))
    enriched = items.where("doc_id % 4 = 0").select("citekey", F.lit(0).alias("ord"), "text", F.lit(None).cast("int").alias("page"))
    rows = passages.ladder([("enrichment", enriched), ("sidecar", passages.sidecar(_sidecars(spark, d))), ("pages", passages.parsed_pages(items))], items)
    return rows.groupBy("citekey", "source").agg(F.count("ord").alias("passages"))


@_query("""WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS rank, count(*) OVER () AS n FROM documents),
w AS (SELECT DISTINCT CAST(round_even(i * (n - 1) / 19.0, 0) AS BIGINT) AS rank FROM (SELECT max(n) AS n FROM r), range(20) AS t(i))
SELECT doc_id, n_chars, rank FROM r JOIN w USING (rank)""")
def rank_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twenty documents at even distances by size."""
    out = passages.page_sample(_docs(spark, d).select("doc_id", "n_chars"), 20, "n_chars", "doc_id")
    return out.select("doc_id", "n_chars", F.col("rank").cast("long").alias("rank"))


# --- dossiers: each document is one ------------------------------------------


def _files(spark: SparkSession, d: str, lines: list[str]) -> DataFrame:
    return _docs(spark, d).select(F.col("doc_id").alias("dossier"), filled(lines).alias("text"))


@_query("""SELECT doc_id AS dossier, 'doe_' || doc_id AS citekey, 'too old' AS reason FROM documents
UNION ALL SELECT doc_id, unnest(['roe-x_' || (doc_id + 1), 'poe:y_1']), 'off topic' FROM documents""")
def dossier_rejections(spark: SparkSession, d: str) -> DataFrame:
    return dossier.rejections(_files(spark, d, REJECTED))


@_query(f"""WITH s AS (SELECT doc_id, '1. Failure  Modes; 2. ' || {SQL_WORDS} AS two FROM documents)
SELECT doc_id AS dossier, 'doe_' || doc_id AS citekey, two AS sections FROM s
UNION ALL SELECT doc_id, 'roe-x_' || (doc_id + 1), '1. Failure  Modes' FROM s UNION ALL SELECT doc_id, 'poe:y_1', '3. Summary of modes' FROM s""")
def dossier_key_sections(spark: SparkSession, d: str) -> DataFrame:
    """The sections that cite each key."""
    return dossier.sections_of_keys(dossier.section_keys(_files(spark, d, SECTIONS)))


@_query(f"""WITH s AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
a AS (SELECT doc_id, w, unnest(['failure modes', '3. SUMMARY of   modes', 'modes', 'absent']) AS wanted FROM s),
k AS (SELECT doc_id, w, wanted, unnest(['1. Failure  Modes', '2. ' || w, '3. Summary of modes']) AS section FROM a),
m AS (SELECT *, regexp_replace(lower(wanted), '\\s+', ' ', 'g') AS x, regexp_replace(lower(section), '\\s+', ' ', 'g') AS y FROM k)
SELECT doc_id AS dossier, wanted, CASE WHEN count(*) FILTER (WHERE x = y) > 0 THEN min(section) FILTER (WHERE x = y) WHEN count(*) FILTER (WHERE contains(x, y) OR contains(y, x)) = 1 THEN min(section) FILTER (WHERE contains(x, y) OR contains(y, x)) END AS section FROM m GROUP BY ALL""")
def dossier_section_requests(spark: SparkSession, d: str) -> DataFrame:
    """The section that a request names, if it names one."""
    files = _files(spark, d, SECTIONS)
    wanted = files.select("dossier", F.explode(F.array(*map(F.lit, ["failure modes", "3. SUMMARY of   modes", "modes", "absent"]))).alias("wanted"))
    return dossier.match_sections(wanted, dossier.section_keys(files))


@_query(f"""WITH s AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents)
SELECT doc_id AS dossier, 'doe_' || doc_id AS citekey, '## `doe_' || doc_id || '`' || chr(10) || 'later: ' || w || chr(10) AS block FROM s
UNION ALL SELECT doc_id, 'roe-x_' || (doc_id + 1), NULL FROM s UNION ALL SELECT doc_id, 'poe:y_1', NULL FROM s""")
def dossier_briefs(spark: SparkSession, d: str) -> DataFrame:
    """The evidence of every key that the sections cite; null where it was never written down."""
    return dossier.brief(dossier.section_keys(_files(spark, d, SECTIONS)), dossier.evidence_blocks(_files(spark, d, EVIDENCE)))


@_query("SELECT doc_id AS dossier, CAST(3 AS BIGINT) AS blocks, CAST(-1 AS BIGINT) AS rows, CAST(4 AS BIGINT) AS prose FROM documents")
def dossier_counts(spark: SparkSession, d: str) -> DataFrame:
    return dossier.entry_counts(_files(spark, d, EVIDENCE))


@_query("SELECT doc_id AS dossier, doc_id AS n, 'abc' || (doc_id + 1) AS digest, doc_id <> 6 AS drifted FROM documents")
def dossier_drift_flags(spark: SparkSession, d: str) -> DataFrame:
    """Dossiers whose recorded digest is another than the corpus has (abc7)."""
    return dossier.drift_flags(dossier.recorded_corpus(_files(spark, d, SCOPE)), F.lit("abc7"))


# --- the term index and the ledger between two runs --------------------------


def _states(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The items of an earlier run (four of five, some with another text, and a vanished one each) and those of now."""
    now = retrieval.corpus(_docs(spark, d))
    was = _docs(spark, d).where("doc_id % 5 > 0").withColumn("text", F.when(F.col("doc_id") % 7 == 0, "an earlier text").otherwise(F.col("text")))
    gone = _docs(spark, d).where("doc_id % 11 = 0").select((-F.col("doc_id") - 1).alias("doc_id"), "text")
    return retrieval.corpus(was.select("doc_id", "text").unionByName(gone)), now


_CHANGES = """ch AS (SELECT 'doc_' || doc_id AS citekey, CASE WHEN doc_id % 5 = 0 THEN 'new' WHEN doc_id % 7 = 0 AND coalesce(text, '') <> 'an earlier text' THEN 'changed' ELSE 'kept' END AS change FROM documents
  UNION ALL SELECT 'doc_' || (-doc_id - 1), 'gone' FROM documents WHERE doc_id % 11 = 0)"""


@_query(f"WITH {_CHANGES} SELECT * FROM ch")
def index_changes(spark: SparkSession, d: str) -> DataFrame:
    was, now = _states(spark, d)
    return retrieval.index_changes(retrieval.fingerprints(was), now)


@_query("""WITH t AS (SELECT 'doc_' || doc_id AS citekey, regexp_extract_all(lower(split_part(coalesce(text, ''), chr(10), 1) || chr(10) || coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
k AS (SELECT citekey, list_filter(w, lambda x: length(x) > 2 AND x NOT IN ('a','an','the','of','on','in','for','and','to','with','is','are','be','this','that','as','by','from','at')) AS w FROM t)
SELECT citekey, CAST(len(w) AS INTEGER) AS length, CAST(len(list_distinct(w)) AS BIGINT) AS terms, CAST(len(w) AS BIGINT) AS tokens FROM k""")
def index_refresh(spark: SparkSession, d: str) -> DataFrame:
    """A refreshed index is the index of all items; only new and changed ones are tokenised again."""
    was, now = _states(spark, d)
    fresh = retrieval.refresh_index(retrieval.term_index(was), retrieval.fingerprints(was), now)
    return fresh.groupBy("citekey", "length").agg(F.count("term").alias("terms"), F.coalesce(F.sum(F.when(F.col("term").isNotNull(), F.col("tf"))), F.lit(0)).alias("tokens"))


_OUTCOMES = """o AS (SELECT doc_id, 'doc_' || doc_id AS citekey, CASE WHEN doc_id % 3 = 0 THEN CASE doc_id % 4 WHEN 0 THEN 'CUDA error: out of memory' WHEN 1 THEN 'Document timeout exceeded' ELSE 'no text' END END AS error,
  CASE WHEN doc_id % 9 = 0 THEN 'other' END AS category, CASE WHEN doc_id % 6 = 0 THEN 'stalled' END AS worker FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0),
j AS (SELECT *, CASE WHEN worker IS NOT NULL OR error LIKE 'CUDA%' THEN 'transient' ELSE 'deterministic' END AS kind,
  CASE WHEN category IS NOT NULL THEN category = 'timeout' ELSE coalesce(lower(error) LIKE '%document timeout%', FALSE) END AS timed_out FROM o)"""


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    what = F.when(i % 4 == 0, "CUDA error: out of memory").when(i % 4 == 1, "Document timeout exceeded").otherwise("no text")
    rows = _docs(spark, d).where("doc_id % 2 = 0 or doc_id % 3 = 0").select("doc_id", F.concat(F.lit("doc_"), i.cast("string")).alias("citekey"), F.when(i % 3 == 0, what).alias("error"), F.when(i % 9 == 0, "other").alias("category"), F.when(i % 6 == 0, "stalled").alias("worker"))
    return ledger.failure_kind(rows)


@_query(f"WITH {_OUTCOMES} SELECT citekey, kind, timed_out FROM j WHERE error IS NOT NULL")
def failure_kinds(spark: SparkSession, d: str) -> DataFrame:
    return _outcomes(spark, d).where("error is not null").select("citekey", "kind", "timed_out")


_AFTER = f"""{_OUTCOMES}, s AS (SELECT doc_id, 'doc_' || doc_id AS citekey, CASE doc_id % 5 WHEN 0 THEN 'no_pdf' WHEN 1 THEN 'parse_failed' ELSE 'discovered' END AS status FROM documents),
a AS (SELECT s.citekey, s.doc_id, CASE WHEN j.citekey IS NULL THEN status WHEN error IS NULL THEN 'parsed' ELSE 'parse_failed' END AS status, CASE WHEN j.citekey IS NULL THEN 'old/' || s.doc_id WHEN error IS NULL THEN 'new/' || s.doc_id ELSE 'old/' || s.doc_id END AS parsed_path,
  CASE WHEN j.citekey IS NULL THEN 'was' ELSE error END AS error, CASE WHEN j.citekey IS NULL THEN 'transient' WHEN error IS NOT NULL THEN kind END AS failure_kind FROM s LEFT JOIN j USING (citekey))"""


def _after(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    i = F.col("doc_id")
    status = F.when(i % 5 == 0, "no_pdf").when(i % 5 == 1, "parse_failed").otherwise("discovered")
    items = _docs(spark, d).select(F.concat(F.lit("doc_"), i.cast("string")).alias("citekey"), status.alias("status"), F.concat(F.lit("old/"), i.cast("string")).alias("parsed_path"), F.lit("was").alias("error"), F.lit("transient").alias("failure_kind"))
    ran = _outcomes(spark, d).withColumn("path", F.concat(F.lit("new/"), i.cast("string")))
    before = items.join(ran.select("citekey", F.lit(True).alias("needs_parse")), "citekey", "left").select("citekey", F.coalesce("needs_parse", F.lit(False)).alias("needs_parse"))
    return before, ledger.record_outcomes(items, ran)


@_query(f"WITH {_AFTER} SELECT citekey, status, parsed_path, error, failure_kind FROM a")
def ledger_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """The ledger after a run."""
    return _after(spark, d)[1]


@_query(f"""WITH {_AFTER} SELECT count(*) FILTER (WHERE j.citekey IS NOT NULL AND a.status = 'parsed') AS parsed, count(*) FILTER (WHERE j.citekey IS NOT NULL AND a.status = 'parse_failed') AS failed,
  count(*) FILTER (WHERE j.citekey IS NULL AND a.status <> 'no_pdf') AS unchanged, count(*) FILTER (WHERE a.status = 'no_pdf') AS no_pdf FROM a LEFT JOIN j USING (citekey)""")
def ledger_run_summary(spark: SparkSession, d: str) -> DataFrame:
    return ledger.run_summary(*_after(spark, d))


@_query("""SELECT l.doc_id, l.lang AS lang FROM documents l WHERE l.lang = 'fr'""")
def ledger_by_status(spark: SparkSession, d: str) -> DataFrame:
    """A status filter; the language stands for the status."""
    rows = _docs(spark, d).select("doc_id", F.col("lang").alias("status"))
    return ledger.by_status(rows, "fr").select("doc_id", F.col("status").alias("lang"))


# --- two runs side by side, and statistics -----------------------------------


@_query("""WITH l AS (SELECT doc_id AS citekey, coalesce(text, '') AS t FROM documents WHERE doc_id % 10 > 0),
r AS (SELECT doc_id AS citekey, CASE WHEN doc_id % 4 = 0 THEN replace(coalesce(text, ''), ' ', '  ') ELSE coalesce(text, '') END || CASE WHEN doc_id % 6 = 0 THEN ' x' ELSE '' END AS t FROM documents WHERE doc_id % 11 > 0)
SELECT coalesce(l.citekey, r.citekey) AS citekey, CASE WHEN r.citekey IS NULL THEN 'left' WHEN l.citekey IS NULL THEN 'right' ELSE 'both' END AS side, sha256(l.t) <> sha256(r.t) AS text_differs,
  len(regexp_extract_all(lower(l.t), '[a-z0-9]+')) <> len(regexp_extract_all(lower(r.t), '[a-z0-9]+')) AS words_differs FROM l FULL JOIN r ON l.citekey = r.citekey""")
def run_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Texts of two runs by digest and by number of words."""
    docs = _docs(spark, d).select(F.col("doc_id").alias("citekey"), F.coalesce("text", F.lit("")).alias("t"))
    other = F.concat(F.when(F.col("citekey") % 4 == 0, F.replace("t", F.lit(" "), F.lit("  "))).otherwise(F.col("t")), F.when(F.col("citekey") % 6 == 0, " x").otherwise(""))

    def marks(rows: DataFrame) -> DataFrame:
        return rows.select("citekey", F.sha2("t", 256).alias("text"), F.size(F.regexp_extract_all(F.lower("t"), F.lit("[a-z0-9]+"), F.lit(0))).alias("words"))

    return runs.compare(marks(docs.where("citekey % 10 > 0")), marks(docs.where("citekey % 11 > 0").withColumn("t", other)), ["text", "words"])


@_query("SELECT source, min(n_chars) AS best, quantile_cont(n_chars, 0.5) AS median, max(n_chars) AS worst FROM documents GROUP BY source")
def run_spread(spark: SparkSession, d: str) -> DataFrame:
    return runs.spread(_docs(spark, d), "source", "n_chars")


@_query("""WITH p AS (SELECT lang, CAST(len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS DOUBLE) AS x, CAST(n_chars AS DOUBLE) AS y FROM documents)
SELECT lang, round(CASE WHEN min(x) = max(x) THEN 0 ELSE regr_slope(y, x) END, 6) AS slope, round(CASE WHEN min(x) = max(x) THEN avg(y) ELSE regr_intercept(y, x) END, 4) AS intercept FROM p GROUP BY lang""")
def run_line_fit(spark: SparkSession, d: str) -> DataFrame:
    """Characters by words, a line for each language."""
    rows = _docs(spark, d).select("lang", F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\S+"), F.lit(0))).alias("words"), "n_chars")
    return runs.line_fit(rows, "lang", "words", "n_chars").select("lang", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@_query("""WITH r AS (SELECT source, CAST(n_chars AS DOUBLE) AS v, row_number() OVER (PARTITION BY source ORDER BY n_chars) AS i, count(*) OVER (PARTITION BY source) AS n FROM documents WHERE n_chars IS NOT NULL),
q AS (SELECT source, n, k, least(greatest(CAST(floor((n + 1) * k / 4.0) AS BIGINT), 1), n - 1) AS lo, (n + 1) * k / 4.0 AS place FROM (SELECT DISTINCT source, n FROM r), (VALUES (1), (3)) t(k)),
p AS (SELECT q.source, q.n, q.k, a.v + (b.v - a.v) * (place - lo) AS v FROM q JOIN r a ON a.source IS NOT DISTINCT FROM q.source AND a.i = lo JOIN r b ON b.source IS NOT DISTINCT FROM q.source AND b.i = lo + 1)
SELECT d.source, d.n, round(CASE WHEN d.n < 4 THEN 'inf'::DOUBLE ELSE max(CASE WHEN k = 3 THEN v END) * 2.5 - 1.5 * max(CASE WHEN k = 1 THEN v END) END, 6) AS fence FROM (SELECT source, count(*) AS n FROM documents WHERE n_chars IS NOT NULL GROUP BY 1) d LEFT JOIN p ON p.source IS NOT DISTINCT FROM d.source GROUP BY d.source, d.n""")
def run_upper_fence(spark: SparkSession, d: str) -> DataFrame:
    """Sizes beyond which a source's documents are outliers."""
    return runs.upper_fence(_docs(spark, d), "source", "n_chars").select("source", "n", F.round("fence", 6).alias("fence"))


# --- captions and messages ----------------------------------------------------

CAPTIONS = [["Fig. {id}a: {w}"], ["TABLE 2.{id} shows {w}"], ["scheme 3"], ["About Figure {id}"]]


@_query(f"""WITH c AS (SELECT doc_id, {one_of_sql(CAPTIONS)} AS caption, CASE WHEN doc_id % 3 > 0 THEN doc_id % 9 + 1 END AS page FROM documents)
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Figure ' || doc_id || 'a' WHEN 1 THEN 'Table 2.' || doc_id WHEN 2 THEN 'Scheme 3' ELSE CASE WHEN page IS NULL THEN 'an unplaced figure in [@doc_' || doc_id || ']' ELSE 'the figure on p.' || page END END
  || CASE WHEN doc_id % 4 = 3 AND page IS NULL THEN '' ELSE ' of [@doc_' || doc_id || ']' END || CASE WHEN doc_id % 4 < 3 THEN coalesce(', p.' || page, '') ELSE '' END AS cite FROM c""")
def figure_citations(spark: SparkSession, d: str) -> DataFrame:
    page = F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 9 + 1)
    rows = _docs(spark, d).select("doc_id", one_of(CAPTIONS).alias("caption"), page.alias("page"), F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("citekey"))
    return rows.select("doc_id", figure_citation("caption", "page", "citekey").alias("cite"))


@_query("""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z]+'), lambda x: x <> '')[1:12] AS w FROM documents),
u AS (SELECT doc_id, list_filter(w, lambda x, i: NOT list_contains(w[1:i - 1], x)) AS u FROM w)
SELECT doc_id, array_to_string(u[1:3], '; ') || CASE WHEN len(u) > 3 THEN ' (and ' || (len(u) - 3) || ' more)' ELSE '' END AS messages FROM u""")
def first_messages(spark: SparkSession, d: str) -> DataFrame:
    """The first three different messages of a list; a text's first twelve words stand for messages."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+"), lambda x: x != "")
    return _docs(spark, d).select("doc_id", first_errors(F.slice(words, 1, 12)).alias("messages"))


@_query("""SELECT DISTINCT unnest(['doe_' || doc_id, 'roe-x_' || (doc_id + 1), 'poe:y_1', 'doe_' || doc_id]) AS citekey FROM documents""")
def mentioned_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys that any file of any dossier names."""
    return dossier.mentioned([_files(spark, d, lines) for lines in (REJECTED, SECTIONS, EVIDENCE)])
