"""Queries on stored state: the ledger's runs, the vector store, topics, key sets, and the gate over all drafts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import page_count, search_tokens
from lectern.operators import citations, dossier, key_sets, retrieval, topics, vectors
from lectern.operators.ledger_table import ROWS, LedgerTable, sync
from lectern.operators.vector_store import VectorStore
from lectern.sources.versions import shared_folder

QUERIES: dict = {}
SQL: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _key(x) -> F.Column:
    return F.concat(F.lit("doc_"), x.cast("string"))


def _fresh(spark: SparkSession, label: str) -> str:
    """A folder of this run's own."""
    return shared_folder(spark, label, uuid.uuid4().hex)


# --- a run of the ledger: what was there, the bibliography of now, a parser ---

_RUN = r"""all_docs AS (SELECT doc_id, 'doc_' || doc_id AS citekey, lang, n_chars, CASE WHEN n_chars > 100 THEN sha256(coalesce(text, '')) END AS pdf_hash,
  CASE WHEN doc_id % 7 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'CUDA error: out of memory' ELSE 'no text' END END AS fails,
  length(regexp_replace(coalesce(text, ''), '\s+$', '')) - length(replace(regexp_replace(coalesce(text, ''), '\s+$', ''), chr(10), '')) + 1 AS pages FROM documents),
items AS (SELECT citekey, CASE WHEN quality = 1 THEN pdf_hash ELSE 'old' END AS old_hash, CASE WHEN toxic = 1 THEN 'parse_failed' WHEN pdf_hash IS NULL THEN 'no_pdf' ELSE 'parsed' END AS old_status,
  CASE WHEN n_chars % 2 = 0 THEN 'deterministic' END AS old_kind, n_chars % 3 <> 0 AS present, 'old/' || doc_id AS old_path FROM labels JOIN all_docs USING (doc_id)),
bib AS (SELECT * FROM all_docs WHERE lang <> 'fr'),
j AS (SELECT coalesce(bib.citekey, items.citekey) AS citekey, bib.citekey IS NOT NULL AS listed, items.citekey IS NOT NULL AS there, bib.pdf_hash, old_hash, old_status, old_kind, old_path, fails, pages,
  bib.citekey IS NOT NULL AND (items.citekey IS NULL OR bib.pdf_hash IS DISTINCT FROM old_hash) AS changed,
  bib.pdf_hash IS NOT NULL AND ((old_status = 'parsed' AND NOT present) OR (old_status = 'parse_failed' AND coalesce(old_kind, '') <> 'deterministic')) AS again
  FROM bib FULL JOIN items ON bib.citekey = items.citekey),
s AS (SELECT *, CASE WHEN NOT listed THEN false WHEN changed THEN pdf_hash IS NOT NULL ELSE coalesce(again, false) END AS queued FROM j),
after AS (SELECT citekey, listed, queued, fails, pages, CASE WHEN listed THEN pdf_hash ELSE old_hash END AS pdf_hash,
  CASE WHEN queued AND fails IS NOT NULL THEN 'parse_failed' WHEN queued THEN 'parsed' WHEN changed THEN 'no_pdf' ELSE old_status END AS status,
  CASE WHEN queued AND fails IS NULL THEN 'new/' || substr(citekey, 5) ELSE old_path END AS parsed_path, CASE WHEN queued THEN fails END AS error,
  CASE WHEN NOT queued THEN old_kind WHEN fails IS NULL THEN NULL WHEN fails LIKE 'CUDA%' THEN 'transient' ELSE 'deterministic' END AS failure_kind FROM s)"""


def _run(spark: SparkSession, d: str) -> tuple[LedgerTable, dict]:
    i = F.col("doc_id")
    docs = _t(spark, d, "documents").select("doc_id", _key(i).alias("citekey"), "lang", "n_chars", "text", F.when(F.col("n_chars") > 100, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("pdf_hash"))
    was = _t(spark, d, "labels").select("doc_id", "quality", "toxic").join(docs.drop("text"), "doc_id")
    status = F.when(F.col("toxic") == 1, "parse_failed").when(F.col("pdf_hash").isNull(), "no_pdf").otherwise("parsed")
    old = was.select("citekey", F.when(F.col("quality") == 1, F.col("pdf_hash")).otherwise("old").alias("pdf_hash"), status.alias("status"), F.concat(F.lit("old/"), i.cast("string")).alias("parsed_path"), F.lit(None).cast("string").alias("error"), F.when(F.col("n_chars") % 2 == 0, "deterministic").alias("failure_kind"))
    table = LedgerTable(spark, _fresh(spark, "ledger"), slices=16)
    table.change(None, lambda _: old.select([c.split()[0] for c in ROWS.split(", ")]))

    def parse(queue: DataFrame) -> DataFrame:
        fails = F.when(i % 7 == 0, F.when(i % 2 == 0, "CUDA error: out of memory").otherwise("no text"))
        return queue.select("citekey").join(docs, "citekey").select("citekey", F.concat(F.lit("new/"), i.cast("string")).alias("path"), fails.alias("error"), *(F.lit(None).cast("string").alias(c) for c in ("category", "worker")), page_count("text", "\n").alias("pages"))

    present = was.where("n_chars % 3 <> 0").select("citekey")
    return table, sync(table, docs.where("lang <> 'fr'").select("citekey", "pdf_hash"), parse, _fresh(spark, "outcomes"), present)


@_query(f"WITH {_RUN} SELECT citekey, pdf_hash, status, parsed_path, error, failure_kind FROM after")
def ledger_sync(spark: SparkSession, d: str) -> DataFrame:
    """The stored ledger after a run: labelled documents were there, French ones are no longer listed, each seventh fails."""
    return _run(spark, d)[0].rows()


@_query(f"""WITH {_RUN} SELECT count(*) FILTER (WHERE queued AND fails IS NULL) AS parsed, count(*) FILTER (WHERE queued AND fails IS NOT NULL) AS failed, count(*) FILTER (WHERE listed AND NOT queued AND status <> 'no_pdf') AS unchanged,
  count(*) FILTER (WHERE listed AND status = 'no_pdf') AS no_pdf, count(*) FILTER (WHERE NOT listed) AS stale, count(*) FILTER (WHERE status = 'parse_failed' AND coalesce(failure_kind, '') <> 'deterministic') AS transient,
  count(*) FILTER (WHERE status = 'parse_failed' AND failure_kind = 'deterministic') AS deterministic, CAST(coalesce(sum(pages) FILTER (WHERE queued AND fails IS NULL), 0) AS BIGINT) AS pages FROM after""")
def sync_counters(spark: SparkSession, d: str) -> DataFrame:
    """The run's counters, taken while its outcomes were written."""
    got = _run(spark, d)[1]
    names = ["parsed", "failed", "unchanged", "no_pdf", "stale", "transient", "deterministic", "pages"]
    return spark.createDataFrame([tuple(got[n] for n in names)], ", ".join(f"{n} long" for n in names))


# --- the vector store ---------------------------------------------------------


@_query("""WITH t AS (SELECT 'doc_' || doc_id AS citekey, doc_id % 3 AS m, string_split_regex(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \\t\\n\\x0b\\f\\r]+') AS w FROM documents)
SELECT citekey, CAST(ceil(len(w) / 160.0) AS BIGINT) AS chunks, m = 0 AS kept FROM t WHERE array_to_string(w, '') <> ''""")
def chunk_store(spark: SparkSession, d: str) -> DataFrame:
    """Chunks in the store after a refresh, and which texts kept theirs: a third was stored as it is, a third in another form, a third not at all."""
    docs = _t(spark, d, "documents").select("doc_id", _key(F.col("doc_id")).alias("citekey"), "text")
    store = VectorStore(spark, _fresh(spark, "vectors"), "hashed/8", slices=16, parts=4)
    store.refresh(docs.where("doc_id % 3 < 2").select("citekey", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise("an older text").alias("text")), lambda c: F.transform(vectors.hashed_vector(c, 8), lambda x: x + 1))
    store.refresh(docs.select("citekey", "text"), lambda c: vectors.hashed_vector(c, 8))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    return store.rows().groupBy("citekey").agg(F.count("*").alias("chunks"), (F.max(norm) > 1.5).alias("kept"))


# --- topics -------------------------------------------------------------------


@_query()
def density_topics(spark: SparkSession, d: str) -> DataFrame:
    """The topic of every vector; -1 is none."""
    return topics.density_topics(_t(spark, d, "embeddings").select("vec_id", "embedding"))


_TOKENS = "list_filter(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN ('a','an','the','of','on','in','for','and','to','with','is','are','be','this','that','as','by','from','at'))"


@_query(f"""WITH t AS (SELECT CAST(label AS INTEGER) AS topic, doc_id, {_TOKENS} AS w FROM embeddings JOIN documents ON doc_id = vec_id),
size AS (SELECT topic, count(*) AS n, sum(len(w)) AS words FROM t GROUP BY topic), mean AS (SELECT avg(words) AS m FROM size),
tf AS (SELECT topic, term, count(*) AS tf FROM (SELECT topic, unnest(w) AS term FROM t) GROUP BY ALL), total AS (SELECT term, sum(tf) AS f FROM tf GROUP BY term),
r AS (SELECT topic, term, row_number() OVER (PARTITION BY topic ORDER BY round(tf / words * ln(1 + m / f), 9) DESC, term) AS rank FROM tf JOIN total USING (term) JOIN size USING (topic), mean)
SELECT topic, n AS count, concat_ws('_', topic, (SELECT string_agg(term, '_' ORDER BY rank) FROM r WHERE r.topic = size.topic AND rank <= 4)) AS name FROM size""")
def topic_names(spark: SparkSession, d: str) -> DataFrame:
    """Topics by name; the vectors' labels are the topics of the documents of their numbers."""
    rows = _t(spark, d, "embeddings").select(F.col("label").cast("int").alias("topic"), F.col("vec_id").alias("doc_id")).join(_t(spark, d, "documents").select("doc_id", "text"), "doc_id")
    terms = rows.select("topic", F.col("doc_id").alias("doc"), F.explode_outer(search_tokens(F.coalesce("text", F.lit("")))).alias("term")).groupBy("topic", "doc", "term").agg(F.count("term").alias("tf"))
    return topics.topic_names(terms)


# --- sets of keys -------------------------------------------------------------


@_query("""WITH n AS (SELECT citekey, row_number() OVER (ORDER BY citekey) - 1 AS n FROM (SELECT DISTINCT 'doc_' || doc_id AS citekey FROM documents)),
said AS (SELECT DISTINCT source AS dossier, 'doc_' || CASE WHEN quality = 1 THEN doc_id * 2 ELSE doc_id END AS citekey FROM labels JOIN documents USING (doc_id)),
e AS (SELECT dossier, n FROM said JOIN n USING (citekey) UNION ALL SELECT DISTINCT source, (SELECT count(*) FROM n) FROM documents),
g AS (SELECT dossier, coalesce(lag(n) OVER (PARTITION BY dossier ORDER BY n) + 1, 0) AS a, n - 1 AS b FROM e)
SELECT dossier, x.citekey AS from_key, y.citekey AS to_key, b - a + 1 AS n FROM g JOIN n x ON x.n = a JOIN n y ON y.n = b WHERE a <= b""")
def drift_unconsidered_keys(spark: SparkSession, d: str) -> DataFrame:
    """The keys that each dossier mentions nowhere, as runs in key order. Sources are dossiers, also those that mention nothing."""
    docs = _t(spark, d, "documents").select("doc_id", F.col("source").alias("dossier"))
    said = _t(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id").select("dossier", _key(F.when(F.col("quality") == 1, F.col("doc_id") * 2).otherwise(F.col("doc_id"))).alias("citekey"))
    return key_sets.unconsidered(docs.select(_key(F.col("doc_id")).alias("citekey")), docs.select("dossier"), said)


# --- the gate over all drafts -------------------------------------------------

_STRAY = r"""x AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '(^|[^A-Za-z0-9._%+\-\\])-?@([A-Za-z][A-Za-z0-9_-]*)', 2)) AS citekey FROM documents),
g AS (SELECT d.doc_id, count(x.citekey) AS total, count(x.citekey) FILTER (WHERE x.citekey NOT IN (SELECT 'doc_' || doc_id FROM documents)) AS unknown FROM documents d LEFT JOIN x USING (doc_id) GROUP BY d.doc_id)"""


def _mentions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = _t(spark, d, "documents")
    drafts = docs.select(F.col("doc_id").alias("draft_id"), F.coalesce("text", F.lit("")).alias("text"))
    return citations.cited(drafts), retrieval.corpus(docs), drafts


@_query(f"WITH {_STRAY} SELECT doc_id AS draft_id, total, unknown, unknown = 0 AS ok FROM g")
def gate_all_drafts(spark: SparkSession, d: str) -> DataFrame:
    """What each document would cite as a draft: few hold anything like a citation, and those without pass."""
    return citations.gate_summary(*_mentions(spark, d))


@_query(f"WITH {_STRAY} SELECT count(*) AS drafts, CAST(sum(total) AS BIGINT) AS citations, CAST(sum(unknown) AS BIGINT) AS unknown, count(*) FILTER (WHERE unknown > 0) AS failing, sum(unknown) = 0 AS passes FROM g")
def gate_verdict(spark: SparkSession, d: str) -> DataFrame:
    return citations.verdict(*_mentions(spark, d))


# --- dossiers that hold whole texts -------------------------------------------

_OWN_LINES = r"string_split(coalesce(text, ''), chr(10))"


@_query(rf"""WITH l AS (SELECT doc_id, {_OWN_LINES} AS l FROM documents)
SELECT doc_id AS dossier, 'evidence.md' AS name, 'blocks' AS kind, CAST(len(list_filter(l, lambda t: starts_with(t, '## '))) + 1 AS BIGINT) AS entries FROM l
UNION ALL SELECT doc_id, 'rejected.md', 'rows', len(list_filter(l, lambda t: starts_with(ltrim(t, ' '), '|') AND NOT regexp_full_match(t, '[|\-: \t]*'))) + len(l) FROM l
UNION ALL SELECT doc_id, 'scope.md', 'prose', len(list_filter(l, lambda t: regexp_matches(t, '\S') AND NOT starts_with(ltrim(t, ' '), '#'))) FROM l""")
def dossier_file_counts(spark: SparkSession, d: str) -> DataFrame:
    """Entries of three files a document: evidence that holds its text, a table with a row for each of its lines beside it, a scope that is its text."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("dossier"), F.coalesce("text", F.lit("")).alias("text"))
    table = F.array_join(F.transform(F.split("text", "\n", -1), lambda t: F.concat(F.lit("| `"), F.sha1(t), F.lit("` | x | y |"))), "\n")
    files = [("evidence.md", F.concat(F.lit("## `a_1`\n<!-- a note\n## not a block -->\n"), F.col("text"))), ("rejected.md", F.concat(F.lit("| key | x | y |\n|---|---|---|\n"), table, F.lit("\n"), F.col("text"))), ("scope.md", F.concat(F.lit("# Scope\n\n"), F.col("text")))]
    rows = docs.select("dossier", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), t.alias("text")) for n, t in files))).alias("f"))
    return dossier.file_counts(rows.select("dossier", "f.name", "f.text"))
