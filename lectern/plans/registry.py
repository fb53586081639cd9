"""Queries over the driver's tables, and the SQL that gives the same rows.

``documents`` stand for the ledger's items: citekey ``doc_<id>``, title the
first line. ``benchmark`` items are search queries, source pages and phrases;
``labels`` say what a dossier cites (quality 1) and rejects (0), where a
dossier is a document's source. Drafts are a document's text followed by
citation markers whose keys are computed from its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.text import CLAIM_STOPWORDS, SEARCH_STOPWORDS, letter_runs, page_count, pages, word_chunks
from lectern.operators import citations, dossier, ledger, overlap, retrieval, vectors
from lectern.operators.term_index import TermIndex
from lectern.plans import corpus, reports, upkeep, writing
from lectern.sources.versions import shared_folder, state_of

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


def _items(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.corpus(_t(spark, d, "documents"))


def _searches(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _index(spark: SparkSession, d: str) -> tuple[TermIndex, dict]:
    """The stored index of all items, and its version: made by the first query that asks, refreshed when the documents' files change."""
    index = TermIndex(spark, shared_folder(spark, "term-index", d))
    return index, index.refresh(_items(spark, d), state_of(spark, f"{d}/documents.parquet"))


def _ranked(spark: SparkSession, d: str, k: int) -> DataFrame:
    index, now = _index(spark, d)
    return index.search(_searches(spark, d), k, now)


def _key(x) -> F.Column:
    return F.concat(F.lit("doc_"), x.cast("string"))


_STOP = ", ".join(f"'{w}'" for w in SEARCH_STOPWORDS)
_CLAIM_STOP = ", ".join(f"'{w}'" for w in CLAIM_STOPWORDS)
_TOKENS = "list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN (" + _STOP + "))"
_CLAIM_WORDS = "list_distinct(list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda w: length(w) > 2 AND w NOT IN (" + _CLAIM_STOP + ")))"
_INDEX = f"""items AS (SELECT 'doc_' || doc_id AS citekey, coalesce(text, '') AS text, split_part(coalesce(text, ''), chr(10), 1) AS title FROM documents),
toks AS (SELECT citekey, {_TOKENS.format("title || chr(10) || text")} AS w FROM items),
tf AS (SELECT citekey, len(w) AS length, term, count(*) AS tf FROM (SELECT citekey, w, unnest(w) AS term FROM toks) GROUP BY ALL),
stats AS (SELECT count(*) AS n, avg(len(w)) AS avgdl FROM toks),
df AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term)"""
_BM25 = (
    _INDEX
    + f""", q AS (SELECT item_id AS query_id, unnest(list_distinct({_TOKENS.format("text")})) AS term FROM benchmark),
scored AS (SELECT query_id, citekey, round(sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / avgdl))), 6) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), stats GROUP BY query_id, citekey),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, citekey) AS rank FROM scored WHERE score > 0)"""
)


@_query(f"WITH {_BM25} SELECT query_id, citekey, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 15")
def bm25_batch_topk(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, 15)


@_query()
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten best for each search, with a snippet of the best window."""
    items, searches = _items(spark, d), _searches(spark, d)
    hits = _ranked(spark, d, 10)
    return retrieval.snippets(hits, items, searches)


@_query()
def evidence_windows(spark: SparkSession, d: str) -> DataFrame:
    """Two windows of 600 characters from the best document of each search."""
    items, searches = _items(spark, d), _searches(spark, d)
    hits = _ranked(spark, d, 1)
    return retrieval.snippets(hits, items, searches, 600, 2)


@_query(f"WITH {_INDEX} SELECT term, df, CAST(cf AS BIGINT) AS cf, round(ln((n - df + 0.5) / (df + 0.5) + 1), 6) AS idf FROM df, stats")
def doc_freq(spark: SparkSession, d: str) -> DataFrame:
    index, now = _index(spark, d)
    return index.terms(now).withColumn("idf", F.round(F.log((now["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1), 6))


@_query(f"WITH {_INDEX} SELECT citekey, CAST(len(w) AS INTEGER) AS length, CAST(len(list_distinct(w)) AS BIGINT) AS n_terms FROM toks")
def doc_lengths(spark: SparkSession, d: str) -> DataFrame:
    index, now = _index(spark, d)
    return index.forward(now).groupBy("citekey", "length").agg(F.count("term").alias("n_terms"))


@_query(f"WITH {_INDEX} SELECT n, round(avgdl, 6) AS avgdl FROM stats")
def corpus_stats(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.corpus_stats(retrieval.term_index(_items(spark, d))).select("n", F.round("avgdl", 6).alias("avgdl"))


@_query(r"""WITH r AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '\p{L}+') AS w FROM documents),
s AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: length(x) > 20)) AS k FROM r)
SELECT doc_id, CAST(n AS INTEGER) AS n_tokens, CASE WHEN n = 0 THEN 0.0 ELSE round(k / n, 6) END AS ratio, n >= 200 AND k / n > 0.01 AS warn FROM s""")
def doc_quality_guard(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "documents").select("doc_id", letter_runs("text").alias("w")).select("doc_id", F.size("w").alias("n_tokens"), F.size(F.filter("w", lambda x: F.length(x) > 20)).alias("k"))
    share = F.when(F.col("n_tokens") == 0, 0.0).otherwise(F.col("k") / F.col("n_tokens"))
    return rows.select("doc_id", "n_tokens", F.round(share, 6).alias("ratio"), ((F.col("n_tokens") >= 200) & (share > 0.01)).alias("warn"))


@_query("SELECT doc_id, CAST(length(t) - length(replace(t, chr(10), '')) + 1 AS INTEGER) AS n_pages FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '\\s+$', '') AS t FROM documents)")
def page_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pages end at line feeds here."""
    return _t(spark, d, "documents").select("doc_id", page_count("text", "\n").alias("n_pages"))


@_query(f"""WITH p AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS page FROM p)
SELECT doc_id, CAST(page AS INTEGER) AS page, CAST(len({_CLAIM_WORDS.format("t")}) AS INTEGER) AS n_words FROM x WHERE trim(t, ' ') <> ''""")
def page_terms(spark: SparkSession, d: str) -> DataFrame:
    from lectern.functions.text import distinctive_words

    rows = _t(spark, d, "documents").select("doc_id", F.explode(pages("text", "\n")).alias("p"))
    return rows.select("doc_id", "p.page", F.size(distinctive_words("p.text")).alias("n_words"))


@_query(r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') AS w FROM documents),
c AS (SELECT doc_id, w, unnest(range(0, CAST(ceil(len(w) / 160.0) AS BIGINT))) AS i FROM w)
SELECT doc_id, CAST(i AS INTEGER) AS i, sha256(array_to_string(w[i * 160 + 1 : i * 160 + 200], ' ')) AS chunk_hash FROM c""")
def chunk_words(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "documents").select("doc_id", F.explode(word_chunks("text")).alias("c"))
    return rows.select("doc_id", "c.i", F.sha2("c.chunk", 256).alias("chunk_hash"))


@_query("SELECT sha256(coalesce(text, '')) AS text_hash, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_text_dups(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    return docs.groupBy("text_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@_query(r"""WITH i AS (SELECT 'doc_' || doc_id AS citekey, split_part(coalesce(text, ''), chr(10), 1) AS title, left(sha256(coalesce(text, '')), 16) AS doi FROM documents),
k AS (SELECT 'doi' AS reason, doi AS value, citekey FROM i UNION ALL
  SELECT 'title', trim(regexp_replace(regexp_replace(lower(translate(title, '{}', '')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), citekey FROM i),
g AS (SELECT reason, value, string_agg(DISTINCT citekey, ',' ORDER BY citekey) AS citekeys, count(DISTINCT citekey) AS n FROM k WHERE value <> '' GROUP BY reason, value)
SELECT citekeys, min(reason) AS reason FROM g WHERE n > 1 GROUP BY citekeys""")
def dedup_groups(spark: SparkSession, d: str) -> DataFrame:
    """The DOI stands for the text's digest here."""
    items = _items(spark, d).withColumn("doi", F.concat(F.lit("https://doi.org/"), F.substring(F.sha2("text", 256), 1, 16)))
    return ledger.duplicate_groups(items)


_GRAMS = """s AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM benchmark),
sg AS (SELECT item_id AS page, array_to_string(w[i + 1 : i + 8], ' ') AS gram FROM (SELECT item_id, w, unnest(range(0, len(w) - 7)) AS i FROM s WHERE len(w) >= 8)),
t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
dg AS (SELECT doc_id AS draft_id, i AS pos, array_to_string(w[i + 1 : i + 8], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(0, len(w) - 7)) AS i FROM t WHERE len(w) >= 8))"""


@_query(f"""WITH {_GRAMS}, f AS (SELECT gram, min(page) AS page FROM sg GROUP BY gram),
h AS (SELECT draft_id, pos, page, pos - row_number() OVER (PARTITION BY draft_id ORDER BY pos) AS island FROM dg JOIN f USING (gram))
SELECT draft_id, CAST(min(pos) AS INTEGER) AS start, count(*) + 7 AS n_words, arg_min(page, pos) AS page FROM h GROUP BY draft_id, island""")
def verbatim_runs(spark: SparkSession, d: str) -> DataFrame:
    drafts = _t(spark, d, "documents").select(F.col("doc_id").alias("draft_id"), "text")
    return overlap.verbatim_runs(drafts, _t(spark, d, "benchmark").select(F.col("item_id").alias("page"), "text"))


@_query(f"WITH {_GRAMS} SELECT draft_id, page, count(DISTINCT gram) AS shared FROM dg JOIN sg USING (gram) GROUP BY draft_id, page")
def overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    drafts = _t(spark, d, "documents").select(F.col("doc_id").alias("draft_id"), "text")
    return overlap.shared_grams(drafts, _t(spark, d, "benchmark").select(F.col("item_id").alias("page"), "text"))


@_query("""WITH p AS (SELECT item_id AS phrase_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'), lambda w: length(w) > 3) AS w FROM benchmark),
pw AS (SELECT phrase_id, greatest(len(w), 1) AS n, unnest(w) AS word FROM p),
d AS (SELECT doc_id AS page, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'))) AS word FROM documents),
h AS (SELECT phrase_id, page, round(count(*) / any_value(n), 6) AS score FROM pw JOIN d USING (word) GROUP BY phrase_id, page),
r AS (SELECT *, row_number() OVER (PARTITION BY phrase_id ORDER BY score DESC, page DESC) AS rank FROM h)
SELECT phrase_id, page, score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 4""")
def locate_pages(spark: SparkSession, d: str) -> DataFrame:
    return overlap.locate(_t(spark, d, "benchmark").select(F.col("item_id").alias("phrase_id"), "text"), _t(spark, d, "documents").select(F.col("doc_id").alias("page"), "text"))


_SUPPORT = f"""l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
c AS (SELECT doc_id AS claim_id, {_CLAIM_WORDS.format("l[-1]")} AS cw FROM l),
p AS (SELECT doc_id AS claim_id, i AS ord, {_CLAIM_WORDS.format("l[i + 1]")} AS pw FROM (SELECT doc_id, l, unnest(range(0, len(l) - 1)) AS i FROM l WHERE len(l) > 1)),
s AS (SELECT claim_id, ord, CASE WHEN len(cw) > 0 AND pw IS NOT NULL THEN len(list_intersect(cw, pw)) / len(cw) ELSE 0.0 END AS share FROM c LEFT JOIN p USING (claim_id)),
b AS (SELECT claim_id, round(max(share), 6) AS score, arg_max(ord, share * 1000000000 - coalesce(ord, 0) / 1000.0) AS ord FROM s GROUP BY claim_id)"""


def _support(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("l"))
    claims = lines.select(F.col("doc_id").alias("claim_id"), F.col("doc_id").alias("citekey"), F.element_at("l", -1).alias("claim"))
    passages = lines.select(F.col("doc_id").alias("citekey"), F.posexplode(F.slice("l", F.lit(1), F.size("l") - 1)).alias("ord", "text"))
    return citations.support(claims, passages)


@_query(f"WITH {_SUPPORT} SELECT claim_id, score, CASE WHEN score > 0 THEN CAST(ord AS INTEGER) END AS passage FROM b")
def claim_support(spark: SparkSession, d: str) -> DataFrame:
    """How well each document's last line is supported by one of its others."""
    return _support(spark, d)


@_query(f"WITH {_SUPPORT} SELECT CASE WHEN score < 0.2 THEN 'none' WHEN score < 0.5 THEN 'weak' ELSE 'supported' END AS band, count(*) AS n FROM b GROUP BY 1")
def support_bands(spark: SparkSession, d: str) -> DataFrame:
    return _support(spark, d).groupBy(citations.band().alias("band")).agg(F.count("*").alias("n"))


def _drafts(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents")
    marks = F.format_string(" `@code_span` [@doc_%d; @doc_%d] and \\citep[p. 2]{doc_%d, doc_%d} x@doc_0", F.col("doc_id") * 3, F.col("doc_id") + 1, F.col("doc_id"), F.col("doc_id") * 3)
    return docs.select(F.col("doc_id").alias("draft_id"), F.concat(F.coalesce("text", F.lit("")), marks).alias("text"))


_DRAFTS = r"""k AS (SELECT doc_id, length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS line, unnest(['doc_' || doc_id * 3, 'doc_' || (doc_id + 1), 'doc_' || doc_id, 'doc_' || doc_id * 3]) AS citekey, unnest([1, 2, 3, 4]) AS ord FROM documents),
stray AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '(^|[^A-Za-z0-9._%+\-\\])-?@([A-Za-z][A-Za-z0-9_-]*)', 2) AS s FROM documents),
known AS (SELECT 'doc_' || doc_id AS citekey FROM documents)"""


@_query(f"WITH {_DRAFTS} SELECT doc_id AS draft_id, CAST(line AS INTEGER) AS line, citekey FROM k WHERE citekey NOT IN (SELECT citekey FROM known) UNION ALL SELECT doc_id, NULL, unnest(s) FROM stray")
def gate_unknown(spark: SparkSession, d: str) -> DataFrame:
    return citations.gate(citations.cited(_drafts(spark, d)), _items(spark, d)).select("draft_id", "line", "citekey")


@_query(f"WITH {_DRAFTS} SELECT doc_id AS draft_id, count(*) AS total, count(*) FILTER (WHERE citekey NOT IN (SELECT citekey FROM known)) AS unknown, count(*) FILTER (WHERE citekey NOT IN (SELECT citekey FROM known)) = 0 AS ok FROM k GROUP BY doc_id")
def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    return citations.gate_summary(citations.cited(_drafts(spark, d)), _items(spark, d))


@_query(f"WITH {_DRAFTS} SELECT doc_id AS draft_id, citekey, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first) AS INTEGER) AS number FROM (SELECT doc_id, citekey, min(ord) AS first FROM k GROUP BY ALL)")
def ref_numbering(spark: SparkSession, d: str) -> DataFrame:
    return citations.numbering(citations.cited(_drafts(spark, d)))


@_query(r"""WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id AS draft_id, unnest(l) AS t, unnest(range(1, len(l) + 1)) AS line, len(l) AS last FROM l),
h AS (SELECT draft_id, t AS title, line, last FROM x WHERE len(regexp_extract_all(t, '\S+')) BETWEEN 1 AND 6)
SELECT draft_id, title, CAST(line AS INTEGER) AS start, CAST(coalesce(lead(line) OVER (PARTITION BY draft_id ORDER BY line) - 1, last) AS INTEGER) AS stop FROM h""")
def outline_sections(spark: SparkSession, d: str) -> DataFrame:
    """Lines of one to six words count as headings."""
    rows = _t(spark, d, "documents").select(F.col("doc_id").alias("draft_id"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("i", "t"))
    short = F.size(F.regexp_extract_all("t", F.lit(r"\S+"), F.lit(0))).between(1, 6)
    return citations.outline(rows.select("draft_id", (F.col("i") + 1).alias("line"), F.when(short, F.col("t")).alias("title")))


_COVER = f"""WITH {_BM25}, cand AS (SELECT DISTINCT citekey FROM ranked WHERE rank <= 5), cit AS (SELECT DISTINCT 'doc_' || doc_id AS citekey FROM labels WHERE quality = 1),
x AS (SELECT coalesce(cand.citekey, cit.citekey) AS citekey, cand.citekey IS NOT NULL AS candidate, cit.citekey IS NOT NULL AS cited FROM cand FULL JOIN cit ON cand.citekey = cit.citekey)"""


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    hits = _ranked(spark, d, 5)
    return retrieval.coverage(hits, _t(spark, d, "labels").where("quality = 1").select(_key(F.col("doc_id")).alias("citekey")))


@_query(f"{_COVER} SELECT count(*) FILTER (WHERE candidate) AS candidates, count(*) FILTER (WHERE cited) AS cited, round(100.0 * count(*) FILTER (WHERE candidate AND cited) / nullif(count(*) FILTER (WHERE candidate), 0), 6) AS pct FROM x")
def coverage_pct(spark: SparkSession, d: str) -> DataFrame:
    both = F.count_if(F.col("candidate") & F.col("cited"))
    pct = F.round(100.0 * both / F.nullif(F.count_if("candidate"), F.lit(0)), 6)
    return _coverage(spark, d).agg(F.count_if("candidate").alias("candidates"), F.count_if("cited").alias("cited"), pct.alias("pct"))


@_query(f"{_COVER} SELECT citekey, CASE WHEN candidate THEN 'uncited' ELSE 'outside' END AS gap FROM x WHERE candidate <> cited")
def coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    return _coverage(spark, d).where("candidate <> cited").select("citekey", F.when(F.col("candidate"), "uncited").otherwise("outside").alias("gap"))


_LEDGER = """bib AS (SELECT doc_id, 'doc_' || doc_id AS citekey, CASE WHEN n_chars > 100 THEN sha256(coalesce(text, '')) END AS pdf_hash FROM documents),
items AS (SELECT bib.citekey, CASE WHEN quality = 1 THEN pdf_hash ELSE 'old' END AS old_hash, CASE WHEN toxic = 1 THEN 'parse_failed' WHEN pdf_hash IS NULL THEN 'no_pdf' ELSE 'parsed' END AS old_status,
  CASE WHEN n_chars % 2 = 0 THEN 'deterministic' END AS failure_kind, n_chars % 3 <> 0 AS output_present FROM labels JOIN documents USING (doc_id) JOIN bib USING (doc_id))"""


def _bib(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", _key(F.col("doc_id")).alias("citekey"), "n_chars", F.when(F.col("n_chars") > 100, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("pdf_hash"))


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "labels").join(_bib(spark, d), "doc_id")
    status = F.when(F.col("toxic") == 1, "parse_failed").when(F.col("pdf_hash").isNull(), "no_pdf").otherwise("parsed")
    return rows.select("citekey", F.when(F.col("quality") == 1, F.col("pdf_hash")).otherwise("old").alias("old_hash"), status.alias("old_status"), F.when(F.col("n_chars") % 2 == 0, "deterministic").alias("failure_kind"), (F.col("n_chars") % 3 != 0).alias("output_present"))


@_query(f"""WITH {_LEDGER},
j AS (SELECT bib.citekey, pdf_hash IS NOT NULL AS has, items.citekey IS NULL OR pdf_hash IS DISTINCT FROM old_hash AS changed, old_status,
  pdf_hash IS NOT NULL AND ((old_status = 'parsed' AND NOT output_present) OR (old_status = 'parse_failed' AND coalesce(failure_kind, '') <> 'deterministic')) AS again FROM bib LEFT JOIN items USING (citekey))
SELECT citekey, CASE WHEN changed THEN has ELSE again END AS needs_parse, CASE WHEN changed THEN CASE WHEN has THEN 'discovered' ELSE 'no_pdf' END WHEN again THEN 'discovered' ELSE old_status END AS status FROM j""")
def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    return ledger.decide(_bib(spark, d).select("citekey", "pdf_hash"), _ledger(spark, d))


@_query("SELECT 'doc_' || l.doc_id AS citekey FROM labels l WHERE l.doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def ledger_stale(spark: SparkSession, d: str) -> DataFrame:
    """The bibliography keeps only English entries."""
    bib = _t(spark, d, "documents").where("lang = 'en'").select(_key(F.col("doc_id")).alias("citekey"))
    return ledger.stale(_t(spark, d, "labels").select(_key(F.col("doc_id")).alias("citekey")), bib)


@_query(f"WITH {_LEDGER} SELECT old_status AS status, count(*) AS n FROM items GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return _ledger(spark, d).groupBy(F.col("old_status").alias("status")).agg(F.count("*").alias("n"))


@_query(f"WITH {_LEDGER} SELECT coalesce(failure_kind, 'transient') AS kind, count(*) AS n FROM items WHERE old_status = 'parse_failed' GROUP BY 1")
def failure_counts(spark: SparkSession, d: str) -> DataFrame:
    return ledger.failure_counts(_ledger(spark, d).withColumnRenamed("old_status", "status"))


@_query("""WITH k AS (SELECT DISTINCT 'doc_' || doc_id AS citekey FROM documents),
p AS (SELECT left(sha256(citekey), 3) AS bucket, count(*) AS n, sha256(string_agg(citekey, chr(10) ORDER BY citekey)) AS digest FROM k GROUP BY 1)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n, left(sha256(coalesce(string_agg(digest, chr(10) ORDER BY bucket), '')), 12) AS digest FROM p""")
def corpus_digest(spark: SparkSession, d: str) -> DataFrame:
    return ledger.digest(_items(spark, d))


_DOSSIER = f"""{_BM25}, known AS (SELECT 'doc_' || doc_id AS citekey FROM documents),
cited AS (SELECT DISTINCT source AS dossier, 'doc_' || doc_id * 2 AS citekey FROM labels JOIN documents USING (doc_id) WHERE quality = 1),
rejected AS (SELECT DISTINCT source AS dossier, 'doc_' || doc_id AS citekey, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'off topic' END AS reason FROM labels JOIN documents USING (doc_id) WHERE quality = 0),
hits AS (SELECT dossier, citekey, array_to_string(list_sort(list(DISTINCT query_id)), ',') AS queries FROM (SELECT 'src' || query_id % 20 AS dossier, query_id, citekey FROM ranked WHERE rank <= 15) GROUP BY ALL)"""


def _dossiers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = _t(spark, d, "labels").join(_t(spark, d, "documents").select("doc_id", F.col("source").alias("dossier")), "doc_id")
    cited = rows.where("quality = 1").select("dossier", _key(F.col("doc_id") * 2).alias("citekey")).distinct()
    rejected = rows.where("quality = 0").select("dossier", _key(F.col("doc_id")).alias("citekey"), F.when(F.col("toxic") == 1, "toxic").otherwise("off topic").alias("reason")).distinct()
    return cited, rejected


def _matches(spark: SparkSession, d: str) -> DataFrame:
    hits = _ranked(spark, d, 15)
    return hits.select(F.concat(F.lit("src"), (F.col("query_id") % 20).cast("string")).alias("dossier"), "query_id", "citekey")


@_query(f"WITH {_DOSSIER} SELECT dossier, citekey FROM cited WHERE citekey NOT IN (SELECT citekey FROM known)")
def drift_missing(spark: SparkSession, d: str) -> DataFrame:
    return dossier.missing(_dossiers(spark, d)[0], _items(spark, d))


@_query(f"WITH {_DOSSIER} SELECT dossier, citekey, queries FROM hits WHERE (dossier, citekey) NOT IN (SELECT dossier, citekey FROM cited) AND (dossier, citekey) NOT IN (SELECT dossier, citekey FROM rejected)")
def drift_candidates(spark: SparkSession, d: str) -> DataFrame:
    return dossier.candidates(_matches(spark, d), *_dossiers(spark, d))


@_query(f"WITH {_DOSSIER} SELECT dossier, citekey, queries, reason FROM hits JOIN rejected USING (dossier, citekey) WHERE (dossier, citekey) NOT IN (SELECT dossier, citekey FROM cited)")
def drift_reconsider(spark: SparkSession, d: str) -> DataFrame:
    return dossier.reconsider(_matches(spark, d), *_dossiers(spark, d))


@_query(f"WITH {_DOSSIER}, m AS (SELECT dossier, citekey FROM cited UNION SELECT dossier, citekey FROM rejected) SELECT dossier, (SELECT count(*) FROM known) - count(known.citekey) AS unconsidered FROM m LEFT JOIN known USING (citekey) GROUP BY dossier")
def drift_unconsidered(spark: SparkSession, d: str) -> DataFrame:
    return dossier.unconsidered(_items(spark, d), *_dossiers(spark, d))


def _knn(spark: SparkSession, d: str, metric: str) -> DataFrame:
    v = _t(spark, d, "embeddings").select("vec_id", "embedding")
    return vectors.nearest(v, v.where("vec_id % 50 = 0"), 5, metric).select("query_id", "vec_id", F.round("distance", 4).alias("distance"))


_KNN = """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT q.vec_id AS query_id, v.vec_id, round({0}, 6) AS dist FROM v q, v WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, vec_id) AS rank FROM p)
SELECT query_id, vec_id, round(dist, 4) AS distance FROM r WHERE rank <= 5"""


@_query(_KNN.format("list_distance(q.e, v.e) ** 2"))
def knn_l2(spark: SparkSession, d: str) -> DataFrame:
    return _knn(spark, d, "l2")


@_query(_KNN.format("1 - list_cosine_similarity(q.e, v.e)"))
def knn_cosine(spark: SparkSession, d: str) -> DataFrame:
    return _knn(spark, d, "cosine")


@_query("""SELECT 'doc_' || d.doc_id AS citekey, CASE WHEN l.quality IS NULL THEN 'new' WHEN l.quality = 1 THEN 'keep' ELSE 'replace' END AS state
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def embed_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents have stored chunks; those of quality 0 carry an old hash."""
    texts = _t(spark, d, "documents").select("doc_id", _key(F.col("doc_id")).alias("citekey"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    stored = texts.join(_t(spark, d, "labels"), "doc_id").select("citekey", F.when(F.col("quality") == 1, F.col("text_hash")).otherwise("old").alias("stored_hash"))
    return vectors.embedding_state(texts.select("citekey", "text_hash"), stored)


@_query("""SELECT conv_id, count(*) AS calls, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def retrieval_cost(spark: SparkSession, d: str) -> DataFrame:
    """User turns are a conversation's retrieval log."""
    return _t(spark, d, "conversations").where("role = 'user'").groupBy("conv_id").agg(F.count("*").alias("calls"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"))


@_query("SELECT conv_id, text AS query, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY first, text) AS INTEGER) AS ord FROM (SELECT conv_id, text, min(turn) AS first FROM conversations WHERE role = 'user' GROUP BY ALL)")
def recorded_queries(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "conversations").where("role = 'user'").groupBy("conv_id", "text").agg(F.min("turn").alias("first"))
    return rows.select("conv_id", F.col("text").alias("query"), F.row_number().over(Window.partitionBy("conv_id").orderBy("first", "text")).alias("ord"))


@_query("""WITH g AS (SELECT user_id, event_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
SELECT user_id, event_id, CAST(gap // 1000000 AS BIGINT) AS gap_s, gap > 1800000000 AS stalled FROM g WHERE gap > 900000000""")
def pool_gap_watchdog(spark: SparkSession, d: str) -> DataFrame:
    """Gaps between a worker's completions of over half the stall limit."""
    from lectern.streaming.watchdog import gaps

    return gaps(_t(spark, d, "events"), "user_id")


@_query(r"""WITH r AS (SELECT page_id, unnest(regexp_extract_all(coalesce(html, ''), '(?:src|href)="([^"]*)"', 1)) AS ref FROM pages)
SELECT page_id, count(*) AS refs, count(*) FILTER (WHERE NOT regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*:')) AS local FROM r GROUP BY page_id""")
def local_refs(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit('(?:src|href)="([^"]*)"'), F.lit(1))).alias("ref"))
    return rows.groupBy("page_id").agg(F.count("*").alias("refs"), F.count_if(~F.col("ref").rlike("^[A-Za-z][A-Za-z0-9+.-]*:")).alias("local"))

QUERIES |= writing.QUERIES | upkeep.QUERIES | reports.QUERIES | corpus.QUERIES
SQL |= writing.SQL | upkeep.SQL | reports.SQL | corpus.SQL
