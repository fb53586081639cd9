"""Ranked retrieval: BM25 over a term index, snippets, evidence, coverage."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import search_tokens
from lectern.operators.ledger import all_there

K1, B = 1.5, 0.75


def corpus(docs: DataFrame) -> DataFrame:
    """citekey, title (the first line) and text of ``documents``."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("citekey"), F.substring_index(text, "\n", 1).alias("title"), text.alias("text"))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id and each different term. ``queries``: query_id, query."""
    return queries.select("query_id", F.explode(F.array_distinct(search_tokens("query"))).alias("term"))


def term_index(items: DataFrame, queries: DataFrame | None = None, most_terms: int = 1_000_000) -> DataFrame:
    """citekey, length, term, tf. Items without tokens keep one row with a null term, so that they count.

    With ``queries`` only their terms are told apart; an item's other tokens are
    one row with a null term. Up to ``most_terms`` the terms are sent to the
    texts, so that other tokens go before anything is shuffled. The result is
    kept, as scores need its lengths and its postings.
    """
    tokens = items.select("citekey", search_tokens(F.concat_ws("\n", "title", "text")).alias("tokens"))
    rows = tokens.select("citekey", F.size("tokens").alias("length"), F.explode_outer("tokens").alias("term"))
    if queries is None:
        return rows.groupBy("citekey", "length", "term").agg(F.count("*").alias("tf"))
    terms = query_terms(queries).select(F.col("term").alias("wanted")).distinct()
    terms = F.broadcast(terms) if terms.count() <= most_terms else terms
    rows = rows.join(terms, F.col("term") == F.col("wanted"), "left")
    return rows.groupBy("citekey", "length", F.col("wanted").alias("term")).agg(F.count("*").alias("tf")).persist()


def corpus_stats(index: DataFrame) -> DataFrame:
    """One row: n (items) and avgdl, from lengths; items without tokens are included."""
    return index.groupBy("citekey").agg(F.first("length").alias("length")).agg(F.count("*").alias("n"), F.avg("length").alias("avgdl"))


def doc_freq(index: DataFrame) -> DataFrame:
    return index.where("term is not null").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def bm25(index: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, citekey, score of each item with a query term. ``queries``: query_id, query.

    Only postings of query terms are read on; a score that isn't positive is dropped.
    """
    terms = query_terms(queries)
    wanted = index.join(terms.select("term").distinct(), "term", "left_semi")
    n, avgdl = corpus_stats(index).first()
    df = doc_freq(wanted)
    idf = F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(avgdl or 1.0)))
    weights = wanted.join(df, "term").select("term", "citekey", (idf * part).alias("weight"))
    return weights.join(terms, "term").groupBy("query_id", "citekey").agg(F.round(F.sum("weight"), 6).alias("score")).where("score > 0")


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ties by citekey, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "citekey")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_windows(text: str, terms: list[str], width: int, count: int, most_anchors: int = 500) -> list[str]:
    """The ``count`` windows of ``width`` characters with most distinct terms, apart, in text order."""
    low, anchors = text.lower(), set()
    for t in sorted(set(terms)):
        for n, m in enumerate(re.finditer(f"(?={re.escape(t)})", low)):
            if n >= most_anchors:
                break
            anchors.add(max(0, m.start() - width // 2))
    ranked = sorted(anchors, key=lambda a: (-sum(t in low[a : a + width] for t in set(terms)), a))
    chosen: list[int] = []
    for a in ranked:
        if len(chosen) < count and all(abs(a - c) >= width for c in chosen):
            chosen.append(a)
    return [" ".join(text[a : a + width].split()) for a in sorted(chosen)]


def snippets(hits: DataFrame, items: DataFrame, queries: DataFrame, width: int = 500, count: int = 1, most_broadcast: int = 200_000) -> DataFrame:
    """``hits`` with title and snippet; texts are fetched for the hits alone, and stay where they are up to ``most_broadcast`` hits."""
    hits = hits.persist()
    few = F.broadcast(hits) if hits.count() <= most_broadcast else hits
    rows = few.join(items, "citekey").join(queries.select("query_id", search_tokens("query").alias("terms")), "query_id")
    names = [*hits.columns, "title"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [best_windows(t, list(q), width, count) for t, q in zip(pdf["text"], pdf["terms"], strict=True)]
            yield pdf[names].assign(snippet=[" ... ".join(w) if w else " ".join(t[:width].split()) for w, t in zip(found, pdf["text"], strict=True)])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(names).schema) + ", snippet string"
    return rows.select(*names, "text", "terms").mapInPandas(run, schema)


def evidence(items: DataFrame, asked: DataFrame, width: int = 600, count: int = 2) -> DataFrame:
    """query_id, citekey, windows (array): the windows of one item that bear on a query. ``asked``: query_id, citekey, query.

    A citekey that ``items`` (citekey, title, text) lacks fails the plan, also if
    its query has no terms; a query without terms, or an item without text, has
    no windows.
    """
    rows = asked.join(items, "citekey").select("query_id", "citekey", F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))).alias("text"), search_tokens("query").alias("terms"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["query_id", "citekey"]].assign(windows=[best_windows(t, list(q), width, count) if len(q) else [] for t, q in zip(pdf["text"], pdf["terms"], strict=True)])

    kind = asked.schema["query_id"].dataType.simpleString()
    return all_there(rows.mapInPandas(run, f"query_id {kind}, citekey string, windows array<string>"), asked, items)


def coverage(candidates: DataFrame, cited: DataFrame) -> DataFrame:
    """Each citekey of either side, and whether it is a candidate and cited."""
    a, b = candidates.select("citekey").distinct().withColumn("candidate", F.lit(True)), cited.select("citekey").distinct().withColumn("cited", F.lit(True))
    return a.join(b, "citekey", "full").select("citekey", F.coalesce("candidate", F.lit(False)).alias("candidate"), F.coalesce("cited", F.lit(False)).alias("cited"))


def fingerprints(items: DataFrame) -> DataFrame:
    """citekey and fingerprint (of title and text) of each item."""
    return items.select("citekey", F.sha2(F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))), 256).alias("fingerprint"))


def index_changes(stored: DataFrame, items: DataFrame) -> DataFrame:
    """citekey and change (kept, changed, new, gone) between a stored index's fingerprints and the items."""
    old = stored.select("citekey", F.col("fingerprint").alias("old"))
    new = fingerprints(items).withColumnRenamed("fingerprint", "new")
    change = F.when(F.col("new").isNull(), "gone").when(F.col("old").isNull(), "new").when(F.col("old") == F.col("new"), "kept").otherwise("changed")
    return old.join(new, "citekey", "full").select("citekey", change.alias("change"))


def refresh_index(index: DataFrame, stored: DataFrame, items: DataFrame) -> DataFrame:
    """The index of ``items``: rows of unchanged ones as stored, only new and changed ones tokenised."""
    changes = index_changes(stored, items)
    kept = index.join(changes.where("change = 'kept'"), "citekey", "left_semi")
    again = items.join(changes.where("change in ('new', 'changed')"), "citekey", "left_semi")
    return kept.unionByName(term_index(again))
