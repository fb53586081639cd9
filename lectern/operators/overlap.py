"""Verbatim overlap and page location."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import alphanumeric_words


def ngrams(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``keys``, pos, gram of each run of ``n`` words of a column text."""
    words = rows.select(*keys, alphanumeric_words("text").alias("w"))
    starts = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(F.array().cast("array<int>"))
    return words.select(*keys, F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice("w", i + 1, n), " "))).alias("pos", "gram"))


def verbatim_runs(drafts: DataFrame, sources: DataFrame, n: int = 8) -> DataFrame:
    """Maximal runs of a draft's n-grams that occur in a source.

    ``drafts``: draft_id, text; ``sources``: page, text. Gives draft_id, start,
    n_words and the first page of the run's first n-gram. Islands of consecutive
    positions are found within a draft.
    """
    first = ngrams(sources, ["page"], n).groupBy("gram").agg(F.min("page").alias("page"))
    hits = ngrams(drafts, ["draft_id"], n).join(first, "gram").select("draft_id", "pos", "page")
    island = F.col("pos") - F.row_number().over(Window.partitionBy("draft_id").orderBy("pos"))
    runs = hits.withColumn("island", island).groupBy("draft_id", "island").agg(F.min("pos").alias("start"), F.count("*").alias("k"), F.min_by("page", "pos").alias("page"))
    return runs.select("draft_id", "start", (F.col("k") + n - 1).alias("n_words"), "page")


def shared_grams(drafts: DataFrame, sources: DataFrame, n: int = 8) -> DataFrame:
    """Distinct common n-grams of each draft and page."""
    a, b = ngrams(drafts, ["draft_id"], n).select("draft_id", "gram").distinct(), ngrams(sources, ["page"], n).select("page", "gram").distinct()
    return a.join(b, "gram").groupBy("draft_id", "page").agg(F.count("*").alias("shared"))


def locate(phrases: DataFrame, pages: DataFrame, k: int = 4) -> DataFrame:
    """The k pages with the largest share of a phrase's words of over three characters.

    A repeated word counts each time; on ties the later page comes first.
    ``phrases``: phrase_id, text; ``pages``: page, text.
    """
    words = phrases.select("phrase_id", F.filter(alphanumeric_words("text"), lambda w: F.length(w) > 3).alias("w"))
    words = words.select("phrase_id", F.greatest(F.size("w"), F.lit(1)).alias("n"), F.explode("w").alias("word")).groupBy("phrase_id", "n", "word").agg(F.count("*").alias("times"))
    there = pages.select("page", F.explode(F.array_distinct(alphanumeric_words("text"))).alias("word"))
    hits = there.join(words, "word").groupBy("phrase_id", "page").agg(F.round(F.sum("times") / F.first("n"), 6).alias("score"))
    order = Window.partitionBy("phrase_id").orderBy(F.desc("score"), F.desc("page"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def scrub(text: str | Column) -> Column:
    """Control bytes, but for white space, turned to spaces."""
    return F.regexp_replace(text, r"[\x00-\x08\x0e-\x1f]", " ")


def gram_numbers(words: np.ndarray, n: int) -> np.ndarray:
    """A number for the ``n`` of all words (n at least) from each place on, equal only for equal words: runs of twice the size are numbered by their halves."""
    size = 1
    while size < n:
        step = min(size, n - size)
        words = np.unique(words[: len(words) - step] * (words.max() + 1) + words[step:], return_inverse=True)[1]
        size += step
    return words


def _shared_runs(rows: pa.Table, n: int) -> pa.RecordBatch:
    """The runs of paragraphs (page null) in the pages of the same (citekey, part), all of which are among ``rows``."""
    rows = rows.combine_chunks()
    lists = pc.split_pattern(rows["words"], " ").combine_chunks()
    words = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.append(0, np.cumsum(lists.value_lengths().to_numpy())).astype(np.int64)
    per = np.diff(bounds) - n + 1  # rows of fewer words than n don't come here
    row = np.repeat(np.arange(len(per)), per)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    gram = gram_numbers(words, n)[bounds[row] + pos]
    group = np.unique(rows["citekey"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64) * (1 << 32) + rows["part"].to_numpy(), return_inverse=True)[1]
    key = group[row] * (gram.max() + 1) + gram
    page, source = rows["page"].fill_null(0).to_numpy(), rows["page"].is_valid().to_numpy()
    own = np.flatnonzero(source[row])
    own = own[np.lexsort((page[row[own]], key[own]))]
    own = own[np.append(True, key[own[1:]] != key[own[:-1]])] if len(own) else own
    asked = np.flatnonzero(~source[row])
    at = np.searchsorted(key[own], key[asked])
    hit = at < len(own)
    hit[hit] = key[own[at[hit]]] == key[asked[hit]]
    asked, at = asked[hit], own[at[hit]]
    starts = np.flatnonzero(np.append(True, (row[asked[1:]] != row[asked[:-1]]) | (pos[asked[1:]] != pos[asked[:-1]] + 1))) if len(asked) else asked
    of = pa.array(row[asked[starts]])
    lengths = np.diff(np.append(starts, len(asked))) + n - 1
    cols = [*(rows[c].take(of).combine_chunks() for c in ("draft_id", "citekey", "ord")), pa.array(pos[asked[starts]].astype(np.int32)), pa.array(lengths.astype(np.int64)), pa.array(page[row[at[starts]]])]
    return pa.RecordBatch.from_arrays(cols, names=["draft_id", "citekey", "ord", "start", "n_words", "page"])


def _runs_by_source(n: int, most_bytes: int):
    """A function of batches sorted by (citekey, part): whole groups are compared, about ``most_bytes`` of words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            citekey, part = rows["citekey"].combine_chunks().dictionary_encode().indices.to_numpy(), rows["part"].to_numpy()
            ends = np.flatnonzero((citekey[1:] != citekey[:-1]) | (part[1:] != part[:-1])) + 1
            size, start = np.cumsum(pc.binary_length(rows["words"]).to_numpy().astype(np.int64)), 0
            while len(ends := ends[ends > start]):
                before = size[start - 1] if start else 0
                fit = ends[size[ends - 1] - before <= most_bytes]
                stop = int(fit[-1] if len(fit) else ends[0])
                yield _shared_runs(rows.slice(start, stop - start), n)
                start = stop
            held = rows.slice(start)
        if held is not None and held.num_rows:
            yield _shared_runs(held, n)

    return run


def citing_overlaps(paragraphs: DataFrame, sources: DataFrame, n: int = 8, most: int = 25, part_bytes: int = 16 << 20) -> DataFrame:
    """The ``most`` longest runs that a draft's citing paragraphs share with the cited source, by (length, page, place), longest first.

    ``paragraphs``: draft_id, citekey, ord, paragraph; ``sources``: citekey,
    page, text. Only a cited source counts: its pages and the paragraphs that name
    it go to one task as words, each once, and n-grams are numbered there. Where
    the paragraphs that name a source have over ``part_bytes``, they are dealt out
    and its pages go to each part.
    """

    def words(text: str | Column) -> Column:
        own = alphanumeric_words(text)
        return F.when(F.size(own) >= n, F.array_join(own, " "))

    keys = ["draft_id", "citekey", "ord"]
    own = paragraphs.select(*keys, words("paragraph").alias("words")).where("words is not null and citekey is not null")
    there = sources.select("citekey", "page", words(scrub("text")).alias("words")).where("words is not null and citekey is not null")
    parts = paragraphs.groupBy("citekey").agg(F.ceil(F.sum(F.length("paragraph")) / part_bytes).alias("parts")).where("parts > 1")
    parts = F.broadcast(parts)  # a row for ``part_bytes`` of paragraphs at most
    own = own.join(parts, "citekey", "left").withColumn("part", F.pmod(F.xxhash64("draft_id", "ord"), F.coalesce("parts", F.lit(1).cast("long")))).drop("parts")
    there = there.join(parts, "citekey", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1))).drop("parts")
    rows = own.unionByName(there, allowMissingColumns=True).select("citekey", "part", "page", "draft_id", "ord", "words")
    rows = rows.repartition("citekey", "part").sortWithinPartitions("citekey", "part")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    runs = rows.mapInArrow(_runs_by_source(n, 4 << 20), ", ".join(f"{c} {kinds[c]}" for c in keys) + f", start int, n_words long, page {kinds['page']}")
    order = Window.partitionBy("draft_id").orderBy(F.desc("n_words"), F.desc("page"), F.desc("citekey"), F.desc("ord"), F.desc("start"))
    return runs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
