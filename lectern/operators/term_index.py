"""A term index on shared storage, refreshed by what changed, and ranked search that leaves most postings unread.

A version (``sources/versions.py``) names segments. A segment has, for the items
it was made from, their terms (``forward``, a row an item) and blocks of postings: a block holds
up to 128 postings of one term among the items of one slice, the likeliest to
weigh much first, with the largest frequency and the smallest length in it.
Blocks are written by hash of the term and sorted by it. A refresh tokenises only
items whose fingerprint is new, in a segment of their own; items that changed or
vanished are listed as dead in the older ones. ``terms`` keeps document
frequencies up to date by the terms of dead and fresh items.

Search for few postings by MaxScore, as joins: the first postings of each list give
scores that a query's k-th best can't fall below. Terms whose highest weights
together stay below that can't bring an item in: candidates come from blocks of the
other terms, those that could still matter, and only candidates are scored, by their
own terms. Results are the same as without any of this.

Many queries together ask for nearly all blocks of their terms, and a row for each
query and posting would be many times the index. Then each block goes once to its
slice of items, for a group of queries: a task adds up the scores of one slice and
one group at a time, and passes on each query's best of the slice. Both ways give the
same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.text import search_tokens
from lectern.operators.retrieval import K1, B, query_terms, top_k
from lectern.sources.counters import Counters
from lectern.sources.versions import CommitConflict, Versions

LAYOUT = 2
BLOCK, SLICE_ITEMS, SEEDS = 128, 16_384, 32
#: Tokens that are counted at a time, and queries whose scores a task adds up together (by hash, so about as many).
COUNT_TOKENS, GROUP_QUERIES = 1 << 18, 128
#: Scores are rounded to six digits, so equal ones may differ by this before.
SLACK = 2e-6

ITEMS = "citekey string, fingerprint string, length int, segment string"
FORWARD = "citekey string, fingerprint string, length int, terms array<string>, tfs array<long>"
BLOCKS = "term string, block long, citekeys array<string>, lengths array<int>, tfs array<long>, most long, least int, bucket int"
TERMS = "term string, df long, cf long"


def weight(tf: Column, length: Column, mean: float) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(mean or 1.0)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``FORWARD`` rows of batches of citekey, fingerprint, tokens: an item's tokens lie together, so counting them needs no shuffle.

    A batch is counted in runs of items of bounded size, however long its texts are.
    """
    for batch in batches:
        bounds, start = batch.column(2).offsets.to_numpy().astype(np.int64), 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(bounds[1:], bounds[start] + COUNT_TOKENS, side="right")))
            yield _counted_run(batch.slice(start, stop - start))
            start = stop


def _counted_run(rows: pa.RecordBatch) -> pa.RecordBatch:
    lists = rows.column(2)
    words = lists.flatten().dictionary_encode()
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int32)
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = max(1, len(words.dictionary))
    key, tf = np.unique(np.repeat(np.arange(len(sizes)), sizes) * distinct + code, return_counts=True)
    bounds = pa.array(np.append(0, np.cumsum(np.bincount(key // distinct, minlength=len(sizes)))).astype(np.int32))
    terms = pa.ListArray.from_arrays(bounds, words.dictionary.take(pa.array(key % distinct)))
    tfs = pa.ListArray.from_arrays(bounds, pa.array(tf.astype(np.int64)))
    return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(sizes), terms, tfs], names=["citekey", "fingerprint", "length", "terms", "tfs"])


class _Slice:
    """Scores of the items of one slice for one group of queries, block by block."""

    def __init__(self, mean: float, k: int):
        self.mean, self.k, self.at, self.keys, self.dead = mean or 1.0, k, {}, [], set()
        self.scores = np.zeros((1, 1))

    def items(self, citekeys: list[str]) -> np.ndarray:
        """The items' places, new ones at the end."""
        for c in citekeys:
            if c not in self.at:
                self.at[c] = len(self.keys)
                self.keys.append(c)
        return np.array([self.at[c] for c in citekeys], np.int64)

    def add(self, at: np.ndarray, lengths: np.ndarray, tfs: np.ndarray, queries: np.ndarray, idfs: np.ndarray) -> None:
        """One block's postings, of the items at these places."""
        need = len(self.keys), int(queries.max()) + 1
        if need[0] > self.scores.shape[0] or need[1] > self.scores.shape[1]:
            larger = np.zeros([max(n, m if n <= m else 2 * m) for n, m in zip(need, self.scores.shape, strict=True)])
            larger[: self.scores.shape[0], : self.scores.shape[1]] = self.scores
            self.scores = larger
        weights = tfs * (K1 + 1) / (tfs + K1 * (1 - B + B * lengths / self.mean))
        np.add.at(self.scores, (at[:, None], queries), np.outer(weights, idfs))  # a key that comes twice counts twice

    def best(self) -> tuple[np.ndarray, list[str], np.ndarray]:
        """query, citekey and score of all items that may be among a query's k best, dead ones left out."""
        live = np.array([i for i, c in enumerate(self.keys) if c not in self.dead], np.int64)
        found = []
        for q in range(self.scores.shape[1]):
            s = self.scores[live, q]
            at = np.flatnonzero(s > 0)
            if len(at) > self.k:
                at = at[s[at] >= np.partition(s[at], len(at) - self.k)[len(at) - self.k] - SLACK]
            if len(at) > self.k:  # of equal scores the first k by citekey are enough
                order = at[np.lexsort((np.array([self.keys[i] for i in live[at]]), -s[at]))]
                new = np.append(True, s[order[1:]] != s[order[:-1]])
                place = np.arange(len(order))
                at = order[place - np.maximum.accumulate(np.where(new, place, 0)) < self.k]
            found.append((np.full(len(at), q), live[at], s[at]))
        q, at, s = (np.concatenate(x) for x in zip(*found, strict=True))
        return q, [self.keys[i] for i in at], s


def _best_of_slices(mean: float, k: int):
    """A function of batches sorted by (part, segment, slice, term): part, queries, idfs, segment, slice, term (null: the citekeys are dead), citekeys, lengths, tfs."""

    def out(part: int, whole: _Slice) -> pa.RecordBatch:
        q, citekeys, s = whole.best()
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(q), part, np.int64)), pa.array(q.astype(np.int32)), pa.array(citekeys, pa.string()), pa.array(s)], names=["part", "q", "citekey", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, whole = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {c: batch.column(c) for c in batch.schema.names}
            place = np.stack([column[c].to_numpy() for c in ("part", "segment", "slice")], axis=1)
            dead = column["term"].is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1) | (dead[1:] != dead[:-1])))
            keys = column["citekeys"].flatten().dictionary_encode()
            names, code = keys.dictionary.to_pylist(), keys.indices.to_numpy()
            spans = {c: np.append(0, np.cumsum(column[c].value_lengths().fill_null(0).to_numpy())) for c in ("citekeys", "queries")}
            flat = {c: column[c].flatten().to_numpy() for c in ("lengths", "tfs", "queries", "idfs")}
            flat["lengths"], flat["tfs"], spans["lengths"] = flat["lengths"].astype(float), flat["tfs"].astype(float), np.append(0, np.cumsum(column["lengths"].value_lengths().fill_null(0).to_numpy()))
            for first, last in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if tuple(place[first]) != now:
                    if whole:
                        yield out(now[0], whole)
                    now, whole = tuple(place[first]), _Slice(mean, k)
                own = code[spans["citekeys"][first] : spans["citekeys"][last]]
                there, at = np.unique(own, return_inverse=True)
                if dead[first]:
                    whole.dead.update(names[i] for i in there)
                    continue
                at, base = whole.items([names[i] for i in there])[at], spans["citekeys"][first]
                for i in range(first, last):
                    (a, b), (x, y), (m, n) = (spans[c][i : i + 2] for c in ("citekeys", "lengths", "queries"))
                    whole.add(at[a - base : b - base], flat["lengths"][x:y], flat["tfs"][x:y], flat["queries"][m:n], flat["idfs"][m:n])
        if whole:
            yield out(now[0], whole)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``BLOCKS`` of sorted postings (term, slice, citekey, length, tf, bucket); the last block of a batch may go on in the next."""
    open_, done = None, 0  # the rows of the open block, and how many of its list went before
    for batch in batches:
        rows = batch if open_ is None else pa.Table.from_batches([open_, batch]).combine_chunks().to_batches()[0]
        if not rows.num_rows:
            continue
        term = rows.column("term").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        part = rows.column("slice").to_numpy()
        place = np.arange(rows.num_rows)
        new = np.concatenate([[True], (term[1:] != term[:-1]) | (part[1:] != part[:-1])])
        at = place - np.maximum.accumulate(np.where(new, place, 0))
        at[: int(np.argmax(new[1:])) + 1 if new[1:].any() else len(at)] += done
        starts = np.flatnonzero(at % BLOCK == 0)
        if len(starts) > 1:
            yield _block_rows(rows, starts[:-1], int(starts[-1]), at)
        open_, done = rows.slice(int(starts[-1])), int(at[starts[-1]])
    if open_ is not None:
        yield _block_rows(open_, np.zeros(1, np.int64), open_.num_rows, np.arange(open_.num_rows) + done)


def _block_rows(rows: pa.RecordBatch, starts: np.ndarray, end: int, at: np.ndarray) -> pa.RecordBatch:
    first, bounds = pa.array(starts), pa.array(np.append(starts, end).astype(np.int32))
    column = {c: rows.column(c) for c in rows.schema.names}
    lists = [pa.ListArray.from_arrays(bounds, column[c]) for c in ("citekey", "length", "tf")]
    most = np.maximum.reduceat(column["tf"].to_numpy()[:end], starts)
    least = np.minimum.reduceat(column["length"].to_numpy()[:end], starts)
    number = column["slice"].to_numpy()[starts] * (1 << 32) + at[starts] // BLOCK
    return pa.RecordBatch.from_arrays([column["term"].take(first), pa.array(number), *lists, pa.array(most), pa.array(least), column["bucket"].take(first)], names=["term", "block", "citekeys", "lengths", "tfs", "most", "least", "bucket"])


def _told_apart(forward: DataFrame, explode=F.explode) -> DataFrame:
    """citekey, length, term and tf of ``FORWARD`` rows."""
    rows = forward.select("citekey", "length", explode(F.arrays_zip("terms", "tfs")).alias("t"))
    return rows.select("citekey", "length", F.col("t.terms").alias("term"), F.coalesce("t.tfs", F.lit(0)).alias("tf"))


def _slice_of(citekey: str, n: int) -> Column:
    """The slice that an item of a segment of ``n`` items belongs to."""
    return F.pmod(F.xxhash64(citekey), F.lit(max(1, -(-n // SLICE_ITEMS))))


class TermIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 32, most_segments: int = 8, most_broadcast: int = 200_000, most_skipping: int = 1_000_000):
        self.spark, self.versions = spark, Versions(spark, path)
        self.buckets, self.most_segments, self.most_broadcast, self.most_skipping = buckets, most_segments, most_broadcast, most_skipping

    def current(self) -> dict | None:
        now = self.versions.current()
        return now if now and now.get("layout") == LAYOUT else None

    def _table(self, folder: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(folder)

    def items(self, now: dict) -> DataFrame:
        """citekey, fingerprint, length and segment of every item."""
        return self._table(now["items"], ITEMS)

    def terms(self, now: dict) -> DataFrame:
        """term, df (items) and cf (occurrences)."""
        return self._table(now["terms"], TERMS)

    def _alive(self, rows: DataFrame, segment: dict) -> DataFrame:
        if not segment["n_dead"]:
            return rows
        dead = self._table(segment["dead"], "citekey string")
        return rows.join(F.broadcast(dead) if segment["n_dead"] <= self.most_broadcast else dead, "citekey", "left_anti")

    def _forward(self, now: dict) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._alive(self._table(f"{s['folder']}/forward", FORWARD), s) for s in now["segments"]])

    def forward(self, now: dict) -> DataFrame:
        """citekey, length, term (null: none) and tf of every item's terms."""
        return _told_apart(self._forward(now), F.explode_outer)

    def refresh(self, items: DataFrame, source: str | None = None) -> dict:
        """The version whose items are ``items`` (citekey, title, text), made if need be.

        ``source`` says where the items come from and in which state; if the
        current version was made from the same, nothing is read. ``tokenised`` in
        the manifest counts the items that this refresh tokenised.
        """
        now = self.current()
        if now and source and now.get("source") == source:
            return now | {"tokenised": 0}
        try:
            return self._refresh(items, source, now)
        except CommitConflict:  # someone else refreshed meanwhile
            return self._refresh(items, source, self.current())

    def _refresh(self, items: DataFrame, source: str | None, now: dict | None) -> dict:
        text = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")))
        cores = self.spark.sparkContext.defaultParallelism
        if items.rdd.getNumPartitions() < cores:  # one file of one row group, say: its texts are dealt out before they are cut into words
            items = items.select("citekey", "title", "text").repartition(cores, "citekey")
        texts = items.select("citekey", F.sha2(text, 256).alias("fingerprint"), text.alias("text"))
        segments = [dict(s) for s in now["segments"]] if now else []
        same = None
        if now:
            old = self.items(now)
            marks = texts.select("citekey", "fingerprint")
            same = old.join(marks, ["citekey", "fingerprint"], "left_semi")
            gone = old.join(marks, ["citekey", "fingerprint"], "left_anti").select("citekey", "segment").persist()
            texts = texts.join(old.select("citekey", "fingerprint"), ["citekey", "fingerprint"], "left_anti")
        folder, seen = self.versions.folder("segment"), Counters()
        tokens = seen.of(texts, n=F.count("*")).select("citekey", "fingerprint", search_tokens("text").alias("tokens"))
        tokens.mapInArrow(_counted, FORWARD).write.option("compression", "zstd").parquet(f"{folder}/forward")
        tokenised = seen["n"]
        fresh = self._table(f"{folder}/forward", FORWARD)
        changes = [_told_apart(fresh).select("term", F.lit(1).cast("long").alias("df"), F.col("tf").alias("cf"))]
        dead = {r["segment"]: r["n"] for r in gone.groupBy("segment").agg(F.count("*").alias("n")).collect()} if now else {}
        if now and not tokenised and not dead:
            gone.unpersist()
            if source and now.get("source") != source:
                version = self.versions.commit({k: v for k, v in now.items() if k != "version"} | {"source": source}, now["version"])
                now = now | {"version": version, "source": source}
            return now | {"tokenised": 0}
        for s in segments:
            if n := dead.get(s["folder"]):
                lost = gone.where(F.col("segment") == s["folder"]).select("citekey")
                terms = self._alive(self._table(f"{s['folder']}/forward", FORWARD), s).join(lost, "citekey", "left_semi")
                changes.append(_told_apart(terms).select("term", F.lit(-1).cast("long").alias("df"), (-F.col("tf")).alias("cf")))
                was = self._table(s["dead"], "citekey string") if s["n_dead"] else lost.limit(0)
                s["dead"], s["n_dead"] = self.versions.folder("dead"), s["n_dead"] + n
                was.unionByName(lost).write.parquet(s["dead"])
        if tokenised:
            self._write_blocks(fresh, folder, tokenised)
            segments.append({"folder": folder, "n": tokenised, "n_dead": 0, "dead": None})
        if now:
            changes.append(self.terms(now))
        new = {"layout": LAYOUT, "items": self.versions.folder("items"), "terms": self.versions.folder("terms"), "source": source, "tokenised": tokenised}
        own = fresh.groupBy("citekey", "fingerprint", "length").agg(F.lit(folder).alias("segment"))
        totals = Counters()
        listed = totals.of(same.unionByName(own) if now else own, n=F.count("*"), length=F.sum("length"))
        listed.write.parquet(new["items"])
        terms = reduce(DataFrame.unionByName, changes).groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).where("df > 0")
        terms.repartition(self.buckets, "term").sortWithinPartitions("term").write.parquet(new["terms"])
        new |= totals.all() | {"segments": [s for s in segments if s["n"] > s["n_dead"]]}
        if len(new["segments"]) > self.most_segments:
            new["segments"] = [self._merged(new)]
        version = self.versions.commit(new, now["version"] if now else self.versions.numbers()[-1] if self.versions.numbers() else 0)
        if now:
            gone.unpersist()
        return new | {"version": version}

    def _merged(self, now: dict) -> dict:
        """All segments' live items as one segment."""
        folder = self.versions.folder("segment")
        self._forward(now).write.option("compression", "zstd").parquet(f"{folder}/forward")
        self._write_blocks(self._table(f"{folder}/forward", FORWARD), folder, now["n"])
        items = self.versions.folder("items")
        self.items(now).withColumn("segment", F.lit(folder)).write.parquet(items)
        now["items"] = items
        return {"folder": folder, "n": now["n"], "n_dead": 0, "dead": None}

    def _write_blocks(self, forward: DataFrame, folder: str, n: int) -> None:
        """Postings by term and slice of the items, so that a list has a bounded length, however common its term."""
        bucket, part = F.pmod(F.xxhash64("term"), F.lit(self.buckets)).cast("int"), _slice_of("citekey", n)
        rows = _told_apart(forward).repartition(bucket, part).select("term", part.alias("slice"), "citekey", "length", "tf", bucket.alias("bucket"))
        rows = rows.sortWithinPartitions("bucket", "term", "slice", F.desc(F.col("tf") / (F.col("length") + 1)), "citekey")
        rows.mapInArrow(_cut, BLOCKS).write.option("compression", "zstd").partitionBy("bucket").parquet(f"{folder}/blocks")

    def blocks(self, now: dict, terms: DataFrame) -> DataFrame:
        """The blocks of the given terms (term), with their segment."""
        own = [self._table(f"{s['folder']}/blocks", BLOCKS).withColumn("segment", F.lit(k)) for k, s in enumerate(now["segments"])]
        return reduce(DataFrame.unionByName, own).join(terms, "term", "left_semi") if own else self.spark.createDataFrame([], BLOCKS + ", segment int")

    def weights(self, now: dict, queries: DataFrame) -> DataFrame:
        """query_id, term and idf of the queries' terms that any item has."""
        df = self.terms(now)
        idf = F.log((now["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
        return query_terms(queries).join(df, "term").select("query_id", "term", idf.alias("idf"))

    def _postings(self, now: dict, blocks: DataFrame) -> DataFrame:
        """Live postings of blocks: the other columns with citekey, length, tf."""
        rows = blocks.withColumn("p", F.explode(F.arrays_zip("citekeys", "lengths", "tfs"))).drop("citekeys", "lengths", "tfs")
        rows = rows.withColumns({"citekey": F.col("p.citekeys"), "length": F.col("p.lengths"), "tf": F.col("p.tfs")}).drop("p")
        dead = [self._table(s["dead"], "citekey string").withColumn("segment", F.lit(k)) for k, s in enumerate(now["segments"]) if s["n_dead"]]
        if not dead:
            return rows
        dead = reduce(DataFrame.unionByName, dead)
        return rows.join(F.broadcast(dead) if sum(s["n_dead"] for s in now["segments"]) <= self.most_broadcast else dead, ["segment", "citekey"], "left_anti")

    def needed(self, now: dict, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """The queries' blocks, and bounds of their terms.

        Blocks have query_id, idf, ``essential`` (of the term) and ``read`` (whether
        they can bring in an item); terms have ``top``, their highest weight, and
        ``floor``, what the query's k-th best score is at least.
        """
        mean = now["length"] / now["n"] if now["n"] else 0.0
        weights = self.weights(now, queries).persist()
        few = weights.count() <= self.most_broadcast
        blocks = self.blocks(now, weights.select("term").distinct())
        rows = blocks.join(F.broadcast(weights) if few else weights, "term").withColumn("high", F.col("idf") * weight(F.col("most"), F.col("least"), mean)).persist()
        first = rows.where(F.pmod("block", F.lit(1 << 32)) == 0).select("query_id", "idf", "segment", *(F.slice(c, 1, SEEDS).alias(c) for c in ("citekeys", "lengths", "tfs")))
        seeds = self._postings(now, first).groupBy("query_id", "citekey").agg(F.sum(F.col("idf") * weight(F.col("tf"), F.col("length"), mean)).alias("s"))
        ranked = seeds.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("s")))).where(F.col("r") == k)
        floors = ranked.select("query_id", (F.col("s") - SLACK).alias("floor"))
        highest = rows.groupBy("query_id", "term").agg(F.max("high").alias("top"))
        order = Window.partitionBy("query_id").orderBy("top", "term")
        bound = highest.withColumns({"upto": F.sum("top").over(order.rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("top").over(Window.partitionBy("query_id"))}).join(floors, "query_id", "left")
        floor = F.coalesce("floor", F.lit(float("-inf")))
        bound = bound.select("query_id", "term", "top", (F.col("all") - F.col("top")).alias("rest"), floor.alias("floor"), (F.col("upto") >= floor).alias("essential")).persist()
        rows = rows.join(F.broadcast(bound) if few else bound, ["query_id", "term"])
        return rows.withColumn("read", F.expr("essential and high + rest >= floor")), bound

    def scores(self, queries: DataFrame, k: int, now: dict | None = None) -> DataFrame:
        """query_id, citekey, score of all items that may be among a query's k best; others are missing."""
        now = now or self.current()
        asked = query_terms(queries).join(self.terms(now), "term").agg(F.sum("df")).first()[0] or 0
        return self._scores_by_slice(now, queries, k) if asked > self.most_skipping else self._scores_by_skipping(now, queries, k)

    def _scores_by_slice(self, now: dict, queries: DataFrame, k: int) -> DataFrame:
        mean = now["length"] / now["n"] if now["n"] else 0.0
        weights = self.weights(now, queries).persist()
        few = weights.count() <= self.most_broadcast
        parts = -(-weights.select("query_id").distinct().count() // GROUP_QUERIES)
        numbered = weights.select("query_id", F.pmod(F.xxhash64("query_id"), F.lit(parts)).alias("part")).distinct()
        numbered = numbered.withColumn("q", F.row_number().over(Window.partitionBy("part").orderBy("query_id")) - 1).persist()
        asking = weights.join(numbered, "query_id").groupBy("term", "part").agg(F.array_sort(F.collect_list(F.struct("q", "idf"))).alias("asking"))
        asking = asking.select("term", "part", F.col("asking.q").alias("queries"), F.col("asking.idf").alias("idfs"))
        blocks = self.blocks(now, weights.select("term").distinct()).withColumn("slice", F.shiftright("block", 32))
        keys, lists = ["part", "segment", "slice", "term"], ["queries", "idfs", "citekeys", "lengths", "tfs"]
        rows = blocks.join(F.broadcast(asking) if few else asking, "term").select(*keys, "block", *lists)
        for number, s in enumerate(now["segments"]):
            if s["n_dead"]:
                dead = self._table(s["dead"], "citekey string").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(number).alias("segment"), _slice_of("citekey", s["n"]).alias("slice"), F.array("citekey").alias("citekeys"))
                rows = rows.unionByName(dead, allowMissingColumns=True)
        rows = rows.repartition(*keys[:3]).sortWithinPartitions(*keys, "block").select(*keys, *lists)
        best = rows.mapInArrow(_best_of_slices(mean, k), "part long, q int, citekey string, s double")
        return best.join(F.broadcast(numbered) if few else numbered, ["part", "q"]).select("query_id", "citekey", F.round("s", 6).alias("score")).where("score > 0")

    def _scores_by_skipping(self, now: dict, queries: DataFrame, k: int) -> DataFrame:
        mean = now["length"] / now["n"] if now["n"] else 0.0
        rows, bound = self.needed(now, queries, k)
        part = F.col("idf") * weight(F.col("tf"), F.col("length"), mean)
        columns = ["query_id", "idf", "segment", "citekeys", "lengths", "tfs"]
        first = self._postings(now, rows.where("read").select(columns)).groupBy("query_id", "citekey").agg(F.sum(part).alias("s"))
        more = bound.groupBy("query_id").agg(F.sum(F.when(~F.col("essential"), F.col("top")).otherwise(0.0)).alias("more"), F.first("floor").alias("floor"))
        some = first.join(F.broadcast(more), "query_id").where(F.col("s") + F.col("more") >= F.col("floor")).select("query_id", "citekey", "s")
        rest = self._postings(now, rows.where("not essential").select(columns)).groupBy("query_id", "citekey").agg(F.sum(part).alias("r"))
        whole = some.join(rest, ["query_id", "citekey"], "left").select("query_id", "citekey", F.round(F.col("s") + F.coalesce("r", F.lit(0.0)), 6).alias("score"))
        return whole.where("score > 0")

    def search(self, queries: DataFrame, k: int, now: dict | None = None) -> DataFrame:
        """query_id, citekey, score, rank of the k best of each query. ``queries``: query_id, query."""
        return top_k(self.scores(queries, k, now), k)
