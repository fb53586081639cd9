"""Benchmark decontamination by a generalised suffix automaton.

The automaton holds every substring of the normalised test items. Training
tokens stream through it, and the length of the longest match at each token
tells which words lie in an occurrence of an item window. The items are read in
blocks of bounded size (``block_bytes``): each block's automaton is broadcast
and all documents stream past it, one pass after the other with a table between,
so a larger benchmark takes more passes, not more memory. No shuffle of
documents.

Defined results: null texts have no words; an item without words has no window;
a null item_id still marks words, but is not listed; repeated rows are judged
each; empty tables give no hits; other columns pass through, but for those with
the name of a column that is added, which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import drop_tables, materialize, text_slices

#: Letters fold to lower case, other ASCII but digits separates words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_RUN = re.compile(rb"[^ ]+")


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class ItemAutomaton:
    """Substrings of word sequences; see ``scan``."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.holders: dict[tuple[int, ...], set[str | None]] = {}
        short: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        self.least = window
        for item_id, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in normal_words(text))
            if not ids:
                continue
            last = 0
            for c in ids:
                last = self._extend(last, c)
            if len(ids) < window:
                short.setdefault(last, []).append((len(ids), ids))
                self.least = min(self.least, len(ids))
            for i in range(max(1, len(ids) - window + 1)):
                self.holders.setdefault(ids[i : i + window], set()).add(item_id)
        self.short: list[tuple] = [()] * len(self.next)
        for v in sorted(range(len(self.next)), key=self.length.__getitem__):
            inherited = self.short[self.link[v]] if v else ()
            self.short[v] = inherited + tuple(dict.fromkeys(short.get(v, ())))

    def _add(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state of the strings of p followed by c, apart from longer ones in q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._add(self.length[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        new, p = self._add(self.length[last] + 1, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c, self.next[p][c])
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Spans of words in occurrences of windows, and the items whose windows occur."""
        spans, found, n = [], set(), len(words)
        if n < self.least:
            return spans, found
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, n)
        edge = np.flatnonzero(np.diff((ids >= 0).astype(np.int8), prepend=0, append=0))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a < self.least:
                continue
            run = ids[a:b].tolist()
            state = matched = 0
            for i, c in enumerate(run):
                while state and c not in self.next[state]:
                    state = self.link[state]
                    matched = self.length[state]
                to = self.next[state].get(c)
                if to is None:
                    state = matched = 0
                    continue
                state, matched = to, matched + 1
                if matched >= self.window:
                    self._hit(spans, a + i - matched + 1, a + i + 1)
                    found |= self.holders[tuple(run[i - self.window + 1 : i + 1])]
                for size, item in self.short[state]:
                    if size <= matched:
                        self._hit(spans, a + i - size + 1, a + i + 1)
                        found |= self.holders[item]
        return spans, found

    @staticmethod
    def _hit(spans: list[tuple[int, int]], a: int, b: int) -> None:
        while spans and spans[-1][1] >= a:
            a = min(a, spans.pop()[0])
        spans.append((a, b))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))


def mark(docs: DataFrame, items: DataFrame, window: int = 13, block_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` with _n_words, _spans (of hit words) and _items (ids as strings).

    ``items`` has item_id and text. Each block holds about ``block_bytes`` of
    item text; a single item is never split.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    out = docs.withColumns({"_n_words": F.lit(0).cast("long"), "_spans": F.lit(None).cast(_SPAN), "_items": F.lit(None).cast("array<string>")})
    schema, names, last = out.schema, out.columns, None
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        automaton = spark.sparkContext.broadcast(ItemAutomaton([tuple(r) for r in part.collect()], window))

        def scan(batches: Iterator[pa.RecordBatch], automaton=automaton) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows in text_slices(batch, limit=4 << 20):
                    at = {n: rows.schema.get_field_index(n) for n in ("text", "_spans", "_items")}
                    n_words, spans, found = [], [], []
                    before = zip(rows.column(at["text"]).to_pylist(), rows.column(at["_spans"]).to_pylist(), rows.column(at["_items"]).to_pylist(), strict=True)
                    for text, old, named in before:
                        words = normal_words(text)
                        hits, ids = automaton.value.scan(words)
                        hits = merge_spans(hits + [(s["start"], s["stop"]) for s in old or ()])
                        n_words.append(len(words))
                        spans.append([{"start": a, "stop": z} for a, z in hits])
                        found.append(sorted({*(named or ()), *(i for i in ids if i is not None)}))
                    new = {"_n_words": pa.array(n_words, pa.int64()), "_spans": pa.array(spans, rows.schema.field("_spans").type), "_items": pa.array(found, pa.list_(pa.string()))}
                    yield pa.RecordBatch.from_arrays([new.get(n, rows.column(i)) for i, n in enumerate(names)], names=names)

        out = out.mapInArrow(scan, schema)
        if b + 1 < blocks:  # the next automaton takes this one's place
            before, out = last, materialize(out, "marked")
            last = out
            automaton.unpersist()
            drop_tables(*([before] if before is not None else []))
    return out


def judge(marked: DataFrame, share_of: int = 20) -> DataFrame:
    """Add n_words, n_hit, n_items, items_sha256 and contaminated (a hit share of 1 / ``share_of`` or more)."""
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    out = marked.withColumn("n_hit", hit).withColumn("n_words", F.col("_n_words")).withColumn("n_items", F.size("_items").cast("long"))
    out = out.withColumn("items_sha256", F.sha2(F.array_join("_items", ","), 256))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share_of * F.col("n_hit") >= F.col("n_words")))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and the characters between them."""
    raw = text.encode()
    at = [m.span() for m in _RUN.finditer(raw.translate(FOLD))]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]]).decode()


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, share_of: int = 20) -> DataFrame:
    """``docs`` judged, with clean_text: the text of contaminated documents less its hit spans."""
    judged = judge(mark(docs.drop("clean_text"), items, window), share_of)
    schema = T.StructType([*judged.schema.fields, T.StructField("clean_text", T.StringType())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(batch.schema.get_field_index(n)) for n in ("text", "_spans", "contaminated")}
            texts = [
                cut_spans(t, [(s["start"], s["stop"]) for s in spans]) if bad else t
                for t, spans, bad in zip(col["text"].to_pylist(), col["_spans"].to_pylist(), col["contaminated"].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "clean_text"])

    return judged.mapInArrow(clean, schema).drop("_n_words", "_spans", "_items")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every document against every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return judge(mark(docs, items)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + 12], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n),
hits AS (SELECT DISTINCT doc_id, i, x.n AS n, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM dw) x JOIN bw ON x.n = bw.n AND x.k = bw.k),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""
