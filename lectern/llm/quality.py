"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its whole text
(how character classes follow each other, word shapes, repetition), embedded,
and weighted by gated attention, softmax(u . (tanh(Vh) * sigmoid(Gh))); the
weighted mean is scored. Weights are learned from document labels alone.

The model is fitted on at most ``sample`` labelled documents, taken in hash
order (a bounded sample); scoring covers every passage of every text.

Defined results: a text without words (null, empty) is one passage of zeros;
repeated rows are scored each; several labels of one doc_id count as their
minimum; null labels and doc_ids are not learned from (crc32 of a null doc_id
is that of the empty text); without both labels the score is the share of
label 1, or 0.5; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import SALTS, mix, text_buffer, text_slices, word_hashes

PASSAGE_WORDS = 64
_CLASSES = 8


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 6, np.uint8)  # other ASCII
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 1, 2, 7
    kind[[9, 10, 11, 12, 13, 32]] = 3
    kind[[33, 63]] = 4
    kind[[44, 46, 58, 59, 39, 34, 40, 41, 45]] = 5
    return kind


_KIND = _byte_classes()
N_FEATURES = _CLASSES * _CLASSES + 7


def encode_passages(raw: np.ndarray, offsets: np.ndarray, passage_words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the rows of a text buffer, and the rows' bounds among them."""
    hashes, starts, ends, bounds = word_hashes(raw, offsets, lower=True)
    per_row = np.diff(bounds)
    count = np.maximum(1, -(-per_row // passage_words))
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros((int(first[-1]), N_FEATURES), np.float32)
    if not len(hashes):
        return out, first
    row = np.repeat(np.arange(len(per_row)), per_row)
    place = np.arange(len(hashes)) - bounds[:-1][row]
    passage = first[:-1][row] + place // passage_words
    words = np.bincount(passage, minlength=len(out)).astype(np.float32)
    full = np.maximum(words, 1)
    # character classes in sequence, from each passage's first byte to its last
    head = np.flatnonzero(np.diff(passage, prepend=-1))
    tail = np.concatenate([head[1:], [len(hashes)]]) - 1
    delta = np.zeros(len(raw) + 1, np.int64)
    owner = np.zeros(len(raw), np.int64)
    delta[starts[head]] += 1
    np.cumsum(delta[:-1], out=owner)
    inside = np.zeros(len(raw) + 1, np.int8)
    np.add.at(inside, starts[head], 1)
    np.add.at(inside, ends[tail], -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    at = at[at + 1 < len(raw)]
    kind = _KIND[raw].astype(np.int64)
    code = (owner[at] - 1) * (_CLASSES * _CLASSES) + kind[at] * _CLASSES + kind[at + 1]
    pairs = np.bincount(code, minlength=len(head) * _CLASSES * _CLASSES).reshape(len(head), -1).astype(np.float32)
    out[passage[head], : _CLASSES * _CLASSES] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))

    def mean_of(x: np.ndarray) -> np.ndarray:
        return np.bincount(passage, x, len(out)).astype(np.float32) / full

    size = (ends - starts).astype(np.float64)
    salted = hashes ^ mix(row.astype(np.uint64) + SALTS[9])
    _, where = np.unique(salted, return_index=True)
    new_word = np.zeros(len(hashes))
    new_word[where] = 1
    triple = salted[:-2] * SALTS[0] + salted[1:-1] * SALTS[1] + salted[2:] * SALTS[2] if len(hashes) > 2 else salted[:0]
    _, where = np.unique(triple, return_index=True)
    new_triple = np.zeros(len(hashes))
    new_triple[where] = 1
    new_triple[len(triple) :] = 1
    same = np.zeros(len(hashes))
    same[1:] = salted[1:] == salted[:-1]
    mean = mean_of(size)
    extra = (mean / 10, np.sqrt(np.maximum(mean_of(size**2) - mean**2, 0)) / 10, mean_of(new_word), mean_of(new_triple), mean_of(same), words / passage_words, np.minimum(np.log1p(per_row) / 10, 2)[np.repeat(np.arange(len(per_row)), count)])
    for k, x in enumerate(extra):
        out[:, _CLASSES * _CLASSES + k] = x
    return out, first


class GatedAttention:
    """The model: embedding, gated attention over a bag, and a logistic score."""

    def __init__(self, n_in: int, embed: int = 24, gate: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale, self.constant = np.zeros(n_in, np.float32), np.ones(n_in, np.float32), None
        shapes = {"E": (n_in, embed), "e": (embed,), "V": (embed, gate), "G": (embed, gate), "u": (gate,), "c": (embed,), "b": (1,)}
        self.p = {k: (r.normal(0, 1 / np.sqrt(s[0]), s) if len(s) == 2 or k == "u" else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, heads = self.p, first[:-1]
        size = np.diff(first)
        h = np.tanh((x - self.mean) / self.scale @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["G"])))
        s = (t * g) @ p["u"]
        a = np.exp(s - np.repeat(np.maximum.reduceat(s, heads), size))
        a /= np.repeat(np.add.reduceat(a, heads), size)
        z = np.add.reduceat(a[:, None] * h, heads, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": y}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return self._forward(x, first)["y"].astype(np.float64)

    def fit(self, x: np.ndarray, first: np.ndarray, labels: np.ndarray, epochs: int = 250, rate: float = 0.02, decay: float = 1e-4) -> GatedAttention:
        if len(set(labels.tolist())) < 2:
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.02
        size, heads, n, p = np.diff(first), first[:-1], len(labels), self.p
        m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
        scaled = (x - self.mean) / self.scale
        for step in range(1, epochs + 1):
            f = self._forward(x, first)
            h, t, g, a = f["h"], f["t"], f["g"], f["a"]
            dy = ((f["y"] - labels) / n).astype(np.float32)
            dz = np.repeat(dy, size)[:, None] * p["c"]
            da = (dz * h).sum(axis=1)
            ds = a * (da - np.repeat(np.add.reduceat(a * da, heads), size))
            dtg = ds[:, None] * p["u"]
            dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
            dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["G"].T) * (1 - h * h)
            grad = {"E": scaled.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "G": h.T @ dg, "u": (t * g).T @ ds, "c": f["z"].T @ dy, "b": dy.sum(keepdims=True)}
            for k, w in p.items():
                d = grad[k] + decay * w
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                w -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the doc_id as text is divisible by ``folds``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, folds: int = 5, passages: int = 512) -> GatedAttention:
    """Learn from at most ``sample`` labelled documents outside the held-out fold.

    A document of more than ``passages`` passages is learnt from so many, evenly
    spread; scores always see all.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(folds=folds))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                x, first = encode_passages(*text_buffer(rows.column(1)))
                kept = [x[a:b][np.linspace(0, b - a - 1, min(b - a, passages)).astype(np.int64)] for a, b in zip(first, first[1:], strict=False)]
                bag = pa.array([k.tobytes() for k in kept], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), bag], names=["doc_id", "quality", "bag"])

    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", F.col("quality").cast("int"))
    rows = texts.mapInArrow(bags, "doc_id long, quality int, bag binary").toArrow().sort_by("doc_id").to_pydict()
    x = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in rows["bag"]]
    first = np.concatenate([[0], np.cumsum([len(b) for b in x])]).astype(np.int64)
    return GatedAttention(N_FEATURES).fit(np.concatenate(x) if x else np.zeros((0, N_FEATURES), np.float32), first, np.array(rows["quality"], np.float32))


def score_quality(docs: DataFrame, model: GatedAttention) -> DataFrame:
    """``docs`` with _score (a column of that name is replaced); the text is the only input."""
    docs = docs.drop("_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for rows in text_slices(batch):
                x, first = encode_passages(*text_buffer(rows.column(at)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(shared.value.score(x, first), pa.float64())], names=[*rows.schema.names, "_score"])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))
