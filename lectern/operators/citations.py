"""Citations in drafts: the gate, numbering, outlines, claims and their support."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import blank_code, citations, distinctive_words

WEAK, SUPPORTED = 0.20, 0.50


def cited(drafts: DataFrame) -> DataFrame:
    """draft_id, offset, place, line, citekey of every citation. ``drafts``: draft_id, text."""
    drafts = blank_code(drafts.select("draft_id", "text"), "text")
    return drafts.select("draft_id", F.explode(citations("text")).alias("c")).select("draft_id", "c.*")


def gate(mentions: DataFrame, known: DataFrame) -> DataFrame:
    """Mentions of citekeys that aren't known; lines and repetitions are kept."""
    return mentions.join(known.select("citekey"), "citekey", "left_anti")


def gate_summary(mentions: DataFrame, known: DataFrame, drafts: DataFrame | None = None) -> DataFrame:
    """draft_id, total, unknown, ok. With ``drafts`` (draft_id) those that cite nothing are there too, and are ok."""
    marked = mentions.join(known.select("citekey").distinct().withColumn("known", F.lit(True)), "citekey", "left")
    out = marked.groupBy("draft_id").agg(F.count("*").alias("total"), F.count_if(F.col("known").isNull()).alias("unknown"))
    if drafts is not None:
        zero = F.lit(0).cast("long")
        out = drafts.select("draft_id").distinct().join(out, "draft_id", "left").select("draft_id", F.coalesce("total", zero).alias("total"), F.coalesce("unknown", zero).alias("unknown"))
    return out.withColumn("ok", F.col("unknown") == 0)


def verdict(mentions: DataFrame, known: DataFrame, drafts: DataFrame) -> DataFrame:
    """One row for all drafts: drafts, citations, unknown, failing (drafts) and passes (whether none is unknown)."""
    rows = gate_summary(mentions, known, drafts)
    zero = F.lit(0).cast("long")
    out = rows.agg(F.count("*").alias("drafts"), F.coalesce(F.sum("total"), zero).alias("citations"), F.coalesce(F.sum("unknown"), zero).alias("unknown"), F.count_if(~F.col("ok")).alias("failing"))
    return out.withColumn("passes", F.col("unknown") == 0)


def numbering(mentions: DataFrame) -> DataFrame:
    """Number of each citekey of a draft by first appearance."""
    first = mentions.groupBy("draft_id", "citekey").agg(F.min(F.struct("offset", "place")).alias("at"))
    return first.select("draft_id", "citekey", F.row_number().over(Window.partitionBy("draft_id").orderBy("at")).alias("number"))


def outline(lines: DataFrame) -> DataFrame:
    """draft_id, title, start, stop of each heading. ``lines``: draft_id, line, title (null: no heading)."""
    ends = lines.groupBy("draft_id").agg(F.max("line").alias("last"))
    heads = lines.where("title is not null").withColumn("after", F.lead("line").over(Window.partitionBy("draft_id").orderBy("line")))
    return heads.join(ends, "draft_id").select("draft_id", "title", F.col("line").alias("start"), F.coalesce(F.col("after") - 1, "last").alias("stop"))


def support(claims: DataFrame, passages: DataFrame) -> DataFrame:
    """claim_id, score and passage: the share of a claim's words in its best passage, the earliest on ties.

    ``claims``: claim_id, citekey, claim; ``passages``: citekey, ord, text. No
    common word: score 0 and no passage.
    """
    words = claims.select("claim_id", "citekey", distinctive_words("claim").alias("cw"))
    pairs = words.join(passages.select("citekey", "ord", distinctive_words("text").alias("pw")), "citekey", "left")
    share = F.when((F.size("cw") > 0) & F.col("pw").isNotNull(), F.size(F.array_intersect("cw", "pw")) / F.size("cw")).otherwise(0.0)
    best = pairs.withColumn("share", share).groupBy("claim_id").agg(F.max("share").alias("score"), F.max_by("ord", F.struct("share", -F.col("ord"))).alias("ord"))
    return best.select("claim_id", F.round("score", 6).alias("score"), F.when(F.col("score") > 0, F.col("ord")).alias("passage"))


def band(score: str = "score"):
    return F.when(F.col(score) < WEAK, "none").when(F.col(score) < SUPPORTED, "weak").otherwise("supported")


def provenance(claims: DataFrame, passages: DataFrame, known: DataFrame) -> DataFrame:
    """The claims with score, band, passage and note, worst first: (score, line).

    ``claims``: draft_id, line, place, citekey, claim; ``passages``: citekey,
    ord, text; ``known``: citekey. A key without passages says why in ``note``.
    """
    rows = claims.withColumn("claim_id", F.struct("draft_id", "place", "citekey"))
    scored = support(rows.select("claim_id", "citekey", "claim"), passages)
    have = passages.select("citekey").distinct().withColumn("readable", F.lit(True))
    there = known.select("citekey").distinct().withColumn("listed", F.lit(True))
    out = rows.join(scored, "claim_id").join(have, "citekey", "left").join(there, "citekey", "left")
    note = F.when(F.col("listed").isNull(), "not in the ledger").when(F.col("readable").isNull(), "no text to read")
    order = Window.partitionBy("draft_id").orderBy("score", "line", "place")
    return out.select("draft_id", F.row_number().over(order).alias("rank"), "line", "citekey", "claim", "score", band().alias("band"), "passage", note.alias("note"))
