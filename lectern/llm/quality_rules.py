"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

A base rule rejects texts of under 10 words, or with over a fifth of their words
in repeated five-word windows. Beyond it, each stratum (language) gets a cutoff
on the largest of four shares (symbols per word character, equal lines, words in
repeated windows, capitals) that labelled holdouts justify. Candidates are tried
from the mildest on, and one passes if an exact binomial bound shows that at
most ``risk`` of the stratum's good documents lie beyond it in any measure:
P(Bin(n, risk) <= k) <= level / tests, where k of n labelled good documents lie
beyond. The level is shared among all strata and their pool (Bonferroni); within
one, the fixed order from mild to strict with a stop at the first failure needs
no further share. The strictest that passed applies.

``labels_needed`` good labels are the least that can justify anything; strata
with fewer are pooled, and share the cutoff that their labels justify together
(the bound then holds for the pool, not for each of its strata).

Only counts of each stratum are gathered. Texts never leave their row: windows
are hashed to 64 bits, sorted, and compared within the row.

Defined results: a null text has no words (base_failed); a null language is a
stratum of its own; repeated rows are judged each; of several labels of one
doc_id the smallest counts, null labels and doc_ids do not; without labels, or
with too few in the pool, no cutoff applies; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import materialize, words_of

#: Measures: (name, numerator, denominator), and candidate cutoffs on them all, from mild to strict.
MEASURES = [("symbols", "n_symbols", "word_chars"), ("dup_lines", "n_dup_lines", "n_lines"), ("repeats", "n_repeat_words", "n_words"), ("capitals", "n_capitals", "word_chars")]
CUTOFFS = [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03]
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def measure(docs: DataFrame, window: int = 5) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def lost(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")

    out = docs.withColumns({"_w": words_of(F.col("text")), "_l": F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))})
    out = out.withColumns({"n_words": F.size("_w").cast("long"), "n_lines": F.size("_l").cast("long"), "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long")})
    out = out.withColumns({"word_chars": F.length(text).cast("long") - lost(" \t\n\x0b\x0c\r"), "n_symbols": lost(SYMBOLS), "n_capitals": lost(CAPITALS)})
    places = F.when(F.col("n_words") >= window, F.sequence(F.lit(0), (F.col("n_words") - window).cast("int"))).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("_h", F.transform(places, lambda i: F.xxhash64(*(F.get("_w", i + k) for k in range(window))))).drop("_w", "_l")
    out = out.withColumn("_s", F.sort_array("_h"))
    out = out.withColumn("_twice", F.exists(F.transform("_s", lambda x, i: x == F.get("_s", i + 1)), lambda same: same))
    # texts with a repeated window only: order windows by hash, take those with an equal neighbour, by place
    out = out.withColumn("_o", F.when(F.col("_twice"), F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("_h", "_s")
    near = F.filter("_o", lambda x, i: (x["h"] == F.get("_o", i + 1)["h"]) | ((i > 0) & (x["h"] == F.get("_o", i - 1)["h"])))
    out = out.withColumn("_p", F.sort_array(F.transform(near, lambda x: x["i"]))).drop("_o")
    covered = F.aggregate(F.transform("_p", lambda p, i: F.least(F.lit(window), F.coalesce(F.get("_p", i + 1) - p, F.lit(window)))), F.lit(0), lambda a, n: a + n)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_p", "_twice")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _beyond(cutoff: Column | float) -> Column:
    """Whether any measure exceeds the cutoff."""
    out = F.lit(False)
    for _, part, whole in MEASURES:
        out = out | (F.col(part) > cutoff * F.col(whole))
    return out


def _log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k), term by term in logarithms."""

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + math.log(p / (1 - p))
        return F.struct(term.alias("term"), (F.greatest(acc["sum"], term) + F.log1p(F.exp(-F.abs(acc["sum"] - term)))).alias("sum"))

    none = n * math.log(1 - p)
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(none.alias("term"), none.alias("sum")), step, lambda acc: acc["sum"])


def labels_needed(strata: int, risk: float, level: float) -> int:
    """The good labels without which no cutoff can pass, even if none lies beyond it."""
    return math.ceil(math.log(level / (strata + 1)) / math.log(1 - risk))


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.02, level: float = 0.05) -> DataFrame:
    """lang, labels (good ones that decided), pooled, and the strictest justified cutoff (null: none)."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = measured.join(good, "doc_id", "left_semi")
    counts = [f"k_{c}" for c in range(len(CUTOFFS))]
    strata = held.groupBy("lang").agg(F.count("*").alias("n"), *(F.count_if(_beyond(x)).alias(k) for k, x in zip(counts, CUTOFFS, strict=True)))
    strata = materialize(strata, "strata")
    found = strata.count()
    pooled = strata.withColumn("pooled", F.col("n") < labels_needed(found, risk, level))
    together = Window.partitionBy("pooled")
    for c in ("n", *counts):
        pooled = pooled.withColumn(c, F.when(F.col("pooled"), F.sum(c).over(together)).otherwise(F.col(c)))
    cutoff = F.lit(None).cast("double")
    for k, x in reversed(list(zip(counts, CUTOFFS, strict=True))):  # from the strictest in, so that the mildest is asked first
        bound = _log_binomial_cdf(F.col(k), F.col("n"), risk) <= math.log(level / (found + 1))
        cutoff = F.when((F.col(k) < F.col("n") * risk) & bound, F.coalesce(cutoff, F.lit(x)))
    return pooled.select("lang", F.col("n").alias("labels"), "pooled", cutoff.alias("cutoff"))


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, level: float = 0.05, most_strata: int = 10_000) -> DataFrame:
    """doc_id, lang, the measures, cutoff, base_failed and kept of each document."""
    measured = materialize(measure(docs.select("doc_id", "lang", "text")).drop("text"), "measures")
    cutoffs = choose_cutoffs(measured, labels, risk, level).select(F.col("lang").alias("stratum"), "cutoff")
    cutoffs = materialize(cutoffs, "cutoffs")
    if cutoffs.count() <= most_strata:
        cutoffs = F.broadcast(cutoffs)
    joined = measured.join(cutoffs, measured["lang"].eqNullSafe(F.col("stratum")), "left")
    rejected = base_failed() | F.coalesce(_beyond(F.col("cutoff")), F.lit(False))
    return joined.withColumns({"base_failed": base_failed(), "kept": ~rejected}).drop("stratum")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every document."""
    out = apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_OVER = " OR ".join(f"{part} > cut * {whole}" for _, part, whole in MEASURES)
OP3_SQL = rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
f AS (SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, CAST(length(text) - length(translate(text, '{CAPITALS}', '')) AS BIGINT) AS n_capitals,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines FROM t),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
m AS (SELECT f.*, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words FROM f LEFT JOIN cov USING (doc_id)),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
cand AS (SELECT * FROM (VALUES {", ".join(f"({i}, CAST({x} AS DOUBLE))" for i, x in enumerate(CUTOFFS))}) AS c(o, cut)),
raw AS (SELECT lang, o, cut, count(*) AS n, count(*) FILTER (WHERE {_OVER}) AS k FROM m JOIN good USING (doc_id), cand GROUP BY ALL),
tests AS (SELECT 1 + count(DISTINCT coalesce(lang, chr(0))) AS tests FROM raw),
sized AS (SELECT raw.*, tests, n < ceil(ln(0.05 / tests) / ln(0.98)) AS pooled FROM raw, tests),
tried AS (SELECT lang, o, cut, tests, CAST(CASE WHEN pooled THEN sum(n) OVER p ELSE n END AS BIGINT) AS n, CAST(CASE WHEN pooled THEN sum(k) OVER p ELSE k END AS BIGINT) AS k FROM sized WINDOW p AS (PARTITION BY pooled, o)),
judged AS (SELECT lang, o, cut, CASE WHEN k >= n * 0.02 THEN FALSE ELSE (SELECT sum(exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98))) FROM (SELECT unnest(range(0, k + 1)) AS i)) <= 0.05 / tests END AS ok FROM tried),
best AS (SELECT lang, min(cut) AS cut FROM judged j WHERE ok AND NOT EXISTS (SELECT 1 FROM judged x WHERE x.lang IS NOT DISTINCT FROM j.lang AND x.o < j.o AND NOT x.ok) GROUP BY ALL),
verdict AS (SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, cut IS NOT NULL AND ({_OVER}) AS beyond FROM m LEFT JOIN best ON m.lang IS NOT DISTINCT FROM best.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR beyond) AS kept FROM verdict
"""
