"""Quality rules: plain counts of every text, and an n-gram likelihood ratio that decides.

Two multinomials over hashed n-grams are counted: one over trusted documents (labelled quality 1), one
over the whole raw corpus. The n-grams are single words (lower case) and pairs of neighbouring word
shapes (runs of lower-case letters, capitals and digits shortened to one sign each), hashed into two
halves of `BUCKETS`. A document's score is the mean log-likelihood ratio of its n-grams, target against
raw, so length does not matter; it is kept if the score is at least `THRESHOLD` and no base rule fails.
Nothing is drawn at random: the same corpus gives the same verdicts.

All of it is DataFrame functions. Counts meet per bucket before they are shuffled, so no word, source
or document is ever gathered in one task; only the BUCKETS weights reach the driver.

Results for odd input: null, empty or blank text has zero counts, a null score and fails (fewer than 10
words); null doc_ids and repeated rows keep their rows; an empty table gives an empty result; without
any trusted document every weight is 0, so the base rules alone decide; other columns are ignored by
`quality` and kept by `quality_filter`, whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_names, guarded, literal_doubles, words

BUCKETS = 1 << 15
#: Mean nats per n-gram; ordinary text scores near 0, text of another make well below.
THRESHOLD = -1.0
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SMOOTHING = 1.0
WINDOW = 5


def shapes(text: Column) -> Column:
    """`text` with each run of lower-case letters, capitals or digits shortened to a, A or 0."""
    for run, sign in (("[\\p{Ll}\\p{Lo}\\p{M}]+", "a"), ("\\p{Lu}+", "A"), ("\\p{N}+", "0")):
        text = F.regexp_replace(text, run, sign)
    return text


def _grams(w: str, s: str, i: str) -> tuple[Column, Column]:
    """Buckets of word i, and of the shapes of words i and i + 1 (the last shape stands alone)."""
    half = F.lit(BUCKETS // 2)
    one = F.pmod(F.xxhash64(F.lower(F.get(w, F.col(i)))), half)
    two = half + F.pmod(F.xxhash64(F.get(s, F.col(i)), F.get(s, F.col(i) + 1)), half)
    return one, two


def _split(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_w": words(F.col("text")), "_s": words(shapes(F.coalesce("text", F.lit(""))))})


def weights(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """The log ratio of every bucket. `trusted`: doc_id of trusted documents; it may name others too."""
    ids = trusted.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()
    flagged = docs.select("doc_id", "text").join(guarded(ids), F.col("doc_id") == F.col("_id"), "left")
    spots = _split(flagged).select("_w", "_s", F.col("_id").isNotNull().cast("long").alias("_t")).where("size(_w) > 0")
    spots = spots.select("_w", "_s", "_t", F.explode(F.sequence(F.lit(0), F.size("_w") - 1)).alias("_i"))
    grams = spots.select("_t", F.explode(F.array(*_grams("_w", "_s", "_i"))).alias("b"))
    target, raw = [0] * BUCKETS, [0] * BUCKETS
    for b, t, r in grams.groupBy("b").agg(F.sum("_t").alias("t"), F.count("*").alias("r")).collect():  # at most BUCKETS rows
        target[b], raw[b] = t, r
    if not sum(target):
        return [0.0] * BUCKETS
    t_all, r_all = sum(target) + SMOOTHING * BUCKETS, sum(raw) + SMOOTHING * BUCKETS
    return [math.log((t + SMOOTHING) / t_all) - math.log((r + SMOOTHING) / r_all) for t, r in zip(target, raw)]


def base(docs: DataFrame) -> DataFrame:
    """`docs` plus _w, _s and the base columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    d = _split(docs).withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
            "_l": lines,
        }
    )
    at = F.when(F.size("_w") >= WINDOW, F.sequence(F.lit(0), F.size("_w") - WINDOW)).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
    d = d.withColumn("_g", F.transform(at, lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(WINDOW)])))
    d = d.withColumn("_r", F.size(F.array_distinct("_g")) < F.size("_g"))
    pairs = F.sort_array(F.transform("_g", lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    d = d.withColumn("_p", F.when(F.col("_r"), pairs))
    twice = F.filter("_p", lambda e, k: F.coalesce(F.get("_p", k - 1)["g"] == e["g"], F.lit(False)) | F.coalesce(F.get("_p", k + 1)["g"] == e["g"], F.lit(False)))
    d = d.withColumn("_q", F.when(F.col("_r"), F.sort_array(F.transform(twice, lambda e: e["i"]))))
    covered = F.aggregate(
        "_q",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    d = d.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_r"), covered), F.lit(0)).cast("long"))
    return d.drop("_l", "_g", "_r", "_p", "_q")


def quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, keys: list[str] | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text): `keys` (doc_id), the base columns, base_failed, score, kept."""
    table = literal_doubles(weights(docs, trusted))
    own = keys or ["doc_id"]
    keys = ["_row", *own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    d = base(docs.select(*own, "text")).withColumn("_row", F.monotonically_increasing_id())
    spots = d.select(*keys, "_w", "_s", F.explode_outer(F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - 1))).alias("_i"))
    one, two = _grams("_w", "_s", "_i")
    parts = spots.select(*keys, (F.get(table, one.cast("int")) + F.get(table, two.cast("int"))).alias("_x"))
    out = parts.groupBy(*keys).agg((F.sum("_x") / (2 * F.count("_x"))).alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))).drop("_row")


def quality_filter(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that `quality` keeps, with their columns.

    Rejected rows are found by doc_id and a hash of the text, so rows that share a doc_id, or have
    none, are each judged by their own text. Texts are shuffled only if the rejected are too many to
    broadcast.
    """
    i, h = free_names(docs, "id", "h")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    gone = quality(hashed, trusted, threshold, keys=["doc_id", "h"]).where("not kept")
    gone = cut(gone.select("doc_id", "h").distinct().toDF(i, h))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & F.xxhash64("text").eqNullSafe(F.col(h))
    return docs.join(guarded(gone), same, "left_anti")
