"""Benchmark decontamination by spaced-seed hashing.

Words are runs of letters and digits, A-Z lower-cased. Each of the fixed `MASKS` looks at some positions
of a short window and ignores the others, so a copied passage with substituted words still shares
hashes. Hashes of all benchmark windows are joined with those of all document windows; every hit lines
the item up with the document at one offset, and the offset is verified around the hit: over the
`SPAN` = 20 item words about it (the whole item if shorter), at least `SHARE` = 80 % of the words must be
equal in place. A document with a verified hit is contaminated.

All DataFrame functions. The document side is never shuffled while the benchmark's hashes are few
enough to broadcast (their rows are counted). A first join on the two words that every mask starts with
thins positions before the masks are hashed; beyond the bound it shuffles places and hashes only, and
texts come back for the places that are left. Hits are verified in place and summed per document and item.

Short items: from 5 to `MIN_ITEM` - 1 = 7 words they are found where all their words stand; shorter ones
(down to one word, which anybody may write) only in a document that consists of just these words.

Results for odd input: null or empty texts are never contaminated; null doc_ids keep their rows (hits
are joined by a row's id and the hash of its text); items without words are not searched for; an item
without an id is reported as "text:" and the hash of its words; repeated items and tied ids report each
item id once; an empty benchmark leaves all clean; an empty table gives an empty result; other columns
are kept by `decontaminate`, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_ALNUM, cut, free_names, guarded, lower_ascii, words

#: Fixed masks: 1 looks at a word, 0 ignores it. All start with two ones.
MASKS = ("11011", "1100101", "11010001")
SPAN = 20
SHARE = 80
MIN_ITEM = 8
#: Rows of the benchmark's hashed windows, and of its word pairs, up to which they are broadcast.
SEED_ROWS, PAIR_ROWS = 200_000, 1_000_000


def _seed(w: str, at: Column, mask: str) -> Column:
    return F.xxhash64(*[F.get(w, at + k) for k, bit in enumerate(mask) if bit == "1"])


def _positions(n: Column) -> Column:
    return F.when(n >= 5, F.sequence(F.lit(0), n - 5))


def _items(bench: DataFrame) -> DataFrame:
    """(item, w): the words of every different item; item: its id, and the hash of its words if it has none."""
    b = bench.select("item_id", words(lower_ascii(F.col("text")), NOT_ALNUM).alias("w")).distinct()
    return b.select(F.struct("item_id", F.when(F.col("item_id").isNull(), F.xxhash64("w")).alias("text")).alias("item"), "w")


def benchmark_seeds(bench: DataFrame) -> DataFrame:
    """(item, seed, mask, q, iw): each window of each item; iw the hashes of the words that verification compares, q the place of the window in it."""
    b = _items(bench).withColumn("n", F.size("w")).where(F.col("n") >= 5)
    b = b.select("item", "w", "n", F.explode(_positions(F.col("n"))).alias("p"))
    masks = F.explode(F.array(*[F.struct(F.lit(k).alias("mask"), F.lit(len(m)).alias("len"), _seed("w", F.col("p"), m).alias("seed")) for k, m in enumerate(MASKS)])).alias("m")
    pair = F.xxhash64(F.get("w", F.col("p")), F.get("w", F.col("p") + 1)).alias("pair")
    s = b.select("item", "w", "n", "p", pair, masks).select("item", "w", "n", "p", "pair", "m.*").where("p + len <= n")
    start = F.greatest(F.lit(0), F.least(F.col("p") - (SPAN - 8) // 2, F.col("n") - SPAN))
    s = s.withColumn("start", start)
    around = F.transform(F.slice("w", F.col("start") + 1, F.lit(SPAN)), lambda x: F.xxhash64(x))
    return s.select("item", "mask", "seed", "pair", (F.col("p") - F.col("start")).alias("q"), around.alias("iw"))


def _places(d: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, w, p) of the places of `d` (*keys, w) whose two words start a window of the benchmark."""
    pair = F.xxhash64(F.get("w", F.col("p")), F.get("w", F.col("p") + 1)).alias("pair")
    if pairs.limit(PAIR_ROWS + 1).count() <= PAIR_ROWS:
        spots = d.select(*keys, "w", F.explode(_positions(F.size("w"))).alias("p")).withColumn("pair", pair)
        return spots.join(F.broadcast(pairs), "pair", "left_semi").drop("pair")
    spots = d.select(*keys, "w", F.explode(_positions(F.size("w"))).alias("p")).select(*keys, "p", pair).join(pairs, "pair", "left_semi")
    found = cut(spots.groupBy(*keys).agg(F.collect_set("p").alias("ps")))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    return d.alias("d").join(found.alias("f"), same).select("d.*", F.explode("f.ps").alias("p"))


def hits(docs: DataFrame, bench: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, item, matched): the best share (percent) of equal words of verified hits, per row key and item."""
    seeds = cut(benchmark_seeds(bench))
    d = docs.select(*keys, words(lower_ascii(F.col("text")), NOT_ALNUM).alias("w"))
    short = _items(bench).where("size(w) between 1 and 4").select("item", F.xxhash64("w").alias("all"), F.col("w").alias("iw"))
    brief = d.where("size(w) between 1 and 4").withColumn("all", F.xxhash64("w")).join(guarded(cut(short), SEED_ROWS), "all").where("w = iw")
    d = _places(d, cut(seeds.select("pair").distinct()), keys)
    # the words that any verification at this place can need, so that no later row carries a whole text
    d = d.select(*keys, F.least(F.col("p"), F.lit(SPAN)).alias("c"), F.slice("w", F.greatest(F.col("p") - SPAN, F.lit(0)) + 1, F.lit(2 * SPAN + 8)).alias("w"))
    masks = F.explode(F.array(*[F.struct(F.lit(k).alias("mask"), _seed("w", F.col("c"), m).alias("seed")) for k, m in enumerate(MASKS)])).alias("m")
    d = d.select(*keys, "c", "w", masks).select(*keys, "c", "w", "m.*").join(guarded(seeds.drop("pair"), SEED_ROWS), ["mask", "seed"])
    first = F.col("c") - F.col("q")
    same = F.aggregate(F.sequence(F.lit(0), F.size("iw") - 1), F.lit(0), lambda a, k: a + F.coalesce(F.when(first + k >= 0, F.xxhash64(F.get("w", first + k)) == F.get("iw", k)).otherwise(F.lit(False)), F.lit(False)).cast("int"))
    d = d.withColumn("matched", F.floor(100 * same / F.size("iw")).cast("int")).where(F.col("matched") >= F.when(F.size("iw") < MIN_ITEM, 100).otherwise(SHARE))
    found = d.select(*keys, "item", "matched").unionByName(brief.select(*keys, "item", F.lit(100).alias("matched")))
    return found.groupBy(*keys, "item").agg(F.max("matched").alias("matched"))


def contamination(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, items, matched) for every row of `docs`; items: ids, sorted, comma-joined."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    found = hits(rows, bench, ["doc_id", "h"]).groupBy("doc_id", "h")
    found = cut(found.agg(F.sort_array(F.collect_list("item")).alias("found"), F.max("matched").alias("most")).toDF("id", "th", "found", "most"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("h").eqNullSafe(F.col("th"))
    out = rows.drop("text").join(guarded(found, 100_000), same, "left")
    named = F.transform("found", lambda x: F.coalesce(x["item_id"].cast("string"), F.concat(F.lit("text:"), F.lower(F.hex(x["text"])))))
    items = F.coalesce(named, F.array().cast("array<string>"))
    return out.select("doc_id", F.col("found").isNotNull().alias("contaminated"), F.size(items).cast("long").alias("n_items"), F.array_join(items, ",").alias("items"), F.coalesce("most", F.lit(0)).alias("matched"))


def decontaminate(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark passage, with their columns."""
    i, h = free_names(docs, "id", "h")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    gone = cut(hits(rows, bench, ["doc_id", "h"]).select("doc_id", "h").distinct().toDF(i, h))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & F.xxhash64("text").eqNullSafe(F.col(h))
    return docs.join(guarded(gone), same, "left_anti")
