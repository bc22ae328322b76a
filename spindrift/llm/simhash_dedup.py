"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64-bit SimHashes of 3-word shingles. Two fingerprints at `radius` = 3 or fewer
differing bits are linked. Candidate search is the covering construction of Pagh ("Locality-sensitive
Hashing without False Negatives", 2016): every bit position gets a nonzero vector of 4 bits; table v
(15 of them) keeps the bits whose vector has an odd product with v. Three vectors of 4 bits always have
a common orthogonal v, so any pair within the radius agrees on all kept bits of some table.

A bucket of at most `BUCKET` fingerprints is searched by popcount in one task and gives a spanning
forest of its links, never all pairs. A larger bucket is dealt out again by the same construction over
the bits its table ignores (up to 32); a bucket of that second level has at most 2**16 different
fingerprints, as up to 16 bits are ignored by both masks, which bounds it whatever the data: half a MB in
one task, searched in 2**16 vector steps. Exact copies are one fingerprint from the start.

Results for odd input: null, empty or blank text has fingerprint zero; rows with a null doc_id are kept
and get the component of their fingerprint (null if no member has an id); repeated rows and tied ids
each keep a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, guarded
from .components import components

RADIUS = 3
BITS = 64
BUCKET = 2_000
CHUNK = 8_192


def simhash(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(3, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[size - 1 :]
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, dtype=np.int64), len(ends)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([simhash(t) for t in b["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, fp bigint")


def covering(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over these bit positions such that any `radius` of the positions are all left out of one."""
    top = 2 ** (radius + 1)
    vec = {b: k % (top - 1) + 1 for k, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vec[b] & v).bit_count() % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


MASKS = covering(list(range(BITS)))
#: For each mask, the masks of the second level: over the bits that the first ignores.
SECOND = [[m | second for second in covering([b for b in range(BITS) if not m >> b & 1])] for m in MASKS]


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect all that is connected by links within `values` (different signed longs)."""
    v = np.sort(values).view(np.uint64)
    label, out = np.arange(len(v)), []
    for i in range(1, len(v)):
        near = np.nonzero(np.bitwise_count(v[:i] ^ v[i]) <= radius)[0]
        if len(near):
            found, first = np.unique(label[near], return_index=True)
            out += [(int(v[i].view(np.int64)), int(v[near[k]].view(np.int64))) for k in first]
            label[: i + 1][np.isin(label[: i + 1], [*found, i])] = found[0]
    return out


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for group in b["fps"]:
            pairs = forest(np.asarray(group, dtype=np.int64))
            if pairs:
                yield pd.DataFrame(pairs, columns=["u", "v"])


def _buckets(fps: DataFrame, masks: list[int]) -> DataFrame:
    tables = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks)])
    return fps.select("fp", F.explode(tables).alias("b")).select("fp", "b.t", "b.key")


def _linked(groups: DataFrame) -> DataFrame:
    return groups.groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("fps").mapInPandas(_search, "u bigint, v bigint")


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between different fingerprints that connect what links within the radius connect.

    `fps`: column fp, different values, cheap to read twice.
    """
    first = _buckets(fps, MASKS)
    big = cut(first.groupBy("t", "key").count().where(F.col("count") > bucket).select("t", "key"))
    if big.isEmpty():
        return _linked(first)
    few = guarded(big)
    small = first.join(few, ["t", "key"], "left_anti")
    again = [m for second in SECOND for m in second]
    per = len(SECOND[0])
    hot = first.join(few, ["t", "key"], "left_semi").select("fp", F.explode(F.sequence(F.col("t") * per, F.col("t") * per + per - 1)).alias("t"))
    mask = F.element_at(F.array(*[F.lit(_signed(m)) for m in again]), F.col("t") + 1)
    hot = hot.select("fp", (F.col("t") + len(MASKS)).alias("t"), F.col("fp").bitwiseAND(mask).alias("key"))
    return _linked(small).unionByName(_linked(hot))


def simhash_components(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) for every row of `docs` (doc_id, text)."""
    rows = cut(fingerprints(docs))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    parts = components(links(fps.select("fp"), bucket), "u", "v").withColumnRenamed("node", "fp")
    rooted = fps.join(parts, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The rows of `docs` but for all except the least doc_id of each component; columns as they are.

    Rows that share the least doc_id: one stays (the least text, then the other columns). Rows with a
    null doc_id stay only if their component has no id, one for each fingerprint component.
    """
    found = cut(simhash_components(docs, bucket).where(F.col("component_id").eqNullSafe(F.col("doc_id"))).select("doc_id", "fp"))
    keep = found.groupBy("doc_id").count()
    once = cut(keep.where("doc_id is not null and count = 1").select("doc_id"))
    more = cut(keep.where("doc_id is null or count > 1").select("doc_id"))
    out = docs.join(guarded(once), "doc_id", "left_semi")
    if more.isEmpty():
        return out
    tied = docs.alias("d").join(F.broadcast(more.limit(1000)).alias("m") if more.limit(1001).count() <= 1000 else more.alias("m"), F.expr("d.doc_id <=> m.doc_id"), "left_semi")
    order = F.struct(F.coalesce("text", F.lit("")).alias("t"), F.to_json(F.struct(*[F.col(c) for c in docs.columns])).alias("j"))
    one = tied.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("r")).select("r.*")
    return out.unionByName(one)
