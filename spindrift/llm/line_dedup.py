"""Line dedup by an exact set-similarity join.

A line is a piece between newlines of a text; its tokens are its different lower-case words. A line with
tokens goes if an earlier line (by doc_id, then line number) has the same tokens or tokens at Jaccard
similarity `SIMILARITY` = 0.8 or more. It goes whether or not the earlier line goes itself, so the result
does not depend on the order of work. Sets of fewer than `LEAST_NEAR` = 4 tokens are similar only to equal
ones, so they need no prefix rows; one of 4 can be similar to one of 5.

The join follows PPJoin (Xiao et al., 2008). Tokens are ordered by rarity: word counts over the whole
corpus, kept per hash bucket, give each token a rarity class; the class and 57 bits of hash make its key.
Any common order is exact; rarity only keeps prefix groups small. Pairs must share a key of their
prefixes, and pass the length filter, the positional filter and a parity sketch of the keys (two sketches
differ in no more bits than the sets in tokens; compare the bitmap filter of Sandes et al., 2017). The
sketch has 64, 128 or 256 bits by the size of the set, as few bits do not tell large sets apart; two
sketches are compared at the width of the narrower. What is left is verified by the exact Jaccard of keys read again from the lines concerned: of each line's
candidates the earliest first, and the others only where that one fails.

All of it is DataFrame functions; no Python runs on the executors.

Skew: equal lines are one class before any prefix is dealt out. Each class is then held against the
earliest class with the same two extreme hashes of its rarer tokens, for four places of the hashes' range
(a MinHash of two tokens each). A class similar to it is settled, and only unsettled classes search on, so a group of
near copies costs rows in proportion to its size. This only settles early what the search would find too.

Results for odd input: null text has no lines and stays null; empty and blank lines stay; rows with a null doc_id
come last in the order and are judged by it; rows that share an id, or have none, are told apart by the
hash of their text, which also orders their lines of one number (repeats of a whole row are one row to the
order, and keep the same lines); an empty table gives an empty result; columns of other names are left
alone, whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, free_names, guarded, literal_longs

SIMILARITY = 0.8
LEAST_NEAR = 4
BUCKETS = 1 << 17
CLASS_BITS = 57
LOW = (1 << CLASS_BITS) - 1
MIDDLE = 1 << CLASS_BITS - 1
#: Sets of more tokens than these have a sketch of 128, and of 256 bits.
LONG, LONGER = 64, 128
#: Documents and lines up to which the removed line numbers are broadcast to the texts.
SMALL_DOCS, SMALL_LINES = 400_000, 4_000_000
#: Bits of the set's size and of the place in the prefix, which share a long with the rest of a prefix row's key.
SIZE_BITS, PLACE_BITS = 12, 10
PACKED = SIZE_BITS + PLACE_BITS
SKETCH = ["s0", "s1", "s2", "s3"]


def _spaced(text: Column, blanks: str = "\t\x0b\f\r") -> Column:
    """`text` with these white spaces as blanks: those of the ASCII range but newlines."""
    out = text
    for c in blanks:
        out = F.replace(out, F.lit(c), F.lit(" "))
    some = F.contains(text, F.lit(blanks[0]))
    for c in blanks[1:]:
        some = some | F.contains(text, F.lit(c))
    return F.when(some, out).otherwise(text)


def _words(text: Column) -> Column:
    """The lower-case words between blanks (and an empty word wherever two blanks meet)."""
    return F.split(F.lower(text), " ", -1)


def _counts(docs: DataFrame) -> DataFrame:
    """(b, n, odd): of the words in hash buckets 2b and 2b + 1 how many there are, and how many in the latter.

    Two buckets share a row, as 2^16 groups are what the engine's fast map of a task holds.
    """
    spots = docs.select(F.explode(_words(F.replace(_spaced(F.col("text")), F.lit("\n"), F.lit(" ")))).alias("w")).where("w <> ''")
    hashes = spots.select(F.xxhash64("w").alias("x"))
    pairs = hashes.groupBy(F.shiftright("x", 1).bitwiseAND(BUCKETS // 2 - 1).alias("b"))
    return pairs.agg(F.count("*").alias("n"), F.count(F.when(F.col("x").bitwiseAND(1) == 1, 1)).alias("odd"))


def rarity(docs: DataFrame) -> list[int]:
    """The rarity class (0..63, rarest first) of each hash bucket, from the counts of all words."""
    out = [0] * BUCKETS
    for b, n, odd in _counts(docs).collect():  # at most BUCKETS / 2 rows
        for bucket, m in ((2 * b, n - odd), (2 * b + 1, odd)):
            out[bucket] = min(63, int(1.5 * math.log2(max(1, m))))
    return out


def _tokens(line: Column) -> Column:
    """The hashes of a line's tokens."""
    return F.array_distinct(F.array_remove(F.transform(_words(line), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def _keys(tokens: str, classes: list[int]) -> Column:
    """The ordered keys of token hashes."""
    table = literal_longs(classes)
    level = lambda w: F.get(table, w.bitwiseAND(BUCKETS - 1).cast("int"))
    return F.sort_array(F.transform(tokens, lambda w: F.shiftleft(level(w), CLASS_BITS).bitwiseOR(w.bitwiseAND(LOW))))


def _parity(parts: int, part: int) -> Column:
    """The parity of the keys per place of 64, of those keys that fall into one of `parts` parts by the bits above."""

    def turn(a: Column, x: Column) -> Column:
        turned = a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int")))
        return turned if parts == 1 else F.when(x.bitwiseAND(64 * (parts - 1)) == 64 * part, turned).otherwise(a)

    return F.aggregate("keys", F.lit(0).cast("long"), turn)


def _bands() -> Column:
    """Hashes of the two least and the two greatest hashes on each side of `MIDDLE`; `order`: the hashes in order, with MIDDLE at place `mid`."""
    ends = (F.lit(0), F.greatest(F.col("mid") - 3, F.lit(0)), F.col("mid"), F.greatest(F.size("order") - 2, F.lit(0)))  # places from 0
    return F.array(*[F.xxhash64(F.get("order", i), F.get("order", i + 1), F.lit(k)) for k, i in enumerate(ends)])


def _sets(docs: DataFrame, classes: list[int]) -> DataFrame:
    """(doc_id, h, line_no, cls, n, s0..s3, bands, prefix) of every line with tokens; bands and prefix are empty under `LEAST_NEAR` tokens."""
    lines = docs.select("doc_id", "h", F.posexplode(F.split(_spaced(F.col("text")), "\n", -1)).alias("line_no", "line")).where("trim(line) <> ''")
    own = ["doc_id", "h", "line_no"]
    keys = lines.select(*own, F.sort_array(_tokens(F.col("line"))).alias("tokens"))
    keys = keys.select(*own, F.xxhash64("tokens").alias("cls"), _keys("tokens", classes).alias("keys"))
    middle, zero = F.lit(MIDDLE), F.lit(0).cast("long")
    rarer = F.slice("keys", F.lit(1), F.floor((F.size("keys") + 1) / 2).cast("int"))  # common words would bring unlike lines together
    order = F.sort_array(F.array_append(F.transform(rarer, lambda k: k.bitwiseAND(LOW)), middle))
    keys = keys.select(*own, "cls", "keys", order.alias("order")).select("*", F.array_position("order", middle).cast("int").alias("mid"))
    n = F.size("keys")
    sketch = [F.when(n > LONGER, _parity(4, k)).when(n > LONG, _parity(2, k) if k < 2 else zero).otherwise(zero if k else _parity(1, 0)).alias(s) for k, s in enumerate(SKETCH)]
    size = F.when(n >= LEAST_NEAR, n - F.floor((4 * n + 4) / 5).cast("int") + 1).otherwise(0)
    bands = F.when(n >= LEAST_NEAR, _bands()).otherwise(F.array().cast("array<bigint>"))
    return keys.select(*own, "cls", n.alias("n"), *sketch, bands.alias("bands"), F.slice("keys", F.lit(1), size).alias("prefix"))


def _apart(x: str, y: str, nx: Column, ny: Column) -> Column:
    """In how many bits the sketches of x and y differ, at the width of the narrower."""
    both = [F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}")) for s in SKETCH]
    half = [both[0].bitwiseXOR(both[2]), both[1].bitwiseXOR(both[3])]
    bits = [F.bit_count(b) for b in both]
    least = F.least(nx, ny)
    return F.when(least > LONGER, bits[0] + bits[1] + bits[2] + bits[3]).when(least > LONG, F.bit_count(half[0]) + F.bit_count(half[1])).otherwise(F.bit_count(half[0].bitwiseXOR(half[1])))


def _rows(one: DataFrame) -> DataFrame:
    """One row per class and prefix key: k (the key's low bits, the size and the place from 0, packed), sketch, cls.

    A shortened key, or a size at its limit (then with place 0), can only let more pairs through to verification.
    """
    top = (1 << SIZE_BITS) - 1
    d = one.select("cls", "n", *SKETCH, F.posexplode("prefix").alias("at", "key"))
    place = F.when((F.col("n") < top) & (F.col("at") < (1 << PLACE_BITS)), F.col("at")).otherwise(0).cast("long")
    size = F.shiftleft(F.least(F.col("n"), F.lit(top)).cast("long"), PLACE_BITS)
    return d.select(F.shiftleft("key", PACKED).bitwiseOR(size).bitwiseOR(place).alias("k"), *SKETCH, "cls")


def _met(x: DataFrame, y: DataFrame) -> DataFrame:
    """x and y joined on a shared key, thinned by the length, positional and sketch filters."""
    key = lambda s: F.shiftright(F.col(f"{s}.k"), PACKED)
    n = lambda s: F.shiftright(F.col(f"{s}.k"), PLACE_BITS).bitwiseAND((1 << SIZE_BITS) - 1)
    room = lambda s: n(s) - F.col(f"{s}.k").bitwiseAND((1 << PLACE_BITS) - 1)
    both = n("x") + n("y")
    length = 5 * F.least(n("x"), n("y")) >= 4 * F.greatest(n("x"), n("y"))
    near = 9 * _apart("x", "y", n("x"), n("y")) <= both
    return x.alias("x").join(y.alias("y"), key("x") == key("y")).where(length & (9 * F.least(room("x"), room("y")) >= 4 * both) & near)


def _verified(pairs: DataFrame, places: DataFrame, docs: DataFrame) -> DataFrame:
    """The (later, earlier) of `pairs` whose token sets really have the similarity. `places`: cls, p (a line with the set)."""
    ids = pairs.select(F.col("later").alias("cls")).unionByName(pairs.select(F.col("earlier").alias("cls"))).distinct()
    ids = cut(ids)
    where = places.join(guarded(ids), "cls", "left_semi").groupBy(F.col("p.d").alias("_id"), F.col("p.h").alias("_th")).agg(F.collect_set(F.struct("p.l", "cls")).alias("_ls"))
    where = cut(where)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_th"))
    lines = docs.join(guarded(where, 200_000), same).select(F.split(_spaced(F.col("text")), "\n", -1).alias("lines"), "_ls")
    lines = lines.select(F.explode(F.transform("_ls", lambda k: F.struct(F.get("lines", k["l"]).alias("line"), k["cls"].alias("cls")))).alias("at")).select("at.*")
    # a class comes from one line; where a whole row is repeated it may come twice, which only repeats a result
    keys = cut(lines.select("cls", _tokens(F.col("line")).alias("keys")))
    a, b = keys.select(F.col("cls").alias("later"), F.col("keys").alias("ka")), keys.select(F.col("cls").alias("earlier"), F.col("keys").alias("kb"))
    both = pairs.join(a, "later").join(b, "earlier").withColumn("o", F.size(F.array_intersect("ka", "kb")))
    out = cut(both.where(9 * F.col("o") >= 4 * (F.size("ka") + F.size("kb"))).select("later", "earlier"))
    for done in (ids, where, keys):
        discard(done)
    return out


def _place() -> Column:
    """A line's place in the order; null doc_ids last, then by the text's hash where ids and numbers are tied."""
    return F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("line_no").alias("l"), F.col("h").alias("h"))


def _removed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, line_no) of the lines that go, as often as their row is there; h: the hash of the text."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    classes = rarity(docs)
    sets = cut(_sets(docs, classes), hashes=["h", "cls", "s0", "bands.list.element", "prefix.list.element"])
    many = cut(sets.groupBy("cls").count().where("count > 1").select("cls"))  # counted first: least places are found by sorting
    equal = cut(sets.join(guarded(many), "cls", "left_semi").groupBy("cls").agg(F.min(_place()).alias("first")))
    one = sets.join(guarded(equal), "cls", "left").where(F.col("first").isNull() | (_place() == F.col("first")))
    one = one.select("cls", "n", *SKETCH, "bands", "prefix", _place().alias("p"))

    # each class against the earliest one of a shared band
    band = F.explode("bands").alias("band")
    shared = cut(one.select(band).groupBy("band").count().where("count > 1").select("band"))
    heads = one.select("p", "cls", "n", *SKETCH, band).join(guarded(shared), "band", "left_semi")
    pivots = heads.groupBy("band").agg(F.min(F.struct("p", "cls", "n", *SKETCH)).alias("v")).select("band", "v.*")
    met = heads.alias("x").join(pivots.alias("y"), "band").where(F.col("x.p") > F.col("y.p"))
    met = met.where(9 * _apart("x", "y", F.col("x.n"), F.col("y.n")) <= F.col("x.n") + F.col("y.n"))
    met = cut(met.select(F.col("x.cls").alias("later"), F.col("y.cls").alias("earlier")).distinct())
    settled = _verified(met, one, docs)
    done = cut(settled.select(F.col("later").alias("cls")).distinct())

    # the rest against all: first each class and its earliest candidate, then the candidates of those still unsettled
    few = guarded(done)
    todo, past = _rows(one.join(few, "cls", "left_anti")), _rows(one.join(few, "cls", "left_semi"))
    ends = [F.col("x.cls").alias("a"), F.col("y.cls").alias("b")]
    # both conditions on cls let the plan read one exchange of `todo` three times
    found = _met(todo, todo).where(F.col("x.cls") < F.col("y.cls")).select(*ends).unionByName(_met(todo, past).where(F.col("x.cls") != F.col("y.cls")).select(*ends))
    found = cut(found.distinct())
    ids = cut(found.select(F.col("a").alias("cls")).unionByName(found.select(F.col("b").alias("cls"))).distinct())
    at = cut(one.select("cls", "p").join(guarded(ids), "cls", "left_semi").groupBy("cls").agg(F.min("p").alias("p")))
    named = found.join(at.select(F.col("cls").alias("a"), F.col("p").alias("pa")), "a").join(at.select(F.col("cls").alias("b"), F.col("p").alias("pb")), "b")
    first = F.col("pa") < F.col("pb")
    pairs = named.select(F.when(first, F.col("b")).otherwise(F.col("a")).alias("later"), F.when(first, F.col("a")).otherwise(F.col("b")).alias("earlier"), F.least("pa", "pb").alias("p"))
    pairs = cut(pairs.join(few.withColumnRenamed("cls", "later"), "later", "left_anti"))
    early = cut(pairs.groupBy("later").agg(F.min(F.struct("p", "earlier")).alias("e")).select("later", "e.earlier"))
    sure = _verified(early, at, docs)
    rest = cut(pairs.select("later", "earlier").join(guarded(sure.select("later")), "later", "left_anti").join(early, ["later", "earlier"], "left_anti"))
    more = rest if rest.isEmpty() else _verified(rest, at, docs)

    # all lines of a class with an earlier partner, and all but the first of equal lines
    near = done.unionByName(sure.unionByName(more).select(F.col("later").alias("cls"))).distinct()
    near = cut(near.withColumn("near", F.lit(True)))
    light = sets.select("doc_id", "h", "line_no", "cls").join(guarded(near), "cls", "left").join(guarded(equal), "cls", "left")
    out = cut(light.where(F.col("near") | (_place() > F.col("first"))).select("doc_id", "h", "line_no"))
    for step in (sets, many, equal, shared, met, settled, done, found, ids, at, pairs, early, sure, rest, more, near):
        discard(step)
    return out


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, line_no) of the lines that go; h: the hash of the text."""
    return _removed(docs).distinct()


def _by_text(docs: DataFrame) -> DataFrame:
    """(id, h, gone) of every text that loses lines; gone: their numbers in order."""
    return _removed(docs).groupBy(F.col("doc_id").alias("id"), "h").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed_lines) for every row of `docs`; removed_lines: numbers from 0, comma-joined."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    out = rows.join(_by_text(docs), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("h")), "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(gone).cast("long").alias("n_removed"), F.array_join(gone.cast("array<string>"), ",").alias("removed_lines"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """`docs` with the lines gone from `text`; columns and rows as they are.

    A text that loses all lines becomes empty. The removed line numbers are broadcast while there are few
    enough documents and numbers (both counted); else the texts are shuffled to them.
    """
    i, h, g = free_names(docs, "id", "h", "gone")
    gone = cut(_by_text(docs).toDF(i, h, g))
    docs_, lines = gone.agg(F.count("*"), F.coalesce(F.sum(F.size(g)), F.lit(0))).first()
    small = F.broadcast(gone) if docs_ <= SMALL_DOCS and lines <= SMALL_LINES else gone
    j = docs.join(small, F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(h)), "left")
    rest = F.filter(F.split("text", "\n"), lambda x, k: ~F.array_contains(g, k))
    text = F.when(F.col(g).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return j.withColumn("text", text).select(*docs.columns)
