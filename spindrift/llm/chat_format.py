"""Chat formatting by minimum-cost role repair.

The legal conversation is an optional system turn, then user and assistant turns in alternation, ending
with the assistant. A turn may stay, take another role (`RELABEL`), be merged into the output turn before
it (`MERGE`), or have one empty turn of the missing role inserted before it (`INSERT`); the end may need
empty turns too. Dynamic programming over the automaton's states finds the cheapest repair.

A conversation is ordered by turn, then by a hash of role and text. It is worked on in segments of bounded
size: blocks of `BLOCK` turn numbers, and where many rows share a block (over `LIMIT`), by turn and ranges
of the hash. A segment is first reduced to the costs between states before and after it (a 4 x 4 matrix);
per conversation the small matrices give the states at all segment borders; then every segment is decoded
on its own. So no task holds a long conversation's texts, and the result is one row per output piece, in
the order (turn, piece): concatenating `rendered` over a conversation gives its chat text.

Results for odd input: equal rows (same conversation, turn, role and text) count once, or as often as they
are there with `repeats`; rows with a null
conv_id are conversations of their own; null turns come last; a null role, or one not known, may become
any role for `UNKNOWN`; null texts are empty; an empty table gives an empty result; other columns are
ignored. Ties prefer keeping over merging over inserting, and the earlier state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, guarded

ROLES = ("", "system", "user", "assistant")
ALIASES = {"system": 1, "developer": 1, "user": 2, "human": 2, "prompter": 2, "assistant": 3, "gpt": 3, "bot": 3, "model": 3, "ai": 3}
#: The states that a new turn of each state's role may follow. State k: the last turn has role k.
AFTER = {1: (0,), 2: (0, 1, 3), 3: (2,)}
RELABEL, UNKNOWN, MERGE, INSERT = 2, 1, 1, 3
BLOCK = 512
LIMIT = 20_000
FAR = 1 << 40

OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"


def _change(role: int, to: int) -> int:
    return 0 if role == to else UNKNOWN if role == 0 else RELABEL


def moves(role: int) -> list[tuple[int, int, int, str, int]]:
    """(from, to, cost, action, inserted role) for a turn of this role (0: unknown), best first for each pair of states."""
    best: dict[tuple[int, int], tuple[int, int, str, int]] = {}

    def offer(a: int, b: int, cost: int, rank: int, action: str, extra: int = 0) -> None:
        if (a, b) not in best or (cost, rank) < best[a, b][:2]:
            best[a, b] = (cost, rank, action, extra)

    for to, sources in AFTER.items():
        change = _change(role, to)
        for a in sources:
            offer(a, to, change, 0, "keep" if not change else "relabel")
        offer(to, to, MERGE + change, 1, "merge")
        for mid in sources:
            for a in AFTER.get(mid, ()):
                offer(a, to, INSERT + change, 2, "insert", mid)
    return [(a, b, c, act, x) for (a, b), (c, _, act, x) in sorted(best.items())]


MOVES = [moves(r) for r in range(4)]
#: Roles to append at the end, by state.
TAIL = {0: (), 1: (2, 3), 2: (3,), 3: ()}
END = [INSERT * len(TAIL[s]) for s in range(4)]


def role_of(role: str | None) -> int:
    return ALIASES.get((role or "").strip().lower(), 0)


def matrix(roles: list[int]) -> list[list[int]]:
    """The least cost from each state to each state over these turns."""
    m = [[0 if a == b else FAR for b in range(4)] for a in range(4)]
    for r in roles:
        n = [[FAR] * 4 for _ in range(4)]
        for a, b, c, _, _ in MOVES[r]:
            for row, old in zip(n, m):
                if old[a] + c < row[b]:
                    row[b] = old[a] + c
        m = n
    return m


def borders(matrices: list[list[list[int]]]) -> tuple[list[int], int]:
    """The states before the first, between and after the last segment on a cheapest way, and its cost."""
    togo = [END]
    for m in reversed(matrices):
        togo.append([min(m[a][b] + togo[-1][b] for b in range(4)) for a in range(4)])
    togo.reverse()
    states = [0]
    for m, rest in zip(matrices, togo[1:]):
        a = states[-1]
        states.append(min(range(4), key=lambda b: (m[a][b] + rest[b], b)))
    return states, togo[0][0]


def decode(roles: list[int], first: int, last: int) -> list[tuple[int, str, int]]:
    """(state, action, inserted role) of every turn on a cheapest way from state `first` to `last`."""
    togo = [[0 if s == last else FAR for s in range(4)]]
    for r in reversed(roles):
        row = [FAR] * 4
        for a, b, c, _, _ in MOVES[r]:
            row[a] = min(row[a], c + togo[-1][b])
        togo.append(row)
    togo.reverse()
    out, s = [], first
    for r, rest in zip(roles, togo[1:]):
        _, _, b, act, extra = min((c + rest[b], ("keep", "relabel", "merge", "insert").index(act), b, act, extra) for a, b, c, act, extra in MOVES[r] if a == s)
        out.append((b, act, extra))
        s = b
    return out


def _head(state: int, role: int) -> str:
    return (CLOSE if state else "") + OPEN.format(ROLES[role])


def pieces(turns: list[dict], first: int, last: int, final: bool) -> list[tuple]:
    """(turn, piece, role, action, rendered) of a segment's turns {turn, role, text}; `final`: the conversation ends here."""
    out, state = [], first
    for n, (t, (to, act, extra)) in enumerate(zip(turns, decode([role_of(t["role"]) for t in turns], first, last))):
        if act == "insert":
            out.append((t["turn"], 2 * n, ROLES[extra], "insert", _head(state, extra)))
            state, act = extra, "keep" if _change(role_of(t["role"]), to) == 0 else "relabel"
        lead = "\n\n" if act == "merge" else _head(state, to)
        out.append((t["turn"], 2 * n + 1, ROLES[to], act, lead + (t["text"] or "")))
        state = to
    if final:
        at = turns[-1]["turn"]
        for k, role in enumerate(TAIL[state]):
            out.append((at, 2 * len(turns) + k, ROLES[role], "insert", _head(state, role)))
            state = role
        out[-1] = (*out[-1][:4], out[-1][4] + CLOSE)
    return out


def _segments(turns: DataFrame, block: int, limit: int, repeats: bool) -> DataFrame:
    """(conv, conv_id, seg, turns): seg orders a conversation's segments, turns are in order."""
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").groupBy("conv_id", "turn", "role", "text").count()
    t = t.withColumn("count", F.explode(F.sequence(F.lit(1).cast("long"), "count"))).drop("count") if repeats else t.drop("count")
    t = t.withColumn("h", F.xxhash64("role", "text"))
    conv = F.when(F.col("conv_id").isNotNull(), F.col("conv_id").cast("string")).otherwise(F.sha2(F.concat_ws("|", F.lit("null"), F.col("turn").cast("string"), "role", "text"), 256))
    late = F.lit((1 << 62) // block)
    t = t.withColumns({"conv": F.struct(F.col("conv_id").isNull().alias("alone"), conv.alias("id")), "blk": F.coalesce(F.floor(F.col("turn") / block), late)})
    crowd = t.groupBy("conv", "blk").count().where(F.col("count") > limit)
    crowd = cut(crowd.select("conv", "blk", F.greatest(F.lit(1), F.ceil(F.log2(F.col("count") / limit))).cast("int").alias("bits")))
    t = t.join(guarded(crowd, 10_000), ["conv", "blk"], "left")
    big = F.col("bits").isNotNull()
    part = F.call_function("shiftright", F.col("h"), F.lit(64) - F.col("bits"))
    seg = F.struct("blk", F.when(big, F.coalesce("turn", F.lit(1 << 62))).otherwise(0).alias("at"), F.when(big, part).otherwise(F.lit(0)).cast("long").alias("part"))
    row = F.struct(F.col("turn").isNull().alias("z"), "turn", "h", "role", "text")
    return t.withColumn("seg", seg).groupBy("conv", "conv_id", "seg").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def chat_format(turns: DataFrame, block: int = BLOCK, limit: int = LIMIT, repeats: bool = False) -> DataFrame:
    """(conv_id, turn, segment, piece, role, action, rendered, cost): the repaired pieces of all conversations.

    Order within a conversation: segment, piece. cost: of the whole conversation's repair. action: keep,
    relabel, merge or insert; inserted pieces carry the turn before which, or at the end after which, they
    stand.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    segments = cut(_segments(turns, block, limit, repeats))
    flat = "array<bigint>"

    @F.pandas_udf(flat)
    def reduced(roles: pd.Series) -> pd.Series:
        return roles.map(lambda r: [x for row in matrix([role_of(y) for y in r]) for x in row])

    @F.pandas_udf("array<bigint>")
    def ways(ms: pd.Series) -> pd.Series:
        def one(segs) -> list[int]:
            found, cost = borders([[list(s[4 * a : 4 * a + 4]) for a in range(4)] for s in segs])
            return [*found, cost]

        return ms.map(one)

    m = segments.select("conv", "seg", reduced(F.transform("turns", lambda t: t["role"])).alias("m"))
    w = m.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "m"))).alias("l"))
    w = w.withColumn("w", ways(F.transform("l", lambda x: x["m"])))
    n = F.size("l")
    w = w.select("conv", F.posexplode("l.seg").alias("segment", "seg"), n.alias("n"), "w").select("conv", "seg", "segment", F.get("w", F.col("segment")).alias("a"), F.get("w", F.col("segment") + 1).alias("b"), (F.col("segment") == F.col("n") - 1).alias("final"), F.get("w", F.col("n") + 1).alias("cost"))
    todo = segments.join(w, ["conv", "seg"]).select("conv_id", "segment", "turns", "a", "b", "final", "cost")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "turn", "segment", "piece", "role", "action", "rendered", "cost"]
        for d in batches:
            rows = [(c, t, s, p, r, x, text, cost) for c, s, ts, a, b, f, cost in zip(*(d[k] for k in d.columns)) for t, p, r, x, text in pieces(list(ts), a, b, f)]
            out = pd.DataFrame(rows, columns=names)
            out["turn"] = out["turn"].astype("Int64")
            out["conv_id"] = out["conv_id"].astype(d["conv_id"].dtype)
            yield out

    return todo.mapInPandas(run, f"conv_id {kind}, turn bigint, segment int, piece int, role string, action string, rendered string, cost bigint")
