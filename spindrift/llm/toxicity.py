"""Toxicity by Levenshtein automata over a lexicon trie, with scores of the words around a hit.

Lexicon: a short fixed list, and terms learnt from labelled rows: words, and stems (beginnings of words)
where many endings occur, that stand in toxic documents far more often than in others. The trie of all
terms is intersected with Levenshtein automata: states are sets of (trie node, edits), determinised as
they are reached, so a word costs one table step per letter and dies as soon as no term is near. Words of
5 or more letters and stems of 7 or more may differ by one edit.

Every hit has a window of `WINDOW` words to each side. Address and abuse there (second person, commands,
exclamation) speak for an attack; quotation marks around the hit and reporting verbs speak for quoting. A
logistic regression over counts of plain, quoted and misspelt hits, their density and these window scores
gives the document's score.

Learning uses at most `SAMPLE` labelled rows, the first by a hash of their id, and only those with
crc32(doc_id as text) mod 5 other than 0; the sample's texts stay on the executors, and term counts and
features of that bounded sample reach the driver. Scoring reads whole texts, row by row, with no shuffle.

Results for odd input: null and empty texts get the score of a text without hits; null doc_ids are not
learnt from, are not held out and keep their rows; labels other than 0 and 1 are ignored; without labels
of both kinds fixed weights are used; repeated rows keep their rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

SAMPLE = 20_000
FOLDS = 5
WINDOW = 6
MIN_DOCS = 4
MIN_ODDS = 2.5
#: Terms of the lexicon, the strongest first; None for all that pass.
TERMS: int | None = 2_000
STEMS = range(4, 9)

TOKEN = re.compile(r"[^\W_]+(?:[*@$'][^\W_]+)*|[!?\"“”„«»‘’]")
#: Fixed word lists: insults; words around quotation; words around an attack.
INSULTS = "idiot moron imbecile stupid loser pathetic scum worthless trash clown disgusting dumbass bastard jerk vermin filth".split()
QUOTING = frozenset(
    "said says say called calls wrote writes quote quoted quoting word term phrase reported according alleged definition means example "
    "sagte schrieb nannte laut zitat wort dit disait écrit appelé selon mot dijo escribió llamó según palabra".split()
)
ATTACK = frozenset("you your youre yourself shut go die hate kill du dich dein euch ihr tu toi ton vous votre tú ti usted vete".split())
MARKS = frozenset("\"“”„«»")
FEATURES = ("some", "plain", "quoted", "misspelt", "density", "attack", "quoting")
#: Weights (intercept first) for want of labels.
FIXED = (-3.0, 3.0, 1.0, -0.5, 0.5, 0.2, 0.4, -0.4)


class Lexicon:
    """Terms (word, is_stem) as a trie, and its intersection with Levenshtein automata as a lazily built DFA."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.child: list[dict[str, int]] = [{}]
        self.kind: list[tuple[bool, int] | None] = [None]
        self.most = [0]
        for term, stem in terms:
            edits = int(len(term) >= (7 if stem else 5))
            at = 0
            for c in term:
                self.most[at] = max(self.most[at], edits)
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.kind.append(None)
                    self.most.append(0)
                at = self.child[at][c]
            self.most[at] = max(self.most[at], edits)
            self.kind[at] = (stem or bool(self.kind[at] and self.kind[at][0]), edits)
        self.names: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        #: Least edits at which a state accepts: as a whole word, and as a stem (99: not).
        self.whole: list[int] = []
        self.begun: list[int] = []
        self.start = self._state({0: 0})

    def _close(self, cost: dict[int, int]) -> dict[int, int]:
        """Add what deletions reach."""
        todo = list(cost)
        while todo:
            n = todo.pop()
            for m in self.child[n].values():
                if cost[n] + 1 <= self.most[m] and cost[n] + 1 < cost.get(m, 99):
                    cost[m] = cost[n] + 1
                    todo.append(m)
        return cost

    def _state(self, cost: dict[int, int]) -> int:
        key = frozenset(self._close(cost).items())
        if not key:
            return -1
        if key not in self.names:
            self.names[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            good = [(self.kind[n][0], e) for n, e in key if self.kind[n] and e <= self.kind[n][1]]
            self.whole.append(min((e for _, e in good), default=99))
            self.begun.append(min((e for stem, e in good if stem), default=99))
        return self.names[key]

    def _step(self, state: int, c: str) -> int:
        cost: dict[int, int] = {}
        for n, e in self.sets[state]:
            if c in self.child[n]:
                m = self.child[n][c]
                cost[m] = min(cost.get(m, 99), e)
            if e + 1 <= self.most[n]:
                cost[n] = min(cost.get(n, 99), e + 1)
            for m in self.child[n].values():
                if e + 1 <= self.most[m]:
                    cost[m] = min(cost.get(m, 99), e + 1)
        return self._state(cost)

    def edits(self, word: str) -> int:
        """The least edits from `word`, or for stems from a beginning of it, to a term; 99 if none is near."""
        s, best, moves, begun = self.start, 99, self.moves, self.begun
        for c in word:
            t = moves[s].get(c)
            if t is None:
                t = self._step(s, c)
                if len(moves[s]) < 4_000:
                    moves[s][c] = t
            if t < 0:
                return best
            s = t
            if begun[s] < best:
                best = begun[s]
        return min(best, self.whole[s])


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The `FEATURES` of one text."""
    tokens = TOKEN.findall((text or "").lower())
    near = {w: e for w in set(tokens) if (e := lexicon.edits(w)) < 99}
    if not near:
        return [0.0] * len(FEATURES)
    plain = quoted = wrong = 0
    attack = quoting = 0.0
    for i, w in enumerate(tokens):
        e = near.get(w)
        if e is None:
            continue
        left, right = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
        around = [*left, *right]
        inside = any(x in MARKS for x in left) and any(x in MARKS for x in right)
        speech = inside + sum(x in QUOTING for x in around)
        against = sum(x in ATTACK for x in around) + ("!" in right)
        attack, quoting = max(attack, against), max(quoting, speech)
        if e:
            wrong += 1
        elif speech > against:
            quoted += 1
        else:
            plain += 1
    words = max(1, len(tokens))
    return [1.0 if plain + quoted else 0.0, math.log1p(plain), math.log1p(quoted), math.log1p(wrong), min(5.0, 100 * (plain + quoted) / words), min(attack, 5.0), min(quoting, 5.0)]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(text, toxic) of at most `bound` labelled rows outside the held-out fold."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    few = cut(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    return cut(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", "toxic"))


def learn_terms(sample: DataFrame, most: int | None = TERMS) -> list[tuple[str, bool]]:
    """Terms that toxic documents of the sample (text, toxic) have far more often than the others; the `most` strongest of them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"]):
                words = {w for w in TOKEN.findall((text or "").lower()) if len(w) >= STEMS[0]}
                seen[toxic].update(w + "$" for w in words)
                seen[toxic].update({w[:k] for w in words for k in STEMS if len(w) >= k})
        rows = [(t, seen[1][t], seen[0][t]) for t in {**seen[0], **seen[1]}]
        for k in range(0, len(rows), 50_000):
            yield pd.DataFrame(rows[k : k + 50_000], columns=["term", "bad", "good"])

    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return []
    n1, n0 = sizes[1], sizes[0]
    both = sample.mapInPandas(count, "term string, bad bigint, good bigint").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (n1 + 1)) - F.log((F.col("good") + 0.5) / (n0 + 1))
    top = both.where(F.col("bad") >= MIN_DOCS).withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS)
    top = top.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "term")
    top = (top if most is None else top.limit(most)).collect()  # at most the terms of the bounded sample
    bad = {r["term"]: r["bad"] for r in top}
    stems, out = {t for t in bad if t[-1] != "$"}, []
    longer: dict[str, int] = {}
    for t in stems:
        longer[t[:-1]] = max(longer.get(t[:-1], 0), bad[t])
    kept: set[str] = set()
    for t in sorted(stems, key=lambda t: (len(t), t)):
        if not any(t[:k] in kept for k in range(STEMS[0], len(t))) and longer.get(t, 0) < 0.9 * bad[t]:
            kept.add(t)
            out.append((t, bad.get(t + "$", 0) < 0.8 * bad[t]))
    return out + [(t[:-1], False) for t in bad if t[-1] == "$" and not any(t[:k] in kept for k in STEMS)]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method; intercept first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, pull = np.zeros(x.shape[1]), np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + pull + 1e-6 * np.eye(x.shape[1])
        move = np.linalg.solve(h, x.T @ (y - p) - pull @ w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, most: int | None = TERMS) -> tuple[list[tuple[str, bool]], list[float]]:
    """Terms and weights."""
    sample = _sample(docs, labels, bound)
    terms = sorted({*learn_terms(sample, most), *((w, False) for w in INSULTS)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms)
        for b in batches:
            out = pd.DataFrame([features(t, lexicon) for t in b["text"]], columns=FEATURES)
            yield out.assign(toxic=b["toxic"].to_numpy())

    cols = ", ".join(f"{f} double" for f in FEATURES)
    rows = sample.mapInPandas(run, f"{cols}, toxic int").groupBy(*FEATURES, "toxic").count().orderBy(*FEATURES, "toxic").collect()
    y = np.repeat([r["toxic"] for r in rows], [r["count"] for r in rows]).astype(float) if rows else np.zeros(0)
    if not 0 < y.sum() < len(y):
        return terms, list(FIXED)
    x = np.repeat(np.array([[r[f] for f in FEATURES] for r in rows]), [r["count"] for r in rows], axis=0)
    return terms, fit(x, y).tolist()


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, most: int | None = TERMS) -> DataFrame:
    """(doc_id, held_out, score, predicted, features...) for every row of `docs` (doc_id, text); `bound`: labelled rows to learn from, `most`: terms."""
    terms, weights = learn(docs, labels, bound, most)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, w = Lexicon(terms), np.array(weights)
        for b in batches:
            x = np.array([features(t, lexicon) for t in b["text"]]).reshape(len(b), len(FEATURES))
            score = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": score.round(9), **{f: x[:, k] for k, f in enumerate(FEATURES)}})

    cols = ", ".join(f"{f} double" for f in FEATURES)
    out = docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, score double, {cols}")
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *FEATURES)
