"""Mixing documents to target weights by soft membership.

A multinomial naive Bayes classifier is counted from the labelled table, but for the rows of one fold:
hashed words and hashed word endings (the last two characters, marks included) per domain, each different
word of a text once, and how often words repeat. A hash speaks for a domain only where its count is
`SIGNIFICANCE` standard deviations away from what the labelled corpus as a whole expects, so unspecific
words add no noise in long texts; only hashes that speak for one are kept. Naive Bayes is sure of itself too soon, so its sums are calibrated on the
labelled rows of the fold it has not seen (at most `HELD` rows, the first by a hash of their id): a softmax
of the sums' signed logarithms and of the sums over the root of the words that made them, each with a
scale per domain, and an offset per domain, fitted by gradient descent on the log loss. Every document keeps posteriors of its own.

The rates solve least squares over all documents: with t the words of a document, p its posteriors and r
its rate, sum_d (sum_i t_i p_id r_i - T_d)^2 / S_d is minimised over r >= 0, where T_d are the targets (a
weight times the token budget) and S_d the tokens the corpus expects of domain d. It is projected
gradient descent from one common rate; the gradient is preconditioned by the domains' second moments over
the documents whose rate is above 0 (a few numbers) or, where that does not lower the sum of squares, by the
domains' tokens among them; a step that does not lower it either way is halved. A step needs one aggregate of a few numbers; a document's rate is a function of its own posteriors
and the steps so far, so nothing per document is shuffled or gathered. Where the targets are not met within
`TOLERANCE` after the last step (they may be out of reach), a warning names the gap.

Domains of the queries come from the labels: "toxic" (toxic 1), else "poor" (quality 0), else "good".

Results for odd input: null or empty texts have 0 tokens, the prior as posterior, and a rate; null doc_ids
keep their rows; labels for missing documents, with null marks or with two domains for one id count for
nothing (two domains: the first by name); a domain without labelled documents is left out and the other
weights are scaled up; without any labelled document there is one domain and every rate is the same; an
empty table gives an empty result; other columns are kept by `mix`.
"""

from __future__ import annotations

import warnings
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_names, guarded, words

SIGNIFICANCE = 3.5
PRIOR = 0.5
LIMIT = 4.0
STEPS = 40
#: The labelled rows whose crc32(doc_id as text) is divisible by this calibrate, the others count; and how many calibrate at most.
FOLDS, HELD = 5, 20_000
#: Largest difference from a target, as a share of the domain's tokens, at which the steps end.
TOLERANCE = 1e-4
#: Shares of the token budget, and the budget as a share of the corpus' tokens.
TARGETS = {"good": 0.93, "poor": 0.05, "toxic": 0.02}
BUDGET = 0.5


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from (doc_id, quality, toxic)."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


def _spots(d: DataFrame, *keep: str) -> DataFrame:
    """One row per different word of each text: `keep`, the hashes b1 of the word and b2 of its ending; one row that is not `some` for a text without words."""
    d = d.withColumn("_a", words(F.lower(F.coalesce("text", F.lit(""))))).withColumn("_u", F.array_distinct("_a"))
    # how often words repeat, as one more word that no text has
    repeats = F.concat(F.lit("\x01"), F.floor(2 * F.log2(F.size("_a") / F.size("_u"))).cast("string"))
    d = d.withColumn("_w", F.when(F.size("_u") > 0, F.concat("_u", F.array(repeats))))
    d = d.select(*keep, F.explode_outer("_w").alias("_x"))
    return d.select(*keep, F.xxhash64("_x").alias("b1"), F.xxhash64(F.right("_x", F.lit(2)), F.lit(1)).alias("b2"), F.col("_x").isNotNull().alias("some"))


class Model(NamedTuple):
    """Domains; the weights (b, w_0, w_1, ...) of hashes, None for none; two scales and an offset per domain."""

    domains: list[str]
    weights: DataFrame | None
    scales: list[list[float]]
    offsets: list[float]


def _sums(docs: DataFrame, weights: DataFrame | None, n: int, keys: list[str]) -> DataFrame:
    """(*keys, n_tokens, u, x_0, x_1, ...) for every row: the weights of its words summed per domain (n of them); u: how many words made them."""
    rows = docs.select(*keys, "text", F.monotonically_increasing_id().alias("_row"))
    rows = rows.withColumn("n_tokens", F.size(words(F.col("text"))).cast("long"))
    d = _spots(rows, "_row", *keys, "n_tokens")
    if weights is not None:
        for b in ("b1", "b2"):
            d = d.join(guarded(weights.toDF(b, *[f"{b}_{k}" for k in range(n)])), b, "left")
    value = lambda k: sum((F.coalesce(f"{b}_{k}", F.lit(0.0)) for b in ("b1", "b2")), F.lit(0.0)) if weights is not None else F.lit(0.0)
    sums = [F.round(F.sum(value(k)), 6).alias(f"x_{k}") for k in range(n)]
    return d.groupBy("_row", *keys, "n_tokens").agg(F.sum(F.col("some").cast("int")).alias("u"), *sums).drop("_row")


def softmax_fit(x: np.ndarray, u: np.ndarray, y: np.ndarray, prior: np.ndarray, steps: int = 600) -> tuple[list[list[float]], list[float]]:
    """Per domain the scales a, c and the offset of softmax(a sign(x) log(1 + |x|) + c x / sqrt(u + 1) + offset), by gradient descent on the log loss with momentum."""
    f = np.stack([np.sign(x) * np.log1p(np.abs(x)), x / np.sqrt(u + 1)[:, None]])
    size = np.maximum(1e-9, np.abs(f).mean(axis=1, keepdims=True))
    f = f / size
    w, off, goal = np.full((2, x.shape[1]), 0.5), np.log(prior), np.eye(x.shape[1])[y]
    speed_w, speed_off = np.zeros_like(w), np.zeros_like(off)
    for _ in range(steps):
        q = (w[:, None] * f).sum(axis=0) + off
        q = np.exp(q - q.max(axis=1, keepdims=True))
        d = q / q.sum(axis=1, keepdims=True) - goal
        speed_w = 0.9 * speed_w - 0.1 * ((d * f).mean(axis=1) + 1e-3 * w)
        speed_off = 0.9 * speed_off - 0.1 * d.mean(axis=0)
        w, off = w + speed_w, off + speed_off
    return (w / size[:, 0]).tolist(), off.tolist()


def fit(docs: DataFrame, labelled: DataFrame) -> Model:
    """The calibrated classifier. At most HELD rows of a few numbers reach the driver."""
    known = cut(_known(labelled).withColumn("_held", F.crc32(F.col("_id").cast("string").cast("binary")) % FOLDS == 0))
    marked = docs.select("doc_id", "text").join(guarded(known), F.col("doc_id") == F.col("_id"))
    sizes = {(d, h): n for d, h, n in marked.groupBy("_d", "_held").count().collect()}  # two rows per domain
    domains = sorted({d for d, _ in sizes})
    if not domains:
        return Model(["all"], None, [[0.0], [0.0]], [0.0])
    # a domain that one of the two parts lacks: count and calibrate on all labelled rows
    apart = all(sizes.get((d, h), 0) for d in domains for h in (False, True))
    counted, held = (marked.where("not _held"), marked.where("_held")) if apart else (marked, marked)
    grams = _spots(counted, "_d").where("some").select("_d", F.explode(F.array("b1", "b2")).alias("b"))
    counts = cut(grams.groupBy("b").agg(*[F.count(F.when(F.col("_d") == d, True)).alias(f"c_{k}") for k, d in enumerate(domains)]))
    k_ = range(len(domains))
    totals = counts.agg(*[F.sum(f"c_{k}") for k in k_]).first()
    parts = [(t or 0) / max(1, sum(x or 0 for x in totals)) for t in totals]
    together = sum((F.col(f"c_{k}") for k in k_[1:]), F.col("c_0"))
    expected = [together * F.lit(p) for p in parts]
    real = [F.abs(F.col(f"c_{k}") - expected[k]) > SIGNIFICANCE * F.sqrt(expected[k] + 1) for k in k_]
    ratio = [F.log((F.col(f"c_{k}") + PRIOR) / (expected[k] + PRIOR)) for k in k_]
    bounded = [F.when(real[k], F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), ratio[k]))).otherwise(0.0).alias(f"w_{k}") for k in k_]
    weights = cut(counts.select("b", *bounded).where(" or ".join(f"w_{k} <> 0" for k in k_)))
    first = cut((known.where("_held") if apart else known).select("_id").orderBy(F.xxhash64("_id"), "_id").limit(HELD))  # ids, not texts
    few = held.join(F.broadcast(first), "_id", "left_semi").select("text", "_d")
    xs = [f"x_{k}" for k in range(len(domains))]
    rows = _sums(few, weights, len(domains), ["_d"]).groupBy("_d", "u", *xs).count().orderBy("_d", "u", *xs).collect()
    x = np.array([[r[c] for c in xs] for r in rows for _ in range(r["count"])])
    u = np.array([float(r["u"]) for r in rows for _ in range(r["count"])])
    y = np.array([domains.index(r["_d"]) for r in rows for _ in range(r["count"])])
    all_ = [sum(sizes.get((d, h), 0) for h in (False, True)) for d in domains]
    scales, offsets = softmax_fit(x, u, y, np.array(all_) / sum(all_))
    return Model(domains, weights, scales, offsets)


def posteriors(docs: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """(*keys, n_tokens, p_0, p_1, ...) for every row of `docs` (*keys, text); p_k belongs to the k-th domain."""
    k_ = range(len(model.domains))
    x, (a, c) = [F.col(f"x_{k}") for k in k_], model.scales
    q = [a[k] * F.signum(x[k]) * F.log1p(F.abs(x[k])) + c[k] * x[k] / F.sqrt(F.col("u") + 1) + model.offsets[k] for k in k_]
    d = _sums(docs, model.weights, len(k_), keys).select(*keys, "n_tokens", *[v.alias(f"q_{k}") for k, v in enumerate(q)])
    top = F.greatest(*[F.col(f"q_{k}") for k in k_]) if len(k_) > 1 else F.col("q_0")
    d = d.select(*keys, "n_tokens", *[F.exp(F.greatest(F.col(f"q_{k}") - top, F.lit(-50.0))).alias(f"e_{k}") for k in k_])
    all_ = sum((F.col(f"e_{k}") for k in k_[1:]), F.col("e_0"))
    return d.select(*keys, "n_tokens", *[F.round(F.col(f"e_{k}") / all_, 9).alias(f"p_{k}") for k in k_])


def _known(labelled: DataFrame) -> DataFrame:
    """(_id, _d): one domain per labelled id."""
    return labelled.where("doc_id is not null and domain is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("domain").alias("_d"))


def _rate(start: float, steps: list[list[float]]) -> Column:
    r = F.lit(start)
    for g in steps:
        r = F.greatest(F.lit(0.0), r - sum((F.col(f"p_{k}") * x for k, x in enumerate(g[1:], 1)), F.col("p_0") * g[0]))
    return r


class Rates(NamedTuple):
    """The rate as an expression over p_k; the domains' totals at these rates and their targets; the largest gap as a share of a domain's tokens."""

    rate: Column
    totals: list[float]
    want: list[float]
    gap: float


def rates(shares: DataFrame, domains: list[str], targets: dict[str, float], budget: float) -> Rates:
    """The fit over `shares` (n_tokens, p_k), which is read once per step."""
    k_ = range(len(domains))
    weight = [targets.get(d, 0.0) for d in domains]
    weight = [w / sum(weight) for w in weight] if sum(weight) else [1 / len(domains)] * len(domains)
    mass = [F.col("n_tokens") * F.col(f"p_{k}") for k in k_]
    pairs = [(i, j) for i in k_ for j in k_ if i <= j]

    def at(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """Totals, and the second moments of the documents at a rate above 0."""
        now = shares.select(*[m.alias(f"m{k}") for k, m in enumerate(mass)], *[f"p_{k}" for k in k_], _rate(budget, steps).alias("r"))
        sums = now.agg(*[F.sum(F.col(f"m{k}") * F.col("r")) for k in k_], *[F.sum(F.when(F.col("r") > 0, F.col(f"m{i}") * F.col(f"p_{j}"))) for i, j in pairs]).first()
        h = np.zeros((len(domains), len(domains)))
        for (i, j), v in zip(pairs, sums[len(domains) :]):
            h[i, j] = h[j, i] = v or 0.0
        return np.array([x or 0.0 for x in sums[: len(domains)]]), h

    have = np.array([x or 0.0 for x in shares.agg(*[F.sum(m) for m in mass]).first()])
    want, size = np.array(weight) * budget * have.sum(), np.maximum(have, 1e-9)
    miss = lambda t: float((((t - want) ** 2) / size).sum())
    gap = lambda t: float((np.abs(t - want) / size).max())
    steps: list[list[float]] = []
    totals, h = at(steps)
    length = 1.0
    for _ in range(STEPS):
        if gap(totals) <= TOLERANCE or length < 1e-3:
            break
        off = totals - want
        curved = np.linalg.solve(h + 1e-6 * max(1e-9, np.trace(h)) * np.eye(len(domains)), off)
        plain = off / np.maximum(h.sum(axis=1), 0.01 * size)  # where the moments of the moment mislead, the gradient in the metric of the tokens
        for move in (curved, plain):
            step = (length * move).tolist()
            new, after = at([*steps, step])
            if miss(new) < (1 - 1e-6) * miss(totals):
                steps.append(step)
                totals, h, length = new, after, min(1.0, 2 * length)
                break
        else:
            length /= 2
    if gap(totals) > TOLERANCE:
        warnings.warn(f"mixing targets missed by up to {gap(totals):.2%} of a domain's tokens after {len(steps)} steps: {dict(zip(domains, totals.round()))} for {dict(zip(domains, want.round()))}", stacklevel=2)
    return Rates(F.round(_rate(budget, steps), 6), totals.tolist(), want.tolist(), gap(totals))


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET, keys: list[str] | None = None) -> DataFrame:
    """(*keys, n_tokens, domain, p_domain, rate) for every row; domain: the likeliest, the first by name of equals."""
    keys = keys or ["doc_id"]
    model = fit(docs, labelled)
    shares = cut(posteriors(docs, model, keys))
    rate = rates(shares, model.domains, targets or TARGETS, budget).rate
    likely = F.array_max(F.array(*[F.struct(F.col(f"p_{k}").alias("p"), F.lit(-k).alias("k"), F.lit(d).alias("d")) for k, d in enumerate(model.domains)]))
    return shares.select(*keys, "n_tokens", likely["d"].alias("domain"), F.round(likely["p"], 6).alias("p_domain"), rate.alias("rate"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, budget: float = BUDGET) -> DataFrame:
    """The rows of `docs` whose rate is above 0, with their columns and `rate` (in place of any column of that name).

    Rows that share a doc_id have the rate of their own text.
    """
    i, h, r = free_names(docs, "id", "h", "mix_rate")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    found = mixing_rates(hashed, labelled, targets, budget, keys=["doc_id", "h"])
    found = cut(found.groupBy("doc_id", "h").agg(F.max("rate").alias("rate")).toDF(i, h, r))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & F.xxhash64("text").eqNullSafe(F.col(h))
    plain = docs.drop(*[c for c in docs.columns if c.lower() == "rate"])
    return plain.join(guarded(found, 500_000), same).where(F.col(r) > 0).select(*[F.col(f"`{c}`") for c in plain.columns], F.col(r).alias("rate"))
