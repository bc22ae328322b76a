"""Search on the driver over bounded candidates: additive feature search, and the fallback for failed models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tries, least relative gain, and the error at which the search is good enough.
BUDGET = 4
LEAST_GAIN = 0.02
GOOD_ENOUGH = 0.08


def feature_search(required: list[str], optional: list[str], error: Callable[[list[str]], float], budget: int = BUDGET) -> tuple[list[str], float]:
    """Required features plus those optional ones, tried in order, that cut the error by 2 % or more; (features, error)."""
    chosen = list(required)
    best = error(chosen)
    for name in optional[:budget]:
        if best < GOOD_ENOUGH:
            break
        now = error([*chosen, name])
        if now <= best * (1 - LEAST_GAIN):
            chosen.append(name)
            best = now
    return chosen, best


def with_fallback(results: DataFrame, fallback: DataFrame, value: str = "level") -> DataFrame:
    """Every item of `fallback` once: its result where there is one, else the fallback's, with used_fallback."""
    j = fallback.select("sku", F.col(value).alias("_f")).join(results.select("sku", F.col(value).alias("_v")), "sku", "left")
    return j.select("sku", F.coalesce("_v", "_f").alias(value), F.col("_v").isNull().alias("used_fallback"))
