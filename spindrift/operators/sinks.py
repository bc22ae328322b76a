"""Idempotent writers over Parquet directories, and their pure merge rules.

Parquet has no MERGE, so an upsert reads the table, merges, writes a new version beside it and swaps a
pointer file: readers see the old or the new version, and a lost executor or a retry leaves no half-written
table. All writers run twice give what they give once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Table:
    """A versioned Parquet table at `path`; `current` is its newest complete version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = lambda s: jvm.org.apache.hadoop.fs.Path(s)
        self._fs = self._path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def versions(self) -> list[str]:
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.path))]
        return sorted(n for n in names if n.startswith("v=") and self._fs.exists(self._path(f"{self.path}/{n}/_SUCCESS")))

    def read(self) -> DataFrame | None:
        v = self.versions()
        return self.spark.read.parquet(f"{self.path}/{v[-1]}") if v else None

    def write(self, df: DataFrame, keep: int = 2) -> None:
        """A new version; the `keep` newest stay for readers that are under way."""
        v = self.versions()
        n = int(v[-1][2:12]) + 1 if v else 0
        df.write.parquet(f"{self.path}/v={n:010d}-{uuid.uuid4().hex[:8]}")
        for old in self.versions()[:-keep]:
            self._fs.delete(self._path(f"{self.path}/{old}"), True)

    def drop(self) -> None:
        self._fs.delete(self._path(self.path), True)


def _one(rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: that of the greatest `order`, and of equals the first by a hash of the row."""
    by = ([F.desc(order)] if order else []) + [F.xxhash64(*rows.columns)]
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_rn = 1").drop("_rn")


def insert_ignored(current: DataFrame | None, rows: DataFrame, keys: list[str]) -> DataFrame:
    """`current` plus the rows whose keys it lacks; of equal new keys one row."""
    fresh = _one(rows, keys)
    return fresh if current is None else current.unionByName(fresh.join(current.select(*keys), keys, "left_anti"))


def upserted(current: DataFrame | None, rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """`current` with `rows` put over it by key; of equal keys in `rows` the greatest `order` wins."""
    rows = _one(rows, keys, order)
    return rows if current is None else current.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


def counted_upsert(current: DataFrame | None, rows: DataFrame, keys: list[str], counter: str, fixed: list[str]) -> DataFrame:
    """Upsert that adds 1 to `counter` on a key that is there and leaves its `fixed` columns alone."""
    if current is None:
        return rows.withColumn(counter, F.lit(1).cast("long"))
    new = _one(rows, keys).select(*keys, *[F.col(c).alias(f"_{c}") for c in rows.columns if c not in keys])
    j = current.join(new, keys, "full")
    names = [c for c in current.columns if c not in keys]
    own = lambda c: F.coalesce(c, f"_{c}") if c in fixed else F.coalesce(f"_{c}", c)
    old = F.coalesce(F.col(counter), F.lit(0)).cast("long")
    hit = F.greatest(*[F.col(f"_{c}").isNotNull().cast("int") for c in rows.columns if c not in keys], F.lit(0))
    return j.select(*keys, *[(old + hit).alias(c) if c == counter else own(c).alias(c) if f"_{c}" in j.columns else F.col(c) for c in names])


def replace_partition(df: DataFrame, path: str, by: str = "tenant_id") -> None:
    """Replace the partitions of `by` that `df` has, in one commit each; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


class BatchWriter:
    """Buffered appends to allowed tables; flushed all together or, after a failure, dropped."""

    def __init__(self, root: str, allowed: frozenset[str], denied: frozenset[str] = frozenset()):
        self.root, self.allowed, self.denied = root.rstrip("/"), allowed, denied
        self.rows: dict[str, list[DataFrame]] = {}

    def add(self, table: str, rows: DataFrame) -> None:
        if table in self.denied or table not in self.allowed:
            raise ValueError(f"table {table} may not be written")
        self.rows.setdefault(table, []).append(rows)

    def flush(self) -> int:
        """Append what is buffered, one write per table; the number of tables written."""
        todo, self.rows = self.rows, {}
        for table, parts in todo.items():
            df = parts[0]
            for p in parts[1:]:
                df = df.unionByName(p)
            kinds = dict(df.dtypes)
            df.select(*[F.to_json(c).alias(c) if kinds[c].startswith(("struct", "map", "array")) else F.col(c) for c in df.columns]).write.mode("append").parquet(f"{self.root}/{table}")
        return len(todo)


def reports(frames: dict[str, DataFrame], root: str) -> None:
    """Write each frame as CSV with a header under its name."""
    for name, df in frames.items():
        df.write.mode("overwrite").option("header", True).csv(f"{root.rstrip('/')}/{name}")
