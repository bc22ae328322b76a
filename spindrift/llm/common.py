"""Shared plumbing of the text operators: word rules, durable cuts of lineage, guarded broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of the two word rules the operators use (Java regular expressions).
SPACE = "[ \\t-\\r]"
NOT_ALNUM = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: `spark.checkpoint.dir`; in local mode one of our own where that is unset, on a cluster a ValueError."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="spindrift-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def cut(df: DataFrame, hashes: Sequence[str] = ()) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there and survives lost executors.

    `hashes`: Parquet paths of columns whose values hardly repeat, for which no dictionary is tried.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spindrift-{uuid.uuid4().hex}"
    df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in hashes}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._spindrift_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what `cut` wrote for `df`; nothing may read it afterwards."""
    path = getattr(df, "_spindrift_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


#: Rows of a narrow table (ids, hashes) that may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 1_000_000


def guarded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it has at most `rows` rows (counted up to one more), else unchanged.

    Pass tables that are cheap to read twice, such as those from `cut`.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, sep: str = SPACE) -> Column:
    """The words between runs of `sep`; an empty array for null or for no word. No empty words."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{sep}+")
    head = F.when(F.element_at(parts, 1) == "", F.lit(2)).otherwise(F.lit(1))
    n = F.size(parts) - F.when(F.element_at(parts, -1) == "", F.lit(1)).otherwise(F.lit(0))
    return F.slice(parts, head, F.greatest(n - head + 1, F.lit(0)))


def literal_doubles(values: list[float]) -> Column:
    """An array<double> constant; one string literal, folded once by the optimizer."""
    return F.split(F.lit(",".join(f"{v:.6g}" for v in values)), ",").cast("array<double>")


def literal_longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """These names, each with as many underscores before it as it takes to be no column of `df` (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
