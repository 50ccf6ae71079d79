"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark import session


def col(name: str) -> Column:
    """The column of exactly this name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names, so that whatever else
    the input carries can neither clash nor travel along."""
    return df.select(*[col(src).alias(name) for name, src in columns.items()])


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names compare case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def fold(id_col: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(k))


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all of them when it has no more), the
    same ones on every run: those whose key hash falls below rows / count."""
    n = df.count()
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << 30)) < int((1 << 30) * rows / n))


def bounded_sample_by(df: DataFrame, group: str, key: Column, rows: int) -> DataFrame:
    """``bounded_sample`` within every value of ``group``: about ``rows`` rows
    of each, all of those with no more. The counts of all groups are one small
    table of as many rows as there are groups."""
    sizes = df.groupBy(group).agg(F.count("*").alias("rows_of_group"))
    hashed = F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(1 << 30))
    return (df.join(F.broadcast(sizes), group)
            .where((F.col("rows_of_group") <= rows) | (hashed < F.lit(float(rows << 30)) / F.col("rows_of_group"))).drop("rows_of_group"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> None:
    session.ship_package(spark)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back: cuts
    lineage, and several consumers read the files instead of recomputing."""
    return session.materialize(df)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(texts: list, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive (from, to) ranges of about ``size`` characters or bytes, one text at least."""
    lo = total = 0
    for i, text in enumerate(texts):
        if i > lo and total + len(text) > size:
            yield lo, i
            lo, total = i, 0
        total += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def shuffled(side: DataFrame) -> DataFrame:
    """A join side that is to be shuffled and merged at every size: the plan
    of a large run, not one that changes where a side happens to be small."""
    return side.hint("merge")


def rows_of(batch) -> Iterator[tuple]:
    """The rows of an Arrow batch one by one, for rows of large binary values."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now (it
    does so when the driver collects its garbage): only for steps whose result
    is already a stored table."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
