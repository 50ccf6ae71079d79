"""Keyed parquet tables with upserts.

Plain parquet has no MERGE/UPDATE and a path that is being read cannot be
overwritten. ``KeyedTable`` (the catalog's tables) deals rows to a fixed number
of buckets by a hash of their key and keeps a Bloom filter of each bucket's
keys, so an upsert reads and rewrites only the buckets that may hold one of its
keys and adds files to the others. Paths live in a shared folder
(``spark.checkpoint.dir`` or any shared URI).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from evalspark.schemas import TABLES
from evalspark.session import materialize, path_exists


class DuplicateKeyError(ValueError):
    """Several source rows share one upsert key."""


class NullKeyError(ValueError):
    """A source row has a NULL key; it would never match (same as MERGE)."""


def merge_plan(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """S7/S8 as a plan: target rows whose key is absent from source, plus all
    source rows (update-or-insert). One shuffle on the keys per side."""
    keep = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return keep.unionByName(source.select(*target.columns), allowMissingColumns=False)


def check_keys(source: DataFrame, keys: list[str]) -> None:
    """Reject NULL keys and duplicate keys inside one upsert source.

    One grouped action (partial aggregation, then stop at the first
    offending key): a key group with a NULL part or more than one row.
    """
    null_any = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) \
        .where(null_any | (F.col("_n") > 1)).limit(1).collect()
    if bad:
        row = bad[0]
        if any(row[k] is None for k in keys):
            raise NullKeyError(f"NULL value in upsert key {keys}")
        raise DuplicateKeyError(f"duplicate upsert keys in source on {keys}")


BUCKETS = 32
BLOCK_BITS = 32_768  # bits of one bitmap of bitmap_construct_agg
PROBES = 4
ROWS_PER_FILE = 4_000_000


class KeyedTable:
    """A keyed table as parquet in ``buckets`` folders by a hash of the key.

    A key is in one bucket whatever else its row says, so a row that moves to
    another run or version replaces its old one without a search. Files are
    sorted by ``cluster_col`` (run id, dataset version), whose row groups are
    skipped by their statistics; there is no folder per run or comparison.

    Beside the rows stands a Bloom filter of each bucket's keys: ``blocks``
    bitmaps of 32,768 bits, a key setting four bits of one of them (with
    ``blocks`` for ten keys to 100 bits, about one in 100 unknown keys is taken
    for a known one). The filter is written before the rows: a failure between
    the two leaves keys too many in it, which only cost a read.

    ``buckets`` and ``blocks`` are fixed when the table is created and read
    from it afterwards. One writer at a time is assumed (no table format).
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: tuple[str, ...], cluster_col: str,
                 buckets: int = BUCKETS, blocks: int = 8):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.cluster_col = list(keys), cluster_col
        self.buckets, self.blocks = buckets, blocks
        self._read_layout()

    # ---- layout

    @property
    def _rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def _filters(self) -> str:
        return f"{self.root}/filters"

    def _read_layout(self) -> None:
        if path_exists(self.spark, f"{self.root}/layout"):
            self.buckets, self.blocks = self.spark.read.schema("buckets int, blocks int").json(f"{self.root}/layout").first()

    def create(self) -> None:
        """An empty table (IF NOT EXISTS)."""
        if not path_exists(self.spark, f"{self.root}/layout"):
            self.spark.createDataFrame([(self.buckets, self.blocks)], "buckets int, blocks int").coalesce(1) \
                .write.json(f"{self.root}/layout")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _bits(self, rows: DataFrame) -> DataFrame:
        """_bucket, key, block, bit: the bits of the filter that each row's key sets."""
        key = F.xxhash64(F.lit("filter"), *[F.col(k).cast("string") for k in self.keys])
        keyed = rows.select(self._bucket().alias("_bucket"), key.alias("key"))
        return keyed.select("_bucket", "key", F.pmod("key", F.lit(self.blocks)).cast("int").alias("block"),
                            F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col("key")), F.lit(BLOCK_BITS)) for i in range(PROBES)])).alias("bit"))

    # ---- reading

    def read(self) -> DataFrame:
        return self._in_buckets(None)

    def _in_buckets(self, buckets: list[int] | None) -> DataFrame:
        """The rows of some buckets: others are neither listed nor read."""
        if not path_exists(self.spark, self._rows):
            return self.spark.createDataFrame([], self.schema)
        schema = StructType([*self.schema.fields, StructField("_bucket", IntegerType())])
        table = self.spark.read.schema(schema).parquet(self._rows)
        if buckets is not None:
            table = table.where(F.col("_bucket").isin(buckets) if buckets else F.lit(False))
        return table.select(*self.schema.names)

    def buckets_of(self, source: DataFrame) -> tuple[list[int], list[int]]:
        """(buckets that may hold a key of ``source``, the other buckets that
        its keys belong to); at most ``buckets`` numbers reach the driver."""
        asked = self._bits(source)
        if not path_exists(self.spark, self._filters):
            return [], sorted(r[0] for r in asked.select("_bucket").distinct().collect())
        # a key may be known if all its bits are set
        byte = F.conv(F.hex(F.substring("bitmap", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        known = (asked.join(self._filter_rows(), ["_bucket", "block"], "left")
                 .select("_bucket", "key", F.coalesce(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False)).alias("set"))
                 .groupBy("_bucket", "key").agg(F.min("set").alias("known")).groupBy("_bucket").agg(F.max("known").alias("known"))).collect()
        return sorted(r["_bucket"] for r in known if r["known"]), sorted(r["_bucket"] for r in known if not r["known"])

    def _filter_rows(self) -> DataFrame:
        return self.spark.read.schema("block int, bitmap binary, _bucket int").parquet(self._filters)

    # ---- writing

    def upsert(self, source: DataFrame, check: bool = True) -> dict[str, list[int]]:
        """Update-or-insert ``source`` by key. Returns the buckets that
        were rewritten and the ones that only got new files."""
        src = materialize(self._shaped(source))
        if check:
            check_keys(src, self.keys)
        self.create()
        known, new = self.buckets_of(src)
        self._write_filters(src, known + new)
        placed = src.withColumn("_bucket", self._bucket())
        if known:
            mine = placed.where(F.col("_bucket").isin(known)).drop("_bucket")
            staged = materialize(merge_plan(self._in_buckets(known), mine, self.keys).withColumn("_bucket", self._bucket()))
            self._write(staged, overwrite=True)
        if new:
            self._write(placed.where(F.col("_bucket").isin(new)), overwrite=False)
        return {"rewritten": known, "added": new}

    def _write(self, rows: DataFrame, overwrite: bool) -> None:
        # a large bucket is dealt to several tasks, each sorted by the clustering column
        splits = max(1, -(-rows.count() // (self.buckets * ROWS_PER_FILE)))
        part = F.pmod(F.xxhash64(F.lit("file"), *[F.col(k) for k in self.keys]), F.lit(splits))
        writer = rows.repartition("_bucket", part).sortWithinPartitions("_bucket", self.cluster_col, *self.keys).write
        if overwrite:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode("append")
        writer.partitionBy("_bucket").parquet(self._rows)

    def append(self, rows: DataFrame) -> None:
        """Add rows whose keys are new by contract (event tables): nothing is read but the filters."""
        src = self._shaped(rows)
        self.create()
        self._write_filters(src, list(range(self.buckets)))
        self._write(src.withColumn("_bucket", self._bucket()), overwrite=False)

    def _write_filters(self, src: DataFrame, buckets: list[int]) -> None:
        """Set the bits of the source's keys: only the filters of its buckets are rewritten."""
        made = self._bits(src).groupBy("_bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        if path_exists(self.spark, self._filters):
            old = self._filter_rows().where(F.col("_bucket").isin(buckets)).select("_bucket", "block", "bitmap")
            made = materialize(made.unionByName(old).groupBy("_bucket", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap")))
        made.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("_bucket").parquet(self._filters)

    def _shaped(self, rows: DataFrame) -> DataFrame:
        """The table's columns; a nullable one that ``rows`` lacks is NULL."""
        return rows.select(*[(F.lit(None) if f.nullable and f.name not in rows.columns else F.col(f.name))
                             .cast(f.dataType).alias(f.name) for f in self.schema.fields])


def upsert_all(loads: list[tuple[KeyedTable, DataFrame]]) -> None:
    """Upsert several sources as one load: every source is staged and its keys
    are checked before any table is written, so a bad batch changes none."""
    staged = [(table, materialize(table._shaped(rows))) for table, rows in loads]
    for table, rows in staged:
        check_keys(rows, table.keys)
    for table, rows in staged:
        table.upsert(rows, check=False)


# Column whose values lie together in each table's files.
CLUSTER_COLUMNS = {
    "raw.prompt_datasets": "dataset_version",
    "raw.model_responses": "run_id",
    "evaluated.eval_results": "run_id",
    "metrics.metric_summary": "run_id",
    "metadata.runs": "run_id",
    "metadata.testgen_chunks": "dataset_version",
}


def create_catalog(spark: SparkSession, root: str, buckets: int = BUCKETS, blocks: int = 8) -> dict[str, KeyedTable]:
    """Every evaluation table as a keyed table under ``root``,
    registered as a temporary view named ``<db>_<table>``. ``buckets`` and
    ``blocks`` size the tables: about ``buckets * blocks * 3,000`` keys each."""
    out = {}
    for name, (schema, keys) in TABLES.items():
        t = KeyedTable(spark, f"{root.rstrip('/')}/{name.replace('.', '/')}", schema, keys, CLUSTER_COLUMNS[name], buckets, blocks)
        t.create()
        t.read().createOrReplaceTempView(name.replace(".", "_"))
        out[name] = t
    return out
