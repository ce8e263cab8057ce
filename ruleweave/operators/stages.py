"""Computed-once side tables and size-checked joins against them."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Above this many bytes a side table is no longer broadcast.
BROADCAST_LIMIT = 64 * 1024 * 1024
# Rows of one key that a single task may join.
ROWS_PER_PIECE = 1_000_000
# Pairs of rows of one key that a single task may form.
PAIRS_PER_CELL = 10_000_000
# Buckets by which rows are counted before any key is.
KEY_BUCKETS = 1 << 16


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; where none is named, one inside the warehouse, which is shared too."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging")


# Folders written by this process and not yet deleted, with the name of the table over them, if there is one.
_STAGED: dict[str, str | None] = {}


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that is written and read again."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _STAGED[path] = None
    return path


def materialize(
    df: DataFrame, *, codec: str | None = None, options: dict[str, str] | None = None, at_home: bool = False
) -> DataFrame:
    """Compute once: write to the shared folder as Parquet and read back.

    The lineage ends at the files, which outlive lost executors, and later reads take only the columns they need. ``codec``: by
    default that of the session; ``zstd`` takes less room for texts that repeat near each other. ``options`` go to the writer.
    With ``at_home`` a join whose sides are both dealt by ``HOME`` shuffles neither, whatever its other keys.
    """
    spark = df.sparkSession
    path = staging_path(spark, "stage")
    with _setting(spark, ALL_KEYS, "false") if at_home else nullcontext():
        df.write.options(**(options or {})).parquet(path, compression=codec)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.staged_path = path
    return stored


def store_bucketed(df: DataFrame, key: str, *, buckets: int | None = None, dealt: bool = False) -> DataFrame:
    """Compute once, as a table bucketed and sorted by ``key``: no join or aggregate on the key shuffles it again.

    ``dealt``: an aggregate on the key has just dealt the rows, which are written as they lie.

    There are as many buckets as shuffle partitions, so the other side of a join is shuffled to the buckets. The files lie in
    the shared folder; the table's name is known to the session's catalog until ``release``.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = staging_path(spark, "buckets"), f"ruleweave_{uuid.uuid4().hex}"
    _STAGED[path] = name
    # One task per bucket, so a bucket is one file; an aggregate deals rows by the same hash.
    writer = (df if dealt else df.repartition(buckets, key)).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).format("parquet").saveAsTable(name)
    stored = spark.table(name)
    stored.staged_path = path
    return stored


# Columns of ``store_in_place``: where a row lies, and its own number.
HOME, PLACE = "_home", "_place"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _home_numbers(spark: SparkSession, homes: int) -> list[int]:
    """A number for each bucket whose hash falls into it."""
    found, tried = {}, homes * 32
    while len(found) < homes:
        bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(homes))
        found = dict(spark.range(tried).groupBy(bucket).agg(F.min("id")).collect())
        tried *= 2
    return [found[i] for i in range(homes)]


def store_in_place(df: DataFrame, homes: int, *, codec: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Compute once, as a table bucketed by ``HOME``, which tells the task that wrote a row; ``PLACE`` tells rows apart.

    Rows are written as they lie, without a shuffle or a sort. A frame dealt by ``HOME`` to as many partitions meets them where they
    lie (``materialize`` with ``at_home``), so what belongs to a row is sent to it and its texts do not move. There are ``homes``
    buckets; a home holds as many rows as its tasks wrote. The table's name is known to the session's catalog until ``release``.
    """
    spark = df.sparkSession
    path, name = staging_path(spark, "homes"), f"ruleweave_{uuid.uuid4().hex}"
    _STAGED[path] = name
    numbers = F.array(*[F.lit(n).cast("int") for n in _home_numbers(spark, homes)])
    home = F.get(numbers, F.spark_partition_id() % homes)
    placed = df.select("*", home.alias(HOME), F.monotonically_increasing_id().alias(PLACE))
    options = (options or {}) | ({"compression": codec} if codec else {})
    # A task writes one bucket; with a writer of its own its rows need not be sorted by bucket first.
    with _setting(spark, WRITERS, "1"):
        placed.write.bucketBy(homes, HOME).options(**options, path=path).format("parquet").saveAsTable(name)
    stored = spark.table(name)
    stored.staged_path = path
    return stored


def _delete(spark: SparkSession, path: str) -> None:
    if name := _STAGED.get(path):
        spark.sql(f"drop table if exists {name}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _STAGED.pop(path, None)


def discard(stored: DataFrame) -> None:
    """Delete the files of a frame made by ``materialize``, once nothing reads it any more."""
    _delete(stored.sparkSession, stored.staged_path)


def release(spark: SparkSession) -> None:
    """Delete every staged folder of this process. Call it after the sink: frames that read the folders end here."""
    for path in sorted(_STAGED):
        _delete(spark, path)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as counted by Spark, in one aggregate."""

    def width(kind: T.DataType, column: Column) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 16
        if isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
                sizes = F.transform(column, lambda x: width(kind.elementType, x).cast("long"))
                return F.coalesce(F.aggregate(sizes, F.lit(24).cast("long"), lambda a, x: a + x), F.lit(8))
            return F.coalesce(F.size(column), F.lit(0)) * 8 + 24
        if isinstance(kind, T.StructType):
            return sum((width(f.dataType, column[f.name]) for f in kind.fields), F.lit(16))
        if isinstance(kind, (T.MapType, T.VariantType)):
            raise TypeError(f"cannot measure {kind.simpleString()}")
        return F.lit(8)

    row = sum((width(f.dataType, F.col(f.name)) for f in df.schema.fields), F.lit(16))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup_join(
    left: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    spread_by: str,
    stored: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Join a large frame with a side table that holds one row per key.

    The side table is computed once and measured. Up to ``limit`` bytes (by default ``BROADCAST_LIMIT``) it is
    broadcast, so ``left`` is not shuffled. Beyond that keys with too many rows of ``left`` for one task are cut into pieces
    by a hash of ``spread_by``, and only their rows of the side table are repeated. The keys of a stream cannot be
    counted: hand over its micro-batches (``foreachBatch``) where a key may be hot.
    """
    if not stored:
        side = materialize(side)
    if measured_bytes(side) <= (BROADCAST_LIMIT if limit is None else limit):
        return left.join(F.broadcast(side), on, how)
    hot = None if left.isStreaming else hot_keys(left, on, ROWS_PER_PIECE)
    return left.join(side, on, how) if hot is None else _piece_join(left, side, on, how, spread_by, hot, ROWS_PER_PIECE)


def hot_keys(df: DataFrame, on: list[str], size: int) -> DataFrame | None:
    """(on, _n): keys with more than ``size`` rows, a missing key like any other; stored. None if there are none.

    Rows are counted by buckets of the key's hash first, in the tasks that read them. Only keys of buckets with more than
    ``size`` rows are counted one by one, so where no key is hot no key is shuffled.
    """
    keys = df.select(*on, F.pmod(F.xxhash64(*on), F.lit(KEY_BUCKETS)).cast("int").alias("_bucket"))
    counts = keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most KEY_BUCKETS numbers.
    full = [r["_bucket"] for r in counts.filter(F.col("_n") > size).collect()]
    if not full:
        return None
    full = F.broadcast(df.sparkSession.createDataFrame([(b,) for b in full], "_bucket int"))
    counted = keys.join(full, "_bucket").groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(counted.filter(F.col("_n") > size))
    return None if hot.isEmpty() else hot


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    spread_by: str,
    rows_per_piece: int | None = None,
) -> DataFrame:
    """Join a frame, in which a key may repeat without limit, with a large one that holds it once.

    If some keys have more than ``rows_per_piece`` rows (by default ``ROWS_PER_PIECE``), ``left`` is stored and parted: the hot
    keys' rows of ``right``, at most one per so many rows of ``left``, are broadcast to theirs, if their measured size allows;
    else the hot keys are cut into pieces by a hash of ``spread_by``. All other rows join as they are, so a bucketed
    ``right`` is never shuffled. A missing key counts as one too. ``how``: left, inner or left_semi.
    """
    if left.isStreaming:
        return lookup_join(left, right, on, how, spread_by=spread_by, stored=True)
    size = rows_per_piece or ROWS_PER_PIECE
    hot = hot_keys(left, on, size)
    if hot is None:
        return left.join(right, on, how)
    left = materialize(left)
    keys, same = _named(hot, on)
    few = materialize(right.join(F.broadcast(keys), same, "left_semi"))
    if measured_bytes(few) > BROADCAST_LIMIT:
        return _piece_join(left, right, on, how, spread_by, hot, size)
    cold = left.join(F.broadcast(keys), same, "left_anti").join(right, on, how)
    return cold.unionByName(left.join(F.broadcast(keys), same, "left_semi").join(F.broadcast(few), on, how))


def _named(keys: DataFrame, on: list[str], *more: Column | str) -> tuple[DataFrame, Column]:
    """Keys under names of their own, and the condition that a row has one of them; a missing key matches itself."""
    renamed = keys.select(*[F.col(c).alias(f"_hot_{c}") for c in on], *more)
    return renamed, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in on])


def _piece_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, spread_by: str, hot: DataFrame, size: int
) -> DataFrame:
    # At most one row per ``size`` rows of ``left``. A missing key matches itself here, so its rows are cut as well.
    keys, same = _named(hot, on, F.ceil(F.col("_n") / size).cast("int").alias("_pieces"))
    keys = F.broadcast(keys)
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    names = [f"_hot_{c}" for c in on]
    cut_left = left.join(keys, same, "left").withColumn("_piece", F.pmod(F.xxhash64(spread_by), pieces).cast("int"))
    cut_right = right.join(keys, same, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    joined = cut_left.drop("_pieces", *names).join(cut_right.drop("_pieces", *names), [*on, "_piece"], how)
    return joined.drop("_piece")


def pair_join(left: DataFrame, right: DataFrame, on: str, right_on: str, *, pairs: int | None = None) -> DataFrame:
    """Inner join of two frames in either of which a key may repeat without limit; missing keys match each other.

    A key that forms more than ``pairs`` pairs (by default ``PAIRS_PER_CELL``) is cut on both sides: its rows on the left are
    dealt to the rows of a grid and its rows on the right to the columns, each repeated along its line, so that a task forms the
    pairs of a cell. Rows are dealt by their place in the stored frame, so equal rows part as well.
    """
    pairs = pairs or PAIRS_PER_CELL
    side = max(1, math.isqrt(pairs))
    keyed = left.select(F.col(on).alias("_key")), right.select(F.col(right_on).alias("_key"))
    # More than ``pairs`` pairs need more than ``side`` rows on one side.
    found = [hot for df in keyed if (hot := hot_keys(df, ["_key"], side)) is not None]
    plain = F.col(on).eqNullSafe(F.col(right_on))
    if not found:
        return left.join(right, plain, "inner")
    both = reduce(lambda a, b: a.unionByName(b), [h.select("_key") for h in found]).distinct()
    names, same = _named(both, ["_key"])
    names = F.broadcast(names)
    rows, columns = (
        df.join(names, same, "left_semi").groupBy("_key").agg(F.count(F.lit(1)).cast("double").alias(n))
        for df, n in zip(keyed, ("_l", "_r"))
    )
    # A short side is not cut, and the other one the more.
    high, wide = F.ceil(F.col("_l") / side), F.ceil(F.col("_r") / side)
    cells = F.ceil(F.col("_l") * F.col("_r") / pairs)
    grid = rows.join(columns.withColumnRenamed("_key", "_other"), F.col("_key").eqNullSafe(F.col("_other")))
    grid = grid.filter(F.col("_l") * F.col("_r") > pairs).select(
        F.col("_key").alias("_cut"),
        F.when(wide == 1, cells).when(high == 1, 1).otherwise(high).cast("int").alias("_rows"),
        F.when(high == 1, cells).when(wide == 1, 1).otherwise(wide).cast("int").alias("_columns"),
    )
    grid = materialize(grid)
    if grid.isEmpty():
        return left.join(right, plain, "inner")
    # At most one row per ``pairs`` rows of the result.
    grid = F.broadcast(grid)

    def dealt(df: DataFrame, key: str, mine: str, other: str) -> DataFrame:
        placed = materialize(df.withColumn("_place", F.monotonically_increasing_id()))
        placed = placed.join(grid, F.col(key).eqNullSafe(F.col("_cut")), "left")
        own = F.pmod(F.xxhash64("_place"), F.coalesce(F.col(mine), F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        placed = placed.withColumn(f"_own{mine}", own).withColumn(f"_all{other}", every)
        return placed.drop("_place", "_cut", "_rows", "_columns")

    cut_left = dealt(left, on, "_rows", "_columns")
    cut_right = dealt(right, right_on, "_columns", "_rows")
    meet = plain & (F.col("_own_rows") == F.col("_all_rows")) & (F.col("_all_columns") == F.col("_own_columns"))
    return cut_left.join(cut_right, meet, "inner").drop("_own_rows", "_all_rows", "_own_columns", "_all_columns")
