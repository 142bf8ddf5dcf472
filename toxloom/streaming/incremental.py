"""Incremental loads: a file stream lands change batches, readers fold them, a snapshot keeps them few; stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toxloom.functions.cells import named
from toxloom.operators.graph import last_by
from toxloom.session import discard, exists, names_in
from toxloom.streaming import stored

Transform = Callable[[DataFrame], DataFrame]


def incremental_load(
    spark: SparkSession, source: str, schema: T.StructType, checkpoint: str, target: str,
    transform: Transform = lambda df: df, fmt: str = "parquet", glob: str | None = None,
    files_per_batch: int | None = None, **options: str,
) -> None:
    """Load the files that have arrived since the last run, then stop.

    Each micro-batch overwrites a folder of its own number, so a batch replayed after a failure leaves no second
    copy, and a load costs what is new, not what is stored. The checkpoint is the restart point.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    _refuse_lost_checkpoint(spark, checkpoint, target)

    def land(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (
        reader.load(source).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_changes(spark: SparkSession, target: str, after: int = -1) -> DataFrame:
    """Rows of the finished batches behind `after`, with the number of their batch. There must be one."""
    done = [n for n in _complete(spark, target) if n > after]
    return spark.read.option("basePath", target).parquet(*[f"{target}/batch={n}" for n in done])


def current_rows(
    spark: SparkSession, target: str, key: str | Sequence[str], order_by: Sequence[str], removed: str | None = None,
) -> DataFrame:
    """Landed rows folded to the last one per key: later batches win, then `order_by` within one.

    A key whose last row has a true `removed` is gone. What `fold_changes` has folded is read from its snapshot: every batch behind it
    wins over it, so the snapshot's rows only lose the keys that come again, and reading costs the same after any number of loads.
    """
    keys = [key] if isinstance(key, str) else list(key)
    base = stored.open_version(spark, _snapshot(target))
    after = base.meta["upto"] if base else -1
    if base is not None and not any(n > after for n in _complete(spark, target)):
        return stored.rows_of(spark, base)
    last = last_by(read_changes(spark, target, after), keys, ["batch", *order_by])
    live = last.where(~F.coalesce(named(removed), F.lit(False))) if removed else last
    if base is None:
        return live
    rest = stored.rows_of(spark, base).join(last.select(*map(named, keys)), keys, "left_anti")
    return rest.unionByName(live, allowMissingColumns=True)


def fold_changes(
    spark: SparkSession, target: str, key: str | Sequence[str], order_by: Sequence[str], removed: str | None = None, every: int = 1,
    buckets: int = stored.BUCKETS,
) -> bool:
    """Fold the batches behind the snapshot into it, if `every` or more have landed. Returns whether it did.

    The snapshot is a stored table by key: only the buckets of changed keys are written anew. Readers see the old snapshot and all batches
    behind it until the new one is put, so they get the same rows before, during and after. Two folds at once: one of them fails.
    """
    keys = [key] if isinstance(key, str) else list(key)
    base = stored.open_version(spark, _snapshot(target))
    after = base.meta["upto"] if base else -1
    due = [n for n in _complete(spark, target) if n > after]
    if len(due) < max(every, 1):
        return False
    rows = read_changes(spark, target, after).where(F.col("batch") <= due[-1])
    flag = removed or "_removed"
    if removed is None:
        rows = rows.withColumn(flag, F.lit(False))
    last = last_by(rows, keys, ["batch", *order_by])
    live = last.where(~F.coalesce(named(flag), F.lit(False)))
    live = live if removed else live.drop(flag)

    def fold(old: DataFrame | None) -> DataFrame:
        if old is None:
            return live
        return old.join(last.select(*map(named, keys)), keys, "left_anti").unionByName(live, allowMissingColumns=True)

    stored.change(spark, _snapshot(target), keys, last, fold, buckets, {"upto": due[-1]}, base)
    return True


def drop_folded(spark: SparkSession, target: str) -> int:
    """Remove batches that the snapshot holds, for when no reader is still on an older one. Returns their number."""
    base = stored.open_version(spark, _snapshot(target))
    gone = [n for n in _complete(spark, target) if base is not None and n <= base.meta["upto"]]
    for n in gone:
        discard(spark, f"{target}/batch={n}")
    return len(gone)


def _snapshot(target: str) -> str:
    return f"{target.rstrip('/')}/folded"


def _refuse_lost_checkpoint(spark: SparkSession, checkpoint: str, target: str) -> None:
    """Batch numbers start anew with a fresh checkpoint: new rows would land below stored ones and lose against them."""
    if not exists(spark, checkpoint) and (_complete(spark, target) or stored.versions(spark, _snapshot(target))):
        raise ValueError(f"{target} has batches, but the checkpoint {checkpoint} is gone: load into a new target")


def _complete(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the finished batches."""
    numbers = [int(n[6:]) for n in names_in(spark, target) if n.startswith("batch=") and n[6:].isdigit()]
    return sorted(n for n in numbers if exists(spark, f"{target}/batch={n}/_SUCCESS"))


# Stored tables ---------------------------------------------------------------------------------------------------

def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest version of a stored table, or None."""
    return stored.read_stored(spark, root)


def upsert_stored(
    spark: SparkSession, root: str, updates: DataFrame, key: str | Sequence[str], props: Sequence[str],
    order_by: Sequence[str], buckets: int = stored.BUCKETS,
) -> DataFrame:
    """Upsert into a stored node or edge table. Buckets without updates are neither read nor written."""
    return stored.rows_of(spark, stored.upsert_part(spark, root, updates, key, props, order_by, buckets))
