"""Files that come again: which are new, which hold other bytes, which are gone, and what that changes in the stored rows.

A ledger keeps the digest of every loaded file. Rows are stored in buckets by path. A file with another digest replaces its rows: a row
that was there keeps its id, others get ids after the highest given out, and those of other files aren't touched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxloom.functions.cells import named
from toxloom.operators.graph import last_by
from toxloom.operators.ordering import assign_ids
from toxloom.session import discard, staged_at
from toxloom.streaming import stored


def digests(files: DataFrame) -> DataFrame:
    """(path, digest) of (path, content). The content stays in the task that reads it."""
    return files.select("path", F.sha2(F.coalesce("content", F.lit(b"")), 256).alias("digest"))


def file_changes(seen: DataFrame, ledger: DataFrame | None, complete: bool = False) -> DataFrame:
    """(path, digest, status) of files that are `new`, `changed`, or, where `seen` is `complete`, `gone`. Files as before have no row."""
    seen = last_by(seen, "path", ["digest"], ["digest"])
    if ledger is None:
        return seen.withColumn("status", F.lit("new"))
    old = ledger.select("path", F.col("digest").alias("_was"))
    both = seen.join(old, "path", "full" if complete else "left")
    status = F.when(F.col("_was").isNull(), "new").when(F.col("digest").isNull(), "gone").when(F.col("digest") != F.col("_was"), "changed")
    return both.select("path", "digest", status.alias("status")).where(F.col("status").isNotNull())


def load_files(
    spark: SparkSession, root: str, files: DataFrame, decode: Callable[[DataFrame], DataFrame], complete: bool = False,
    row: str = "row", buckets: int = stored.BUCKETS,
) -> dict[str, int]:
    """Bring the stored rows in line with `files` (path, content). Returns how many files were new, changed and gone.

    `decode` turns files into rows with `path`, `row` and more; only new and changed files are decoded. With `complete` the files are all there
    are, and rows of others go. Rows are put before the ledger: a run that died between the two is made up for by the next, which finds the same
    files changed and the same rows. A file without rows is in the ledger too.
    """
    ledger = stored.open_version(spark, f"{root}/ledger")
    moved, moved_at = staged_at(file_changes(digests(files), None if ledger is None else stored.rows_of(spark, ledger), complete), "moved")
    counts = {r["status"]: r["count"] for r in moved.groupBy("status").count().collect()}  # three rows at most
    base = stored.open_version(spark, f"{root}/rows")
    if counts or base is None:
        fresh = files.join(moved.where("status <> 'gone'").select("path"), "path", "left_semi")
        rows, rows_at = staged_at(decode(fresh), "fresh")
        _put_rows(spark, root, base, moved, rows, row, buckets)
        gone = moved.withColumn("_gone", F.col("status") == "gone").select("path", "digest", "_gone")
        stored.replace_part(spark, f"{root}/ledger", gone, "path", (), "_gone", buckets)
        discard(spark, rows_at)
    discard(spark, moved_at)
    return {s: counts.get(s, 0) for s in ("new", "changed", "gone")}


def _put_rows(spark: SparkSession, root: str, base: stored.Version | None, moved: DataFrame, rows: DataFrame, row: str, buckets: int) -> None:
    columns = [c for c in rows.columns if c != "id"]
    highest = base.meta["highest"] if base else 0
    kept = None
    if base is not None:  # ids by (path, row) of the files that changed
        was = stored.rows_of(spark, base).select("path", row, "id").join(moved.where("status = 'changed'").select("path"), "path", "left_semi")
        kept, rows = rows.join(was, ["path", row]), rows.join(was, ["path", row], "left_anti")
    numbered = assign_ids(rows.select(*map(named, columns)), ["path", row], start=highest)
    added = rows.count()

    def fold(old: DataFrame | None) -> DataFrame:
        new = numbered.select("id", *map(named, columns))
        if old is None:
            return new
        rest = old.join(moved.select("path"), "path", "left_anti")
        return rest.unionByName(kept.select("id", *map(named, columns)), allowMissingColumns=True).unionByName(new, allowMissingColumns=True)

    stored.change(spark, f"{root}/rows", "path", moved, fold, buckets, {"highest": highest + added}, base)


def stored_rows(spark: SparkSession, root: str) -> DataFrame | None:
    return stored.read_stored(spark, f"{root}/rows")
