"""Stored tables that change in part.

A table is dealt into buckets by a hash of its keys, each a folder of Parquet files. A version is a small list that says which folder
holds which bucket. A change reads and writes only the buckets that its keys fall into, in new folders, and its list refers to
the old folders for the rest. Nothing that a version refers to is ever overwritten, so readers of older versions go on undisturbed.

A list appears whole, and only where its number is not taken. Of two writers of one version the later one starts over on the newer
list if both touched different buckets, and fails with `Conflict` if not: no change is lost.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toxloom.functions.cells import named
from toxloom.operators.graph import has_keys, last_by, update_nodes, upsert_nodes
from toxloom.session import discard, names_in, put_if_absent, read_small

BUCKETS = 16          # of a new table; choose it so that a bucket holds some GB. A small change costs less with more of them, lists and plans grow
BUCKET = "_in_bucket"  # column of the folders; no table may have it
Fold = Callable[[DataFrame | None], DataFrame]


class Conflict(RuntimeError):
    """Another writer has put a newer version that touches the same buckets."""


class Version(NamedTuple):
    root: str
    number: int
    keys: list[str]
    buckets: int
    schema: T.StructType
    folders: dict[int, str]  # of each bucket that has rows
    changed: list[int]       # buckets that this version wrote
    meta: dict[str, Any]     # what the writer keeps with the table

    def text(self) -> str:
        fields = self._asdict() | {"schema": self.schema.jsonValue(), "folders": {str(k): v for k, v in self.folders.items()}}
        return json.dumps({k: v for k, v in fields.items() if k != "root"})


def _list(root: str, number: int) -> str:
    return f"{root}/_list-{number:010d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    names = (n for n in names_in(spark, root) if n.startswith("_list-") and n.endswith(".json"))
    return sorted(int(n[6:-5]) for n in names)


def open_version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The newest version, or the one asked for; None before the first write."""
    root = root.rstrip("/")
    if number is None:
        done = versions(spark, root)
        if not done:
            return None
        number = done[-1]
    own = json.loads(read_small(spark, _list(root, number)))
    folders = {int(k): v for k, v in own["folders"].items()}
    return Version(root, own["number"], own["keys"], own["buckets"], T.StructType.fromJson(own["schema"]), folders, own["changed"], own["meta"])


def rows_of(spark: SparkSession, version: Version, buckets: Iterable[int] | None = None) -> DataFrame:
    """Rows of a version, or of some of its buckets only. A column that came later is null in buckets written before."""
    wanted = version.folders if buckets is None else [b for b in buckets if b in version.folders]
    paths = [f"{version.root}/{version.folders[b]}" for b in sorted(wanted)]
    if not paths:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*paths)


def read_stored(spark: SparkSession, root: str) -> DataFrame | None:
    version = open_version(spark, root)
    return None if version is None else rows_of(spark, version)


def changed_rows(spark: SparkSession, version: Version) -> DataFrame:
    """Rows in the buckets that this version wrote."""
    return rows_of(spark, version, version.changed)


def signed_between(spark: SparkSession, root: str, old: int, new: Version) -> DataFrame:
    """Rows in the buckets written since version `old` (0: since there was none): as they were with `sign` -1, as they are with 1."""
    since = [open_version(spark, root, n) for n in versions(spark, root) if old <= n <= new.number]
    touched = sorted({b for v in since if v.number > old for b in v.changed})
    if len({v.buckets for v in since}) > 1:
        touched = None  # dealt anew in between
    now = rows_of(spark, new, touched).withColumn("sign", F.lit(1))
    if not old:
        return now
    was = rows_of(spark, open_version(spark, root, old), touched).withColumn("sign", F.lit(-1))
    return now.unionByName(was, allowMissingColumns=True)


def bucket(keys: Sequence[str], kinds: T.StructType, buckets: int) -> Column:
    """Keys are cast to the stored types first: the hash of a number depends on its width."""
    return F.pmod(F.xxhash64(*[named(k).cast(kinds[k].dataType.simpleString()) for k in keys]), F.lit(buckets)).cast("int")


def change(
    spark: SparkSession, root: str, keys: str | Sequence[str], touching: DataFrame | None, fold: Fold,
    buckets: int = BUCKETS, meta: dict[str, Any] | None = None, base: Version | None = None,
) -> Version:
    """Put the next version: buckets that the keys of `touching` fall into become `fold(their rows)`, the others stay.

    `touching` of None touches all. `fold` gets None before the first version, and may only give rows of touched buckets. `buckets`
    counts for a new table only. With `base` the change rests on that version, else on the newest. `meta` replaces the entries it names.
    """
    root = root.rstrip("/")
    keys = [keys] if isinstance(keys, str) else list(keys)
    base = base or open_version(spark, root)
    if base is not None and base.keys != keys:
        raise ValueError(f"{root} is keyed by {', '.join(base.keys)}")
    n = base.buckets if base else buckets
    if touching is None:
        mine = list(range(n))
    else:
        kinds = base.schema if base else touching.schema
        mine = sorted(r[0] for r in touching.select(bucket(keys, kinds, n)).distinct().collect())  # at most n rows
    if base is not None and not mine and not meta:
        return base
    old = None if base is None else rows_of(spark, base, mine)
    new = fold(old)
    if BUCKET in new.columns:
        raise ValueError(f"a stored table can't have a column {BUCKET}")
    schema = _schema(base, new)
    load = f"load={uuid.uuid4().hex[:16]}"
    held: list[int] = []
    if mine:
        own = bucket(keys, schema, n)
        if touching is not None:
            own = F.when(own.isin(mine), own).otherwise(F.raise_error(F.lit("a row outside the touched buckets")).cast("int"))
        out = new.select(*[named(f.name).cast(f.dataType.simpleString()).alias(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType.simpleString()).alias(f.name) for f in schema], own.alias(BUCKET))
        # Large buckets are cut into files of the advised size, small ones get one file each.
        out.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{root}/{load}")
        held = [int(x.split("=")[1]) for x in names_in(spark, f"{root}/{load}") if x.startswith(f"{BUCKET}=")]
    own_folders = {b: f"{load}/{BUCKET}={b}" for b in held}
    while True:
        rest = {b: f for b, f in base.folders.items() if b not in mine} if base else {}
        version = Version(root, base.number + 1 if base else 1, keys, n, schema, rest | own_folders, mine, (base.meta if base else {}) | (meta or {}))
        if put_if_absent(spark, _list(root, version.number), version.text()):
            return version
        rival = open_version(spark, root, version.number)
        if base is None or meta or rival.buckets != n or set(rival.changed) & set(mine) or rival.schema != base.schema or schema != base.schema:
            if mine:
                discard(spark, f"{root}/{load}")
            raise Conflict(f"{root} has a version {rival.number} of another writer")
        base = rival


def _schema(base: Version | None, new: DataFrame) -> T.StructType:
    """Columns of the stored table, then those that come new. A column can't change its type: other buckets hold it."""
    plain = lambda s: [T.StructField(f.name, f.dataType, True) for f in s.fields]
    if base is None:
        return T.StructType(plain(new.schema))
    own = {f.name: f.dataType for f in base.schema.fields}
    for f in new.schema.fields:
        if own.get(f.name, f.dataType).simpleString() != f.dataType.simpleString():
            raise ValueError(f"{f.name} is stored as {own[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*base.schema.fields, *[f for f in plain(new.schema) if f.name not in own]])


def rebucket(spark: SparkSession, root: str, buckets: int) -> Version:
    """Deal a table that has grown, or shrunk, into another number of buckets. Reads and writes all of it."""
    root = root.rstrip("/")
    base = open_version(spark, root)
    load = f"load={uuid.uuid4().hex[:16]}"
    out = rows_of(spark, base).withColumn(BUCKET, bucket(base.keys, base.schema, buckets))
    out.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{root}/{load}")
    folders = {int(x.split("=")[1]): f"{load}/{x}" for x in names_in(spark, f"{root}/{load}") if x.startswith(f"{BUCKET}=")}
    version = base._replace(number=base.number + 1, buckets=buckets, folders=folders, changed=list(range(buckets)))
    if not put_if_absent(spark, _list(root, version.number), version.text()):
        discard(spark, f"{root}/{load}")
        raise Conflict(f"{root} has a version {version.number} of another writer")
    return version


def forget(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Remove what only versions before the newest `keep` refer to. Not while another writer is at work: its folder isn't listed yet."""
    root = root.rstrip("/")
    done = versions(spark, root)
    kept = {f.split("/")[0] for n in done[-keep:] for f in open_version(spark, root, n).folders.values()}
    gone = [x for x in names_in(spark, root) if x.startswith("load=") and x not in kept]
    for n in done[:-keep]:
        discard(spark, _list(root, n))
    for x in gone:
        discard(spark, f"{root}/{x}")
    return len(gone)


# Changes by key ---------------------------------------------------------------------------------------------------------

def _keyed(spark: SparkSession, root: str, updates: DataFrame, keys: Sequence[str]) -> tuple[Version | None, DataFrame]:
    """The version to change, and updates with a key of the stored types."""
    base = open_version(spark, root)
    if base is not None:
        updates = updates.withColumns({k: named(k).cast(base.schema[k].dataType.simpleString()) for k in keys})
    return base, has_keys(updates, keys)


def upsert_part(
    spark: SparkSession, root: str, updates: DataFrame, key: str | Sequence[str], props: Sequence[str], order_by: Sequence[str], buckets: int = BUCKETS,
) -> Version:
    """Create or overwrite properties of stored nodes or edges; only the buckets of the updates are read and written."""
    keys = [key] if isinstance(key, str) else list(key)
    base, updates = _keyed(spark, root, updates, keys)
    return change(spark, root, keys, updates, lambda old: upsert_nodes(old, updates, keys, props, order_by), buckets, base=base)


def update_part(spark: SparkSession, root: str, updates: DataFrame, key: str | Sequence[str], props: Sequence[str], order_by: Sequence[str]) -> Version:
    """Overwrite properties of stored nodes that exist; unknown keys are ignored."""
    keys = [key] if isinstance(key, str) else list(key)
    base, updates = _keyed(spark, root, updates, keys)
    if base is None:
        raise ValueError(f"{root} has no table yet")
    return change(spark, root, keys, updates, lambda old: update_nodes(old, updates, keys, props, order_by), base=base)


def replace_part(
    spark: SparkSession, root: str, rows: DataFrame, key: str | Sequence[str], order_by: Sequence[str] = (), removed: str | None = None,
    buckets: int = BUCKETS, meta: dict[str, Any] | None = None,
) -> Version:
    """Whole rows by key: the last of each key takes the place of the stored one, or takes it away where `removed` is true."""
    keys = [key] if isinstance(key, str) else list(key)
    base, rows = _keyed(spark, root, rows, keys)
    last = last_by(rows, keys, order_by).select(*map(named, rows.columns))
    stay = last if removed is None else last.where(~F.coalesce(named(removed), F.lit(False))).drop(removed)

    def fold(old: DataFrame | None) -> DataFrame:
        if old is None:
            return stay
        return old.join(last.select(*map(named, keys)), keys, "left_anti").unionByName(stay, allowMissingColumns=True)

    return change(spark, root, keys, rows, fold, buckets, meta, base)
