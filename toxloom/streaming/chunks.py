"""Loads by ranges of ids that resume where they stopped, with totals taken while writing.

A run walks the ids in ranges. Each range is written to a folder of its own and noted in a journal, together with its totals, once
it is whole. The next run goes on behind the last range noted: no start is set by hand, and what a run that died left behind is never read. Totals come
from the write itself (`DataFrame.observe`), not from another pass.

Many small ranges are written in waves: one job, one folder and one note for all ranges of a wave, so the source is read once a wave. Their totals are
one aggregate by range over what was written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from toxloom.functions.cells import named
from toxloom.operators.ordering import scan_id_range
from toxloom.session import names_in, put_if_absent, read_small


def journal(spark: SparkSession, root: str) -> list[dict]:
    """The ranges noted, in order: lo, hi, folder, totals. As many as a run has ranges; a note holds those of a wave."""
    names = [n for n in names_in(spark, root) if n.startswith("_range-")]
    notes = [json.loads(read_small(spark, f"{root}/{n}")) for n in names]
    return sorted((r for note in notes for r in (note if isinstance(note, list) else [note])), key=lambda r: r["lo"])


def observed(df: DataFrame, totals: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict]]:
    """The frame, and a function that gives totals of its rows once they have been written."""
    seen = Observation(f"totals-{uuid.uuid4().hex[:8]}")
    out = df.observe(seen, *[c.alias(n) for n, c in totals.items()])
    return out, lambda: dict(seen.get)


def totals_by_range(written: DataFrame, lo: int, column: str, size: int, starts: range, totals: dict[str, Column]) -> list[dict]:
    """Totals of each range from `lo` on, those without rows too. One row a range comes to the driver."""
    aggregates = [c.alias(n) for n, c in totals.items()]
    away = named(column).cast("bigint") - lo
    first = (F.lit(lo) + away - F.pmod(away, F.lit(size))).alias("_range")
    found = {r[0]: dict(zip(totals, r[1:])) for r in written.groupBy(first).agg(*aggregates).collect()}
    if any(s not in found for s in starts):
        none = written.where(F.lit(False)).agg(*aggregates).first().asDict()
    return [found[s] if s in found else none for s in starts]


def load_ranges(
    spark: SparkSession, source: DataFrame, root: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, column: str = "id",
    size: int = 1_000_000, totals: dict[str, Column] | None = None, start: int | None = None, stop: int | None = None, most: int | None = None, wave: int = 1,
) -> int:
    """Load the ids not loaded yet, `size` of them a range, and return the number of ranges written.

    From `start` (the smallest id) or where the journal ends, up to `stop` (behind the highest id now), exclusive. `most` ends a run after so many
    ranges. Ids below the journal's end that come later are not seen, nor are null ids. Two runs at once: the later one to finish
    a range fails, and its folder isn't noted.

    With `wave` above 1 so many ranges are written and noted together: `transform` then gets the rows of all of them, must keep `column` and
    must not mix rows of different ids.
    """
    root = root.rstrip("/")
    done = journal(spark, root)
    bounds = source.agg(F.min(named(column)), F.max(named(column))).first()
    if bounds[0] is None:
        return 0
    lo = done[-1]["hi"] if done else bounds[0] if start is None else start
    end = bounds[1] + 1 if stop is None else stop
    n = 0
    while lo < end and (most is None or n < most):
        together = min(wave, -(-(end - lo) // size), wave if most is None else most - n)
        hi = min(lo + together * size, end)
        folder = f"range={lo}-{uuid.uuid4().hex[:8]}"
        wanted = totals or {"rows": F.count("*")}
        rows, starts = transform(scan_id_range(source, lo, hi, column)), range(lo, hi, size)
        if together == 1:
            out, counted = observed(rows, wanted)
            out.write.parquet(f"{root}/{folder}")
            found = [counted()]
        else:
            rows.write.parquet(f"{root}/{folder}")
            found = totals_by_range(spark.read.parquet(f"{root}/{folder}"), lo, column, size, starts, wanted)
        note = [{"lo": s, "hi": min(s + size, hi), "folder": folder, "totals": t} for s, t in zip(starts, found)]
        if not put_if_absent(spark, f"{root}/_range-{lo:020d}.json", json.dumps(note, default=str)):
            raise RuntimeError(f"another run has loaded the range from {lo}")
        lo, n = hi, n + together
    return n


def read_ranges(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the ranges noted. There must be one."""
    folders = dict.fromkeys(r["folder"] for r in journal(spark, root))
    return spark.read.parquet(*[f"{root.rstrip('/')}/{f}" for f in folders])


def range_totals(spark: SparkSession, root: str) -> DataFrame:
    """lo, hi and the totals of each range."""
    rows = [{"lo": r["lo"], "hi": r["hi"], **r["totals"]} for r in journal(spark, root.rstrip("/"))]
    if not rows:
        return spark.createDataFrame([], "lo bigint, hi bigint")
    names = list(rows[0])
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], names)
