"""Large workbooks decoded by many tasks.

A workbook is a zip archive, so one task has to unpack it; it cuts the sheet and the shared texts at the ends of rows and items, without
parsing them, into parts of bounded size. The parts are written once and dealt out, and other tasks parse them. Cells that name a shared text meet it
by a join, and only those of the columns that are wanted. No task holds more than the archive or a few parts.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from typing import IO, NamedTuple
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toxloom.functions.cells import na_to_null
from toxloom.operators.joins import lookup_join
from toxloom.session import staged
from toxloom.sources import workbooks as W
from toxloom.sources.batches import sliced

PART_BYTES = 1 << 20  # of XML in a part; a longer row is a part of its own
READ = 1 << 18
TOGETHER = 64           # parts that a task parses at most, but for the deal's chance


class Part(NamedTuple):
    first: int   # items before this part
    last: int    # items up to its end
    xml: bytes   # a document of its own


def cut(stream: IO[bytes], item: str, limit: int = PART_BYTES) -> Iterator[Part]:
    """Cut an XML document behind ends of `item` elements. Every part gets the opening tags, so it parses alone.

    Items count from 1; an `r` attribute sets the count, as for sheet rows. Documents that can't be cut by their bytes, those of
    another encoding than UTF-8 or with literal sections, come as one part.
    """
    head, held, open_tags, close_tags = b"", b"", b"", b""
    tag = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?" + item.encode() + rb"(?=[\s/>])([^>]*)>")
    end = re.compile(rb"</(?:[A-Za-z_][\w.-]*:)?" + item.encode() + rb"\s*>|<(?:[A-Za-z_][\w.-]*:)?" + item.encode() + rb"(?=[\s/>])[^>]*/>")
    count, whole, given = 0, False, False

    def numbered(body: bytes) -> int:
        n = count
        for m in tag.finditer(body):
            own = re.search(rb"(?<![\w:])r\s*=\s*[\"'](\d+)[\"']", m.group(1))
            n = int(own.group(1)) if own else n + 1
        return n

    while True:
        block = stream.read(READ)
        held += block
        if not open_tags and not whole:
            first = tag.search(held)
            if first is None and block:
                continue
            if first is None:  # no items at all
                yield Part(0, 0, held)
                return
            head = held[:first.start()]
            whole = not held.lstrip(b"\xef\xbb\xbf").startswith(b"<") or bool(re.search(rb"encoding=[\"'](?!utf-8[\"'])", head[:200], re.I))
            names = re.findall(rb"<((?:[A-Za-z_][\w.-]*:)?[A-Za-z_][\w.-]*)(?:\s[^<>]*)?(?<!/)>|</((?:[A-Za-z_][\w.-]*:)?[A-Za-z_][\w.-]*)\s*>", head)
            still: list[bytes] = []
            for begun, ended in names:
                if begun:
                    still.append(begun)
                elif still:
                    still.pop()
            open_tags, held = head, held[first.start():]
            close_tags = b"".join(b"</" + n + b">" for n in reversed(still))
        whole = whole or b"<![CDATA[" in held or b"<!--" in held
        done = 0
        for m in () if whole or len(held) < limit else end.finditer(held):
            if m.end() - done >= limit:
                body, done = held[done:m.end()], m.end()
                last = numbered(body)
                yield Part(count, last, open_tags + body + close_tags)
                count, given = last, True
        held = held[done:]
        if not block:
            break
    # What follows the last item closes the document.
    if held and (tag.search(held) or not given):
        last = numbered(held)
        yield Part(count, last, open_tags + held)


def _sheet_part(xml: bytes, first: int, last: int, dates: set[int]) -> Iterator[tuple[int, list[str | None], list[int | None]]]:
    """(number, cells, shared text numbers) of all rows in a part, blank ones as empty lists."""
    expected = first + 1
    for _, row in ElementTree.iterparse(io.BytesIO(xml)):
        if row.tag != f"{W.SHEET}row":
            continue
        number = int(row.get("r", expected))
        cells: list[str | None] = []
        refs: list[int | None] = []
        for c in row.findall(f"{W.SHEET}c"):
            at = W._column(c.get("r"), len(cells))
            cells.extend([None] * (at + 1 - len(cells)))
            refs.extend([None] * (at + 1 - len(refs)))
            value = c.find(f"{W.SHEET}v")
            if c.get("t") == "s":
                refs[at] = int(value.text) if value is not None and value.text else None
            else:
                cells[at] = W._cell(c, [], dates)
        row.clear()
        yield from ((n, [], []) for n in range(expected, number))
        if all(c is None for c in cells) and all(r is None for r in refs):
            cells, refs = [], []
        yield number, cells, refs
        expected = number + 1
    yield from ((n, [], []) for n in range(expected, last + 1))


def unpack(files: DataFrame, limit: int = PART_BYTES) -> DataFrame:
    """Parts of (path, content) workbooks: `path`, `kind` (sheet, texts or error), `first`, `last`, `xml`, `dates`."""
    names = ["path", "kind", "first", "last", "xml", "dates"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())]

    def one(*row: object) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path = batch.column(0)[i].as_py()
                try:
                    with zipfile.ZipFile(io.BytesIO(batch.column(1)[i].as_py())) as book:
                        sheet, _, dates = W._parts(book, texts=False)
                        if "xl/sharedStrings.xml" in book.namelist():
                            with book.open("xl/sharedStrings.xml") as xml:
                                for p in cut(xml, "si", limit):
                                    yield one(path, "texts", p.first, p.last, p.xml, [])
                        with book.open(sheet) as xml:
                            for p in cut(xml, "row", limit):
                                yield one(path, "sheet", p.first, p.last, p.xml, sorted(dates))
                except Exception as e:
                    yield one(path, "error", 0, 0, f"{type(e).__name__}: {e}".encode(), [])

    return files.select("path", "content").mapInArrow(run, "path string, kind string, first bigint, last bigint, xml binary, dates array<int>")


def _parsed_sheets(parts: DataFrame) -> DataFrame:
    """path, number, cells, refs, error: every sheet row, or the fault of a part."""
    types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.string()]
    names = ["path", "number", "cells", "refs", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4):
            for path, first, last, xml, dates in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "last", "xml", "dates"))):
                out: list[tuple] = []
                try:
                    out.extend((path, *row, None) for row in _sheet_part(xml, first, last, set(dates)))
                except Exception as e:
                    out.append((path, None, None, None, f"{type(e).__name__}: {e}"))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    return parts.mapInArrow(run, "path string, number bigint, cells array<string>, refs array<bigint>, error string")


def _parsed_texts(parts: DataFrame) -> DataFrame:
    """path, ref, text of the shared texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4):
            for path, first, xml in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "xml"))):
                texts = []
                for _, item in ElementTree.iterparse(io.BytesIO(xml)):
                    if item.tag == f"{W.SHEET}si":
                        texts.append(W._rich_text(item))
                        item.clear()
                refs = pa.array(range(first, first + len(texts)), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(texts), pa.string()), refs, pa.array(texts, pa.string())], names=["path", "ref", "text"])

    return parts.mapInArrow(run, "path string, ref bigint, text string")


def _with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows whose cells have their shared texts. Rows without any don't move."""
    has = F.exists("refs", lambda r: r.isNotNull())
    cells = rows.where(has).select("path", "number", F.posexplode("refs").alias("at", "ref")).where("ref is not null")
    met = lookup_join(cells, texts, ["path", "ref"], "inner", ["number"])
    own = met.groupBy("path", "number").agg(F.map_from_entries(F.collect_list(F.struct("at", "text"))).alias("_texts"))  # as wide as a row
    filled = rows.where(has).join(own, ["path", "number"], "left").withColumn(
        "cells", F.transform("cells", lambda c, i: F.coalesce(c, F.try_element_at("_texts", i)))
    )
    return filled.drop("refs", "_texts").unionByName(rows.where(~has).drop("refs"))


def decode_large_workbooks(files: DataFrame, columns: Sequence[str], missing_texts: bool = True, partitions: int | None = None, limit: int = PART_BYTES) -> DataFrame:
    """As `decode_workbooks`, with the parts of a workbook decoded by different tasks. Same rows, in any order.

    The parts are written once. Give `partitions` to spread the workbooks themselves.
    """
    columns = list(columns)
    books = files.select("path", "content")
    parts = staged(unpack(books.repartition(partitions) if partitions else books, limit), "parts")
    count, cores = parts.count(), parts.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(count, cores), -(-count // TOGETHER), 1)
    dealt = lambda kind: parts.where(F.col("kind") == kind).repartition(tasks)  # noqa: E731  a workbook's parts lie in one file
    parsed = staged(_parsed_sheets(dealt("sheet")), "sheets")
    texts = staged(_parsed_texts(dealt("texts")), "texts")
    rows = parsed.where("error is null")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, cells in zip(batch.column("path").to_pylist(), batch.column("cells").to_pylist()):
                header = W._header(cells or [])
                at = [header.index(c) if c in header else -1 for c in columns]
                fields = [path, at, [c for c in columns if c not in header], [c for c in header if c not in columns]]
                kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array([f], t) for f, t in zip(fields, kinds)], names=["path", "at", "absent", "extra"])

    first = _with_texts(rows.where("number = 1").select("path", "number", "cells", "refs"), texts)
    every = parts.where("kind = 'sheet'").select("path").distinct()
    header = every.join(first, "path", "left").select("path", "cells").mapInArrow(heads, "path string, at array<int>, absent array<string>, extra array<string>")
    filled = F.size("cells") > 0
    ends = rows.groupBy("path").agg(F.max(F.when(filled, F.col("number"))).alias("end"))
    header = staged(header.join(ends, "path", "left"), "headers")
    body = lookup_join(rows.where("number > 1"), header, "path", "inner", ["number"]).where("number <= end")
    pick = lambda c: F.transform("at", lambda i: F.when(i >= 0, F.get(F.col(c), i)))
    told = _with_texts(body.select("path", "number", "absent", "extra", pick("cells").alias("cells"), pick("refs").alias("refs")), texts)
    meta = T._parse_datatype_string("path string, row bigint, absent array<string>, extra array<string>, error string, cells array<string>")
    none = lambda name: F.lit(None).cast(meta[name].dataType).alias(name)
    out = told.select("path", (F.col("number") - 1).alias("row"), "absent", "extra", none("error"), "cells")
    out = out.unionByName(header.where("coalesce(end, 0) <= 1").select("path", none("row"), "absent", "extra", none("error"), none("cells")))
    faults = parsed.where("error is not null").select("path", "error").unionByName(
        parts.where("kind = 'error'").select("path", F.col("xml").cast("string").alias("error"))
    ).groupBy("path").agg(F.min("error").alias("error"))
    out = out.unionByName(faults.select("path", none("row"), none("absent"), none("extra"), "error", none("cells")))
    clean = na_to_null if missing_texts else (lambda c: c)
    file = F.regexp_extract("path", "([^/]*)$", 1).alias("file")
    return out.select("path", "row", "absent", "extra", "error", file, *[clean(F.get("cells", F.lit(i))).alias(c) for i, c in enumerate(columns)])
