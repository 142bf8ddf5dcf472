"""Workbook exports: every sheet row as a DataFrame row of texts."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toxloom.functions.cells import na_to_null, named

SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
BATCH = 5_000  # sheet rows per Arrow batch
WIDEST = 16_384  # columns of a sheet

# Built-in number formats that show a date or a time.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _parts(book: zipfile.ZipFile, texts: bool = True) -> tuple[str, list[str], set[int]]:
    """Path of the first sheet, shared texts (if asked for), and the style numbers that mean a date."""
    names = set(book.namelist())
    first = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{SHEET}sheets/{SHEET}sheet")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links if r.get("Id") == first.get(f"{RELATION}id"))
    sheet = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    shared: list[str] = []
    if texts and "xl/sharedStrings.xml" in names:
        for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{SHEET}si"):
            shared.append(_rich_text(item))
    dates: set[int] = set()
    if "xl/styles.xml" in names:
        styles = ElementTree.fromstring(book.read("xl/styles.xml"))
        own = {
            int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", ""))
            for f in styles.iter(f"{SHEET}numFmt")
        }
        for i, style in enumerate(styles.findall(f"{SHEET}cellXfs/{SHEET}xf")):
            code = int(style.get("numFmtId", 0))
            if re.search("[dmhysDMHYS]", own[code]) if code in own else code in DATE_FORMATS:
                dates.add(i)
    return sheet, shared, dates


def _rich_text(item: ElementTree.Element) -> str:
    """Plain text of a string item: its own text and that of its runs, without phonetic hints."""
    runs = [*item.findall(f"{SHEET}t"), *item.findall(f"{SHEET}r/{SHEET}t")]
    return "".join(t.text or "" for t in runs)


WHOLE = re.compile(r"[+-]?[0-9]+")


def _number(text: str, date: bool) -> str:
    if not date and WHOLE.fullmatch(text):
        return str(int(text))  # exact, however many digits
    value = float(text)
    if date:
        return str(datetime(1899, 12, 30) + timedelta(milliseconds=round(value * 86_400_000)))
    return str(int(value)) if value.is_integer() else repr(value)


def _cell(cell: ElementTree.Element, texts: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = cell.find(f"{SHEET}is")
        return None if inline is None else _rich_text(inline)
    value = cell.find(f"{SHEET}v")
    if value is None or value.text is None or kind == "e":  # an error is a missing value
        return None
    if kind == "s":
        return texts[int(value.text)]
    if kind == "b":
        return "True" if value.text == "1" else "False"
    if kind == "n":
        return _number(value.text, int(cell.get("s", -1)) in dates)
    return value.text


def _column(ref: str | None, default: int) -> int:
    n = 0
    for letter in ref or "":
        if letter.isdigit():
            break
        n = n * 26 + ord(letter) - ord("A") + 1
    return n - 1 if n else default


def _sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, streamed. Blank rows between data stay, blank rows at the end do not."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheet, texts, dates = _parts(book)
        with book.open(sheet) as xml:
            blank, expected = 0, 1
            for _, row in ElementTree.iterparse(xml):
                if row.tag != f"{SHEET}row":
                    continue
                number = int(row.get("r", expected))
                blank += number - expected
                expected = number + 1
                cells: list[str | None] = []
                for c in row.findall(f"{SHEET}c"):
                    at = _column(c.get("r"), len(cells))
                    cells.extend([None] * (at + 1 - len(cells)))
                    cells[at] = _cell(c, texts, dates)
                row.clear()
                if all(c is None for c in cells):
                    blank += 1
                    continue
                yield from ([] for _ in range(blank))
                blank = 0
                yield cells


def _header(cells: list[str | None]) -> list[str]:
    """Column names: blanks get a number, repeats a suffix."""
    names: list[str] = []
    for i, cell in enumerate(cells):
        name = cell if cell is not None else f"Unnamed: {i}"
        seen, n = name, 0
        while name in names:
            n += 1
            name = f"{seen}.{n}"
        names.append(name)
    return names


def _files(spark: SparkSession, folder: str, recursive: bool, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "content", "length")


def workbook_columns(files: DataFrame, most: int = WIDEST) -> list[str]:
    """Names of all columns, in order of first sight. Reads header rows only.

    More than `most` names are an error: a sheet can't be wider, so the files are no one table.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, at, names = [], [], []
            for i in range(batch.num_rows):  # one body at a time
                path = batch.column(0)[i].as_py()
                try:
                    header = _header(next(_sheet_rows(batch.column(1)[i].as_py()), []))
                except Exception:
                    continue
                paths.extend([path] * len(header))
                at.extend(range(len(header)))
                names.extend(header)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(at, pa.int32()), pa.array(names, pa.string())],
                names=["path", "at", "name"],
            )

    found = files.mapInArrow(parse, "path string, at int, name string")
    first = found.groupBy("name").agg(F.min(F.struct("at", "path")).alias("first")).orderBy("first", "name").limit(most + 1)
    names = [r.name for r in first.select("name").collect()]
    if len(names) > most:
        raise ValueError(f"the workbooks have more than {most} columns: name those that are wanted")
    return names


def decode_workbooks(
    files: DataFrame, columns: Sequence[str], missing_texts: bool = True, partitions: int | None = None
) -> DataFrame:
    """Rows of (path, content) workbooks with the given columns as text. Give `partitions` to spread few large tasks.

    `row` counts from 1 below the header. `absent` lists requested columns the file lacks, `extra` those it has
    beyond them. A file that cannot be read yields one row that has only `path` and `error`; one without rows below
    its header yields one row whose `row` and cells are null.
    """
    columns = list(columns)
    meta = ["path", "row", "absent", "extra", "error"]
    texts = T.ArrayType(T.StringType())
    schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("row", T.LongType()), T.StructField("absent", texts),
        T.StructField("extra", texts), T.StructField("error", T.StringType()),
        *[T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))],
    ])
    types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
    types += [pa.string()] * len(columns)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=schema.fieldNames()
        )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                path = batch.column(0)[i].as_py()
                n = 0
                try:
                    rows = _sheet_rows(batch.column(1)[i].as_py())
                    header = _header(next(rows, []))
                    at = [header.index(c) if c in header else -1 for c in columns]
                    absent = [c for c in columns if c not in header]
                    extra = [c for c in header if c not in columns]
                    for n, cells in enumerate(rows, 1):
                        wide = [cells[k] if 0 <= k < len(cells) else None for k in at]
                        out.append((path, n, absent, extra, None, *wide))
                        if len(out) >= BATCH:
                            yield batch_of(out)
                            out = []
                    if n == 0:  # the file's faults must still be seen
                        out.append((path, None, absent, extra, None, *[None] * len(columns)))
                except Exception as e:  # a broken file is data to reject, not a reason to stop
                    out.append((path, None, None, None, f"{type(e).__name__}: {e}", *[None] * len(columns)))
            if out:
                yield batch_of(out)

    clean = na_to_null if missing_texts else (lambda c: c)
    books = files.select("path", "content")
    rows = (books.repartition(partitions) if partitions else books).mapInArrow(parse, schema)
    file = F.regexp_extract("path", "([^/]*)$", 1).alias("file")
    return rows.select(*meta, file, *[clean(F.col(f"c{i}")).alias(c) for i, c in enumerate(columns)])


def read_workbooks(
    spark: SparkSession, folder: str, columns: Sequence[str] | None = None, recursive: bool = True,
    glob: str | None = None, missing_texts: bool = True, large: int | None = None,
) -> DataFrame:
    """First sheet of every workbook below `folder`, first row as header.

    Files of `large` bytes or more are decoded in parts, by many tasks each.

    Name the columns whenever they are known: cells of other columns are then never decoded into rows, and the
    extra pass over the headers is saved.
    """
    files = _files(spark, folder, recursive, glob)
    columns = columns if columns is not None else workbook_columns(files)
    if large is None:
        return decode_workbooks(files, columns, missing_texts)
    from toxloom.sources.large_workbooks import decode_large_workbooks

    size = F.col("length") >= large
    return decode_workbooks(files.where(~size), columns, missing_texts).unionByName(decode_large_workbooks(files.where(size), columns, missing_texts))


def failed_files(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("error").isNotNull()).select("path", "file", named("error"))
