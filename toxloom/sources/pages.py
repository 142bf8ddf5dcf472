"""Wiki pages: stored pages, page state, URL frontier and table rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toxloom.functions.cells import named
from toxloom.schemas import ABSENT_MARK
from toxloom.sources.batches import sliced
from toxloom.streaming.stored import read_stored

# Elements without content, and elements whose text is not page text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
    "nextid param source spacer track wbr".split()
)
UNREAD = frozenset("rp rt script style template".split())


def read_pages(spark: SparkSession, folder: str, kind: str = "*") -> DataFrame:
    """Pages stored as `<kind>/<id>/<id>.html`, or by `write_pages`: then its newest version."""
    stored = read_stored(spark, folder.rstrip("/"))
    if stored is not None:
        return (stored if kind == "*" else stored.where(F.col("kind") == kind)).select("kind", F.col("id").cast("bigint").alias("id"), "html")
    where = F.col("_metadata.file_path")
    pattern = r"([^/]+)/(\d+)/\2\.html$"
    return spark.read.text(f"{folder.rstrip('/')}/{kind}/*/*.html", wholetext=True).select(
        F.url_decode(F.regexp_extract(where, pattern, 1)).alias("kind"),
        F.regexp_extract(where, pattern, 2).try_cast("bigint").alias("id"),
        F.col("value").alias("html"),
    ).where(F.col("id").isNotNull())


def url_frontier(spark: SparkSession, base_url: str, kind: str, start: int, end: int, step: int = 20, walk: int = 100) -> DataFrame:
    """Each id that walks of `walk` ids from start, start+step, ... <= end reach, once and without a shuffle."""
    starts = spark.range(start, end + 1, step)
    if walk >= step:  # the walks run into each other: one range
        last = start + (end - start) // step * step if end >= start else start - walk
        ids = spark.range(start, last + walk)
    else:  # the walks are apart
        ids = starts.select(F.explode(F.sequence("id", F.col("id") + (walk - 1))).alias("id"))
    return ids.select(F.lit(kind).alias("kind"), "id", item_url(base_url.rstrip("/") + "/", F.col("id").cast("string")).alias("url"))


def frontier(starts: DataFrame, base_url: str, kind: str, walk: int = 100, start: str = "start") -> DataFrame:
    """As `url_frontier`, from a table of walk starts; ids that several walks reach appear once."""
    ids = starts.select(named(start).alias("_s")).where(F.col("_s").isNotNull()).select(
        F.explode(F.sequence(F.col("_s"), F.col("_s") + (walk - 1))).alias("id")
    )
    url = item_url(base_url.rstrip("/") + "/", F.col("id").cast("string"))
    return ids.dropDuplicates(["id"]).select(F.lit(kind).alias("kind"), "id", url.alias("url"))


def item_url(base_url: str, item: Column) -> Column:
    return F.concat(F.lit(base_url), item)


def page_state(pages: DataFrame, marker: str = ABSENT_MARK, html: str = "html", status: str = "status") -> DataFrame:
    """Pages with the reason they are not usable, null for live ones."""
    code = named(status) if status in pages.columns else F.lit(200)
    reason = (
        F.when(code.isNull() | (code != 200), F.concat(F.lit("status "), F.coalesce(code.cast("string"), F.lit("none"))))
        .when(F.coalesce(F.contains(named(html), F.lit(marker)), F.lit(False)), "absent")
    )
    return pages.withColumn("reason", reason)


def live_pages(pages: DataFrame, marker: str = ABSENT_MARK, html: str = "html", status: str = "status") -> DataFrame:
    return page_state(pages, marker, html, status).where(F.col("reason").isNull()).drop("reason")


@dataclass(slots=True)
class _Open:
    """An element not closed yet, with what it gathers."""

    tag: str
    text: list[str] | None = None
    row: list | None = None
    items: list | None = None


class _TableEnd(Exception):
    """The table is complete; the rest of the page need not be read."""


class _FirstTable(HTMLParser):
    """Rows of the first table: per cell its text pieces and those of every list item in it.

    End tags close the nearest open element of their name and all above it. Nothing else closes an element, so an
    unclosed cell or item takes in what follows, nested rows and cells count for every row around them, and nested
    items for every cell around them.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.rows: list[list[_Open]] = []
        self.table: _Open | None = None
        self.piece: list[str] = []

    def end_piece(self, *_: str) -> None:
        if not self.piece:
            return
        text = "".join(self.piece).strip()
        self.piece.clear()
        if text and not any(e.tag in UNREAD for e in self.open):
            for e in self.open:
                if e.text is not None:
                    e.text.append(text)

    handle_comment = handle_decl = handle_pi = end_piece

    def unknown_decl(self, data: str) -> None:
        self.end_piece()
        if data.startswith("CDATA["):
            self.piece.append(data[len("CDATA["):])
            self.end_piece()

    def handle_data(self, data: str) -> None:
        if self.table is not None:
            self.piece.append(data)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.end_piece()
        if tag in VOID:
            return
        new = _Open(tag)
        if self.table is None:
            if tag == "table":
                self.table = new
        elif tag == "tr":
            new.row = []
            self.rows.append(new.row)
        elif tag in ("td", "th"):
            new.text, new.items = [], []
            for e in self.open:
                if e.row is not None:
                    e.row.append(new)
        elif tag == "li":
            new.text = []
            for e in self.open:
                if e.items is not None:
                    e.items.append(new.text)
        self.open.append(new)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.end_piece()
        if tag in VOID or not any(e.tag == tag for e in self.open):
            return
        while True:
            last = self.open.pop()
            if last is self.table:
                raise _TableEnd
            if last.tag == tag:
                return


def _table_rows(html: str | None) -> list[tuple[list[str], list[list[str]]]]:
    parser = _FirstTable()
    try:
        parser.feed(html or "")
        parser.close()
        parser.end_piece()
    except _TableEnd:
        pass
    return [
        (["".join(c.text) for c in row], [["".join(i) for i in c.items] for c in row]) for row in parser.rows
    ]


def html_table_rows(pages: DataFrame, keys: Sequence[str], html: str = "html", partitions: int | None = None) -> DataFrame:
    """Rows of the first table of each page: position, the page's header texts, cell texts and list items per cell.

    The header row is row 0. Pages are parsed where they lie, some MB of an Arrow batch at a time, as the pieces of a page take many times its size.
    Parsing costs far more than moving a page, so give `partitions` where the pages lie in few files.
    """
    fields = pages.select(*map(named, keys)).schema.fields
    schema = T.StructType([
        *fields,
        T.StructField("pos", T.IntegerType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("lis", T.ArrayType(T.ArrayType(T.StringType()))),
    ])
    width = len(fields)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.list_(pa.string())
        types = [pa.int32(), strings, strings, pa.list_(strings)]
        for batch in sliced(batches, width):
            page, rows = [], []
            for i, text in enumerate(batch.column(width).to_pylist()):
                found = _table_rows(text)
                page.extend([i] * len(found))
                rows.extend((p, found[0][0], cells, lis) for p, (cells, lis) in enumerate(found))
            at = pa.array(page, pa.int64())
            arrays = [batch.column(k).take(at) for k in range(width)]
            columns = list(zip(*rows)) or [(), (), (), ()]
            arrays += [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    rows = pages.select(*map(named, keys), named(html))
    return (rows.repartition(partitions) if partitions else rows).mapInArrow(parse, schema)


def table_columns(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Body rows as named columns, found by each page's own header; a column the page lacks is null."""
    cell = {n: F.array_position("header", n).cast("int") for n in names}
    return rows.where(F.col("pos") > 0).select(
        *map(named, keys), *[F.when(at > 0, F.get("cells", at - 1)).alias(n) for n, at in cell.items()]
    )
