"""Data sources over folders of files: the store of fetched pages (read and written) and files that are parsed to cells.

    spark.dataSource.register(StoredPages)            # register(spark) does it for all of this module
    spark.read.format("stored_pages").load(root)      # host, url, content_type, status, length, content
    pages.write.format("stored_pages").save(root)
    spark.read.format("cell_files").option("kind", "workbook").load(root)   # file, ordinal, cells

A page is two files, `<host>/<SHA-1 of its address>.body` and `.meta.json`. A host's folder is read in `splits` pieces, which
take its pages by the first digit of that hash, so that a host with a large share of all pages is not one task; all pieces
are dealt out to at most `tasks` tasks. Filters on
host, length and content type are pushed down: folders of other hosts are not listed, bodies of the wrong size or type not
opened (the length is in the listing, the type in the small metadata file). Files are reached through pyarrow's file
systems, which every worker opens by the path's scheme.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, LessThanOrEqual, StringContains, WriterCommitMessage

from tidemark.functions.pages import MOST_PAGE_BYTES, designations_of_bodies, telling_bytes
from tidemark.session import ship
from tidemark.sources.tables import cp932_cells, list_cells, sheet_cells

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
PAGES = "host string, url string, content_type string, status int, length long, content binary"
#: Rows of an Arrow batch end at about so many bytes of content.
BATCH_BYTES = 8 << 20
#: Pieces of a host's folder, each the pages whose hash begins with some of the sixteen digits, and tasks of a scan.
SPLITS, TASKS = 4, 1_000
DIGITS = "0123456789abcdef"


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def _children(where: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    return where.get_file_info(fs.FileSelector(folder, allow_not_found=True))


@dataclass
class Pieces(InputPartition):
    """(host, digits): pages of a host whose hash begins with one of the digits."""

    folders: list[tuple[str, str]]


class StoredPages(DataSource):
    """The store of fetched pages. Options: path, splits, tasks."""

    @classmethod
    def name(cls) -> str:
        return "stored_pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options["path"], int(self.options.get("splits", SPLITS)), int(self.options.get("tasks", TASKS)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a store of pages is added to, page by page; use mode append")
        return PageWriter(self.options["path"])


class PageReader(DataSourceReader):
    """Reads pages folder by folder; filters narrow what is listed and opened."""

    def __init__(self, root: str, splits: int, tasks: int):
        self.root, self.splits, self.tasks = root, min(max(splits, 1), len(DIGITS)), max(tasks, 1)
        self.hosts: set[str] | None = None
        self.most: int | None = None
        self.kinds: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes filters on host, length and content type; gives back the others."""
        for f in filters:
            column, value = f.attribute if hasattr(f, "attribute") else None, getattr(f, "value", None)
            if isinstance(f, EqualTo | In) and column == ("host",):
                named = {value} if isinstance(f, EqualTo) else set(value)
                self.hosts = named if self.hosts is None else self.hosts & named
            elif isinstance(f, LessThanOrEqual) and column == ("length",):
                self.most = value if self.most is None else min(self.most, value)
            elif isinstance(f, StringContains) and column == ("content_type",):
                self.kinds.append(value)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        where, root = _opened(self.root)
        every = sorted(i.base_name for i in _children(where, root) if i.type == fs.FileType.Directory)
        per = -(-len(DIGITS) // self.splits)
        cuts = [DIGITS[i : i + per] for i in range(0, len(DIGITS), per)]
        pieces = [(h, c) for c in cuts for h in every if self.hosts is None or h in self.hosts]
        return [Pieces(pieces[i :: self.tasks]) for i in range(min(self.tasks, len(pieces)))] or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        where, root = _opened(self.root)
        rows, held = [], 0
        for host, digits in partition.folders:
            for info in sorted(_children(where, f"{root}/{host}"), key=lambda i: i.base_name):
                row = self._page(where, host, digits, info)
                if row is None:
                    continue
                rows.append(row)
                held += info.size
                if held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    def _page(self, where: fs.FileSystem, host: str, digits: str, info: fs.FileInfo) -> tuple | None:
        """The page of a body's file, if filters let it be opened."""
        name = info.base_name
        if not name.endswith(".body") or name[:1] not in digits or (self.most is not None and info.size > self.most):
            return None
        with where.open_input_file(info.path.removesuffix(".body") + ".meta.json") as f:
            meta = json.loads(f.read())
        kind = meta.get("content_type") or ""
        if not all(k in kind for k in self.kinds):
            return None
        with where.open_input_file(info.path) as f:
            return host, meta.get("url"), kind, meta.get("status"), info.size, f.read()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["host", "url", "content_type", "status", "length", "content"])


@dataclass
class Written(WriterCommitMessage):
    """How many pages a task wrote."""

    pages: int


class PageWriter(DataSourceArrowWriter):
    """Adds pages to a store: (host, url, content_type, status, content), further columns ignored.

    A task writes each file under a temporary name and then gives it its own, metadata last: a page is there with both
    files or not at all. Names follow from addresses, so a task that is tried again writes the same files again; a write
    that fails leaves whole pages, and one that is repeated replaces them. Nothing but counts goes to the driver. A page
    that is stored already is replaced. Pages without host or address are refused.
    """

    def __init__(self, root: str):
        self.root = root

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        where, root = _opened(self.root)
        written, known = 0, set()
        for batch in batches:
            for r in batch.select(["host", "url", "content_type", "status", "content"]).to_pylist():
                if not r["host"] or not r["url"] or "/" in r["host"]:
                    raise ValueError(f"a page needs a host and an address: {r['host']!r}, {r['url']!r}")
                folder = f"{root}/{r['host']}"
                if folder not in known:
                    where.create_dir(folder)
                    known.add(folder)
                name = f"{folder}/{hashlib.sha1(r['url'].encode()).hexdigest()}"
                meta = json.dumps({k: r[k] for k in ("url", "content_type", "status")}, ensure_ascii=False).encode()
                for ending, data in ((".body", r["content"] or b""), (".meta.json", meta)):
                    draft = f"{folder}/_{uuid.uuid4().hex}.tmp"
                    with where.open_output_stream(draft) as f:
                        f.write(data)
                    where.move(draft, name + ending)
                written += 1
        return Written(written)


PARSERS = {"workbook": sheet_cells, "cp932": cp932_cells, "html_list": lambda b: list_cells(b.decode("utf-8", "replace"))}


#: Files of a task end at about so many bytes or so many files, whichever comes first.
TASK_BYTES, TASK_FILES = 32 << 20, 1_000


@dataclass
class Files(InputPartition):
    """Names of files in the source's folder, or none of the file that the source is."""

    names: list[str]


class CellFiles(DataSource):
    """(file, ordinal, cells) of files that Spark has no reader for: a task takes as many as TASK_BYTES and TASK_FILES allow. Options: path (a folder or a file), kind (of PARSERS), ending (of the names that count)."""

    @classmethod
    def name(cls) -> str:
        return "cell_files"

    def schema(self) -> str:
        return "file string, ordinal int, cells array<string>"

    def reader(self, schema) -> DataSourceReader:
        if self.options.get("kind") not in PARSERS:
            raise ValueError(f"kind must be one of {', '.join(PARSERS)}")
        return CellReader(self.options["path"], self.options["kind"], self.options.get("ending", ""))


class CellReader(DataSourceReader):
    """A filter on the file's name is pushed down: other files are not opened."""

    def __init__(self, root: str, kind: str, ending: str = ""):
        self.root, self.kind, self.ending = root, kind, ending
        self.files: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("file",):
                named = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.files = named if self.files is None else self.files & named
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        where, root = _opened(self.root)
        one = where.get_file_info(root)
        found = [one] if one.type == fs.FileType.File else [i for i in _children(where, root) if i.type == fs.FileType.File and i.base_name[0] not in "._" and i.base_name.endswith(self.ending)]
        pieces, size = [Files([])], 0
        for i in sorted(found, key=lambda i: i.path):
            if self.files is not None and i.base_name not in self.files:
                continue
            if pieces[-1].names and (size + i.size > TASK_BYTES or len(pieces[-1].names) >= TASK_FILES):
                pieces.append(Files([]))
                size = 0
            pieces[-1].names.append("" if i is one else i.base_name)
            size += i.size
        return pieces

    def read(self, partition: Files) -> Iterator[tuple]:
        where, root = _opened(self.root)
        for name in partition.names:
            with where.open_input_file(f"{root}/{name}" if name else root) as f:
                content = f.read()
            for i, cells in enumerate(PARSERS[self.kind](content)):
                yield name or root.rsplit("/", 1)[-1], i, cells


def register(spark: SparkSession) -> None:
    """Makes the formats of this module known to the session and lets it push filters into them."""
    ship(spark)
    spark.conf.set(PUSHDOWN, "true")
    for source in (StoredPages, CellFiles):
        spark.dataSource.register(source)


def cached_pages(spark: SparkSession, root: str, hosts: DataFrame, most_bytes: int = MOST_PAGE_BYTES, only: list[str] | None = None, tasks: int = TASKS) -> DataFrame:
    """Stored HTML pages of at most most_bytes whose host is in `hosts` (host, ...), with its columns. only: hosts whose folders alone are read."""
    register(spark)
    pages = spark.read.format("stored_pages").option("tasks", tasks).load(root).filter((F.col("length") <= most_bytes) & F.contains("content_type", F.lit("html")))
    return (pages if only is None else pages.filter(F.col("host").isin(*only))).join(hosts, "host")


def stored_designations(spark: SparkSession, root: str, hosts: DataFrame, only: list[str] | None = None, tasks: int = TASKS) -> DataFrame:
    """(host, url, ord, designation, kind, name, ...) of the store's pages, in one scan: pushed filters, bytes that tell, decoding, four strategies.

    hosts: (host, ...), its columns stay. Pages without a telling word in either encoding never reach Python.
    """
    pages = cached_pages(spark, root, hosts, only=only, tasks=tasks).filter(telling_bytes(F.col("content")))
    return designations_of_bodies(pages, [c for c in pages.columns if c not in ("content", "content_type", "length", "status")], "content", "content_type")
