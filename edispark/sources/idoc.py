"""Spark source and sink for IDoc files.

``spark.read.format("idoc")`` takes a path, a folder or a glob and gives the rows of its ``kind`` (see ``kinds``;
records as bytes by default): a task for each file or part of a large one, holding one chunk at a time.
Paths are local or in a store that Arrow opens (``stores``). ``raw_scan`` resolves paths by Spark's own file
systems, finds the parts of large files by parallel tasks, and reads other stores through ``binaryFile``.

``df.write.format("idoc")`` takes one binary or string column. Tasks write parts; the commit puts them into one
file in the order of the partitions (``layout=single``, after a global ``orderBy``), streaming a block at a
time, or leaves them as a folder of files (``layout=parts``), which suits large outputs. What was there before
is set aside until the new output is in place.
"""

from __future__ import annotations

import fnmatch
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice, repeat

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from edispark.functions.layout import CONTROL_LEN, DATA_LEN, framing_of, is_control
from edispark.shipping import ship, shuffles_removed
from edispark.sources import xml
from edispark.sources.framing import FramingError, counted, cuts, detect, line_start, looks_like_xml, records
from edispark.sources.kinds import RAW as SCHEMA
from edispark.sources.kinds import Kind, struct_of
from edispark.sources.stores import CODECS, codec_of, local, opened, scheme_of, streams

CHUNK, ROWS = 1 << 18, 2048
#: A task of the sink begins another file at the first document after so many bytes, in a folder of files.
ROLL = 128 << 20
#: Files over so many bytes are read in parts of about that size, smaller where there are cores to spare.
SPLIT, LEAST_PART = 128 << 20, 8 << 20
#: A file of another store is one row in Spark up to so many bytes; larger ones are opened by the tasks.
WHOLE = 512 << 20
ENDS = {"fixed": b"", "lf": b"\n", "crlf": b"\r\n"}
_RAW_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())
_RAW_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _batches(rows: Iterator[tuple], types=_RAW_TYPES, names=_RAW_NAMES) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], list(names))


def file_records(chunks: Iterator[bytes], name: str, framing: str, lenient: bool, xml_control: bool) -> Iterator[tuple[int, int, str, bytes]]:
    """A file's records; of IDoc-XML its control records, where these are asked for."""
    head = next(chunks, b"")

    def all_chunks() -> Iterator[bytes]:
        yield head
        yield from chunks

    if looks_like_xml(head):
        if not xml_control:
            raise ValueError(f"{name} is IDoc-XML: use read_xml or xml_to_records")
        for k, doc in enumerate(xml.documents(all_chunks())):
            yield k + 1, k, "C", xml.control_bytes(doc.control)
        return
    yield from records(all_chunks(), framing, lenient)


def _chunks(path: str, start: int = 0, stop: int | None = None) -> Iterator[bytes]:
    store, own = opened(path)
    codec = codec_of(path)
    with store.open_input_stream(own, compression=codec, buffer_size=CHUNK) if codec else store.open_input_file(own) as f:
        if start:
            f.seek(start)
        left = None if stop is None else stop - start
        while (left is None or left > 0) and (block := f.read(CHUNK if left is None else min(CHUNK, left))):
            left = left if left is None else left - len(block)
            yield block


def _pieces(content: pa.Scalar, codec: str | None = None) -> Iterator[bytes]:
    """A file that came as one value, in chunks."""
    raw = content.as_buffer()
    if codec:
        return iter(partial(pa.CompressedInputStream(pa.BufferReader(raw), codec).read, CHUNK), b"")
    return (raw.slice(a, min(CHUNK, raw.size - a)).to_pybytes() for a in range(0, raw.size, CHUNK))


@dataclass
class _File(InputPartition):
    """A file, or the part of one from ``start`` to ``stop`` with what comes before it."""

    path: str
    framing: str
    start: int = 0
    stop: int | None = None
    documents: int = 0
    records: int = 0


def _job(spark: SparkSession, what: list, one) -> list:
    """``one`` of each item, by a task each."""

    def over(batches):
        for batch in batches:
            for item in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([item]), pa.array([json.dumps(one(json.loads(item)))])], ["item", "found"])

    rows = spark.createDataFrame([(json.dumps(x),) for x in what], "item string").repartition(len(what)).mapInArrow(over, "item string, found string").collect()
    found = {r["item"]: json.loads(r["found"]) for r in rows}
    return [found[json.dumps(x)] for x in what]


def large_files(spark: SparkSession, sizes: dict[str, int], framing: str, lenient: bool) -> dict[str, list]:
    """(framing, parts) of the large ones among files of the given sizes.

    Files without line ends are walked by the heads of their records, a task for each file; files with line
    ends are cut at line starts and their parts counted, a task for each part.
    """
    every = {f: max(LEAST_PART, min(SPLIT, -(-n // spark.sparkContext.defaultParallelism))) for f, n in sizes.items()}
    large = sorted(f for f, n in sizes.items() if (n > 2 * every[f] or n > SPLIT) and not codec_of(f))
    if not large:
        return {}

    def heads(item):
        path, size, step = item
        store, own = opened(path)
        with store.open_input_file(own) as f:
            head = f.read(CONTROL_LEN + 2)
            kind = detect(head) if framing == "auto" else framing
            if looks_like_xml(head):
                return kind, None
            if kind == "fixed":
                return kind, cuts(f, size, step)
            starts = sorted({line_start(f, at, size) for at in range(0, size, step)} - {size})
            return kind, list(zip(starts, [*starts[1:], size], strict=True))

    def count(item):
        path, kind, start, stop = item
        try:
            return counted(_chunks(path, start, stop), kind, lenient)
        except FramingError:
            return None

    out = dict(zip(large, _job(spark, [[f, sizes[f], every[f]] for f in large], heads), strict=True))
    out = {f: x for f, x in out.items() if x[1]}
    lines = [[f, kind, a, b] for f, (kind, parts) in out.items() if kind != "fixed" for a, b in parts]
    if lines:
        found = _job(spark, lines, count)
        for f in {x[0] for x in lines}:
            parts, documents, number = [], 0, 0
            for (_, _, a, b), got in ((x, y) for x, y in zip(lines, found, strict=True) if x[0] == f):
                if got is None:
                    # a malformed record: the file is read as a whole and says which
                    parts = None
                    break
                parts.append((a, b, documents, number))
                documents, number = documents + got[0], number + got[1]
                if not got[2]:
                    # a lenient scan ends in this part, so it does not see the others
                    break
            out[f] = (out[f][0], parts)
    return {f: list(x) for f, x in out.items() if x[1]}


def _braces(pattern: str) -> list[str]:
    """A glob's alternatives in braces, as patterns without them."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    return [pattern] if not found else [y for x in found[1].split(",") for y in _braces(pattern[: found.start()] + x + pattern[found.end() :])]


def listed(path: str) -> list[str]:
    """The files of a path, a folder or a glob, sorted."""
    out = []
    for one in _braces(path):
        store, own = opened(one)
        prefix = one[: len(one) - len(own)]
        if not re.search(r"[*?\[]", own):
            info = store.get_file_info(own)
            if info.type == arrow_fs.FileType.NotFound:
                raise FileNotFoundError(f"cannot open '{one}': no such file")
            found = [info] if info.is_file else store.get_file_info(arrow_fs.FileSelector(own))
        else:
            # every level of the pattern is listed by itself
            fixed, *levels = re.split(r"/(?=[^/]*[*?\[])", own)
            tops = [fixed or "/"]
            for k, level in enumerate(levels):
                name, *rest = level.split("/")
                inner = [x for t in tops for x in store.get_file_info(arrow_fs.FileSelector(t, allow_not_found=True)) if fnmatch.fnmatchcase(x.base_name, name)]
                tops = ["/".join([x.path, *rest]) for x in inner]
            found = [x for t in tops for x in store.get_file_info([t]) if x.type != arrow_fs.FileType.NotFound]
            found = [y for x in found for y in ([x] if x.is_file else store.get_file_info(arrow_fs.FileSelector(x.path)))]
        out += [prefix + x.path for x in found if x.is_file and not x.base_name.startswith(("_", "."))]
    if not out:
        if re.search(r"[*?\[{]", path):
            raise FileNotFoundError(f"no files match the pattern '{path}'")
        return []
    return sorted(out)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.kind = Kind(options)
        self.given = [x for x in options.get("files", "").split("\n") if x]
        self.paths = options.get("path", "").split("\n")
        self.framing = framing_of(options.get("framing"))
        self.lenient = options.get("lenient", "false").lower() == "true"
        self.xml_control = options.get("xml", "") == "control" or self.kind.name == "control"
        self.parts = json.loads(options.get("parts", "{}"))
        arrow = to_arrow_schema(struct_of(self.kind.schema()))
        self.names, self.types = arrow.names, arrow.types

    def partitions(self):
        out = []
        for p in self.given or sorted(f for path in self.paths if path for f in listed(path)):
            kind, parts = self.parts.get(p) or self._walked(p)
            out += [_File(p, kind, *x) for x in parts] if parts else [_File(p, self.framing)]
        return out

    def _walked(self, path):
        """Parts of a large file without line ends; files that ``raw_scan`` has looked at are not looked at again."""
        if self.given or self.kind.name in ("xml", "records") or codec_of(path):
            return self.framing, None
        store, own = opened(path)
        size = store.get_file_info(own).size
        if size <= SPLIT:
            return self.framing, None
        with store.open_input_file(own) as f:
            head = f.read(CONTROL_LEN + 2)
            kind = detect(head) if self.framing == "auto" else self.framing
            return kind, cuts(f, size, SPLIT) if kind == "fixed" and not looks_like_xml(head) else None

    def read(self, partition):
        p, name = partition, local(partition.path)
        if self.kind.name in ("xml", "records"):
            rows = self.kind.xml_rows(_chunks(p.path), name)
        elif p.stop is None:
            rows = self.kind.rows(file_records(_chunks(p.path), name, p.framing, self.lenient, self.xml_control), name)
        else:
            rows = self.kind.rows(records(_chunks(p.path, p.start, p.stop), p.framing, self.lenient, p.documents, p.records), name)
        yield from _batches(rows, self.types, self.names)


@dataclass
class _Part(WriterCommitMessage):
    number: int
    files: list[tuple[str, int]]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite):
        if len(schema.fields) != 1 or schema.fields[0].dataType.typeName() not in ("binary", "string"):
            raise ValueError("the idoc sink takes exactly one binary or string column")
        known = {"path", "framing", "validate", "layout", "compression", "extension", "roll"}
        if unknown := set(options) - known:
            raise ValueError(f"unknown option for the idoc sink: {', '.join(sorted(unknown))}")
        self.uri = options["path"].rstrip("/")
        store, self.path = opened(self.uri)
        self.end = ENDS[framing_of(options.get("framing", "fixed"))]
        self.validate = str(options.get("validate", "true")).lower() in ("true", "")
        self.single = options.get("layout", "single") == "single"
        self.roll = int(options.get("roll", ROLL))
        self.codec = options.get("compression") or None
        if self.codec not in (None, *CODECS.values()):
            raise ValueError(f"unknown compression '{self.codec}': use {', '.join(CODECS.values())}")
        if self.codec and self.single:
            raise ValueError("compression needs layout 'parts'")
        self.ending = f".{options.get('extension', 'idoc')}" + next((e for e, c in CODECS.items() if c == self.codec), "")
        self.parts = f"{self.path}._parts-{uuid.uuid4().hex}"
        if not overwrite and store.get_file_info(self.path).type != arrow_fs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists")

    def write(self, iterator):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        store, _ = opened(self.uri)
        store.create_dir(self.parts, recursive=True)
        # attempts of one task write files of their own; only the committed one is used
        own = f"{self.parts}/{number:06d}-{uuid.uuid4().hex}"
        files: list[tuple[str, int]] = []
        size, f = 0, None
        try:
            for batch in iterator:
                rows = [r.encode() if isinstance(r, str) else r for r in batch.column(0).to_pylist() if r is not None]
                if self.validate and (odd := next((r for r in rows if len(r) not in (CONTROL_LEN, DATA_LEN)), None)) is not None:
                    raise ValueError(f"record is {len(odd)} bytes; expected {CONTROL_LEN} (control) or {DATA_LEN} (data)")
                # a long part goes on in another file where a document begins
                cut = next((k for k, r in enumerate(rows) if is_control(r)), None) if size > self.roll and not self.single else None
                for piece, goes_on in ((rows, True),) if cut is None else ((rows[:cut], True), (rows[cut:], False)):
                    if f is not None and not goes_on:
                        f.close()
                        files.append((path, size))
                        size, f = 0, None
                    if f is None:
                        path = f"{own}-{len(files):06d}{self.ending}"
                        f = store.open_output_stream(path, compression=self.codec, buffer_size=1 << 20)
                    if piece:
                        text = self.end.join(piece) + self.end
                        f.write(text)
                        size += len(text)
        finally:
            if f is not None:
                f.close()
        return _Part(number, [*files, (path, size)] if f is not None else files)

    def commit(self, messages):
        store, _ = opened(self.uri)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        new, old = (f"{self.path}._{x}-{uuid.uuid4().hex}" for x in ("new", "old"))
        if self.single:
            with store.open_output_stream(new, compression=None, buffer_size=1 << 20) as out:
                for path in (path for p in parts for path, _ in p.files):
                    with store.open_input_stream(path, compression=None) as f:
                        while block := f.read(1 << 20):
                            out.write(block)
        else:
            store.create_dir(new)
            for p in parts:
                for k, (path, size) in enumerate(p.files):
                    if size:
                        store.move(path, f"{new}/part-{p.number:06d}{f'-{k:06d}' if k else ''}{self.ending}")
        before = store.get_file_info(self.path).type
        if before != arrow_fs.FileType.NotFound:
            _moved(store, self.path, old)
        _moved(store, new, self.path)
        if before != arrow_fs.FileType.NotFound:
            _removed(store, old)
        _removed(store, self.parts)

    def abort(self, messages):
        _removed(opened(self.uri)[0], self.parts)


def _moved(store: arrow_fs.FileSystem, one: str, two: str) -> None:
    """Rename; where a store cannot rename folders, file by file."""
    try:
        store.move(one, two)
    except (OSError, NotImplementedError):
        if store.get_file_info(one).type != arrow_fs.FileType.Directory:
            raise
        store.create_dir(two)
        for f in store.get_file_info(arrow_fs.FileSelector(one)):
            store.move(f.path, f"{two}/{f.base_name}")
        store.delete_dir(one)


def _removed(store: arrow_fs.FileSystem, path: str) -> None:
    kind = store.get_file_info(path).type
    if kind == arrow_fs.FileType.Directory:
        store.delete_dir(path)
    elif kind == arrow_fs.FileType.File:
        store.delete_file(path)


class IdocSource(DataSource):
    @classmethod
    def name(cls):
        return "idoc"

    def schema(self):
        return Kind(self.options).schema()

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(IdocSource)


def sized_files(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int]]:
    """Files of paths, folders and globs with their sizes, by Spark's file systems, sorted, with repeated ones kept."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        found = fs.globStatus(path)
        if not found:
            glob = bool(re.search(r"[*?\[{]", p))
            raise FileNotFoundError(f"no files match the pattern '{p}'" if glob else f"cannot open '{p}': no such file")
        for status in found:
            inner = [x for x in fs.listStatus(status.getPath()) if x.isFile() and not x.getPath().getName().startswith(("_", "."))] if status.isDirectory() else [status]
            out += [(x.getPath().toString(), x.getLen()) for x in inner]
    return sorted(out)


def files_of(spark: SparkSession, paths: str | list[str]) -> list[str]:
    return [f for f, _ in sized_files(spark, paths)]


def raw_scan(spark: SparkSession, paths: str | list[str], framing: str | None = None, lenient: bool | None = False, xml_control: bool = False, only: str = "", segnam: str | None = None) -> DataFrame:
    """``document_key, record_index, record_type, raw_record, filename`` of all files.

    ``only`` ('C' or 'D') and ``segnam`` leave out other records where they are cut; numbers count all.
    """
    framing_name, lenient = framing_of(framing), bool(lenient)
    sized = sized_files(spark, paths)
    files = [f for f, _ in sized]
    options = {"only": only} | ({"segnam": segnam} if segnam else {})
    if all(scheme_of(f) == "file" or (streams(f) and n > WHOLE) for f, n in sized):
        register(spark)
        parts = large_files(spark, dict(sized), framing_name, lenient)
        options |= {"files": "\n".join(files), "lenient": str(lenient).lower(), "parts": json.dumps(parts)} | ({"framing": framing} if framing else {}) | ({"xml": "control"} if xml_control else {})
        return spark.read.format("idoc").options(**options).load()
    if large := [f for f, n in sized if n > WHOLE]:
        raise ValueError(f"{large[0]} is over {WHOLE >> 20} MB and in a store that tasks cannot open in parts, or beside files that they cannot: read it by itself or copy it")
    ship(spark)
    kind = Kind(options)
    return spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(cut_files(kind, framing_name, lenient, xml_control), SCHEMA)


def cut_files(kind: Kind, framing: str, lenient: bool, xml_control: bool):
    """For ``mapInArrow``: the records of files that come whole as (path, content), or as paths alone that the task opens."""

    def cut(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1) if batch.num_columns > 1 else repeat(None)):
                name = local(path)
                chunks = _chunks(path) if content is None else _pieces(content, codec_of(path))
                yield from _batches(kind.rows(file_records(chunks, name, framing, lenient, xml_control), name))

    return cut


def write_idoc(df: DataFrame, path: str, framing: str = "fixed", validate: bool = True, single: bool = True, compression: str | None = None, extension: str = "idoc") -> None:
    """Write the only column of ``df``; order it first if the order matters.

    ``single`` copies all parts through one process into one file: right for files that are handed on;
    a large output is better left as a folder of parts, which ``compression`` (gzip, zstd) makes small, as records are mostly blanks.
    """
    opened(path)  # a store that tasks cannot write to is refused before any work
    register(df.sparkSession)
    writer = df.write.format("idoc").mode("overwrite").option("framing", framing).option("validate", str(validate).lower())
    writer = writer.option("extension", extension).option("compression", compression or "")
    with shuffles_removed(df.sparkSession):
        writer.option("layout", "single" if single else "parts").save(path)


XML_SCHEMA = (
    "filename string, document_key long, first_index long, seq long, segnam string, hlevel int, psgnum long, docnum string, mandt string, "
    "fields array<struct<n:string,v:string,u:string>>"
)


def xml_segments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row for each control record (seq 0) and segment of IDoc-XML files, with its fields in order.

    A file is parsed once by one task, a document at a time, so its rows also carry what spans a document: the parent's
    number, the control record's DOCNUM and MANDT, and the file's records before the document. Tasks open
    the files themselves where they can; files of other stores come as values.
    """
    ship(spark)
    pair = pa.list_(pa.struct([("n", pa.string()), ("v", pa.string()), ("u", pa.string())]))
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pair)

    def cut(fields: list[tuple[str, str]]) -> list[dict]:
        return [{"n": n, "v": v.rstrip(" "), "u": n.upper()} for n, v in fields]

    def rows_of(path: str, chunks: Iterator[bytes]) -> Iterator[tuple]:
        first = 0
        for k, doc in enumerate(xml.documents(chunks), 1):
            head = (local(path), k, first)
            tail = (xml.lookup(doc.control, "DOCNUM"), xml.lookup(doc.control, "MANDT"))
            yield (*head, 0, "EDI_DC40", 0, 0, *tail, cut(doc.control))
            latest: dict[int, int] = {}
            for seq, s in enumerate(doc.segments, 1):
                latest[s.level] = seq
                parent = latest.get(s.level - 1, 0) if s.level > 1 else 0
                yield (*head, seq, s.name, s.level, parent, *tail, cut(s.fields))
            first += 1 + len(doc.segments)

    def over(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1) if batch.num_columns > 1 else repeat(None)):
                rows = rows_of(path, _chunks(path) if content is None else _pieces(content, codec_of(path)))
                while part := list(islice(rows, ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], [x.split()[0] for x in XML_SCHEMA.split(", ")])

    files = files_of(spark, paths)
    if all(streams(f) for f in files):
        # a task for each file
        return spark.createDataFrame(spark.sparkContext.parallelize([(f,) for f in files], len(files) or 1), "path string").mapInArrow(over, XML_SCHEMA)
    return spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(over, XML_SCHEMA)
