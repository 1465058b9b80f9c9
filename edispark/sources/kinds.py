"""Rows of the ``idoc`` format by its ``kind`` option: how SQL views reach each reader without the DataFrame functions.

``raw`` (default) gives records as bytes; ``data``, ``control``, ``segment`` (options ``segnam`` and ``dict``),
``fields`` (``dict``, ``include_unknown``), ``xml`` and ``records`` (``dict``) give the columns of the
readers of the same names, with ``filename`` last. ``dict`` is a csv, parquet or json file of a dictionary,
or a folder of them. Records that a kind does not show are dropped where they are cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyarrow import fs as arrow_fs
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from edispark.functions.layout import CONTROL_FIELDS, CONTROL_LEN, DATA_FIELDS, DATA_LEN, LATIN_1, SDATA_LEN, placed
from edispark.sources import xml
from edispark.sources.stores import opened

Record = tuple[int, int, str, bytes]
RAW = "document_key long, record_index long, record_type string, raw_record binary, filename string"
_AT = {n: (o, o + k) for n, o, k in placed(DATA_FIELDS)}
_HEADS = ("DOCNUM", "SEGNUM", "SEGNAM", "PSGNUM", "HLEVEL", "MANDT")


def struct_of(columns: str) -> StructType:
    """The type of ``name type, ...``, made without a session, as the planner's workers have none."""
    kinds = {"long": LongType(), "int": IntegerType(), "string": StringType(), "binary": BinaryType()}
    pairs = [c.rsplit(" ", 1) for c in columns.split(", ")]
    return StructType([StructField(n.strip("`"), kinds[k]) for n, k in pairs])


def dictionary_rows(path: str) -> list[dict]:
    """The rules of a dictionary file in order, with lower-case names."""
    import pyarrow as pa
    from pyarrow import csv, json, parquet

    store, own = opened(path)
    if store.get_file_info(own).type == arrow_fs.FileType.Directory:
        files = sorted(f.path for f in store.get_file_info(arrow_fs.FileSelector(own)) if f.is_file and not f.base_name.startswith(("_", ".")))
    else:
        files = [own]
    rows: list[dict] = []
    for f in files:
        with store.open_input_file(f) as source:
            table: pa.Table = parquet.read_table(source) if f.endswith(".parquet") else json.read_json(source) if f.endswith(".json") else csv.read_csv(source)
        rows += [{k.lower(): v for k, v in r.items()} for r in table.to_pylist()]
    for name in ("segnam", "field_pos", "field_name", "offset", "length"):
        if rows and name not in rows[0]:
            raise ValueError(f"dictionary is missing the required column '{name}'")
    return sorted(rows, key=lambda r: (r["field_pos"] is None, r["field_pos"] or 0))


def inside(rule: dict) -> bool:
    o, n = rule["offset"], rule["length"]
    return o is not None and n is not None and o >= 0 and n >= 0 and o + n <= SDATA_LEN


class Kind:
    """The schema of a kind and its rows from records."""

    def __init__(self, options):
        self.name = options.get("kind", "raw").lower()
        self.encoding = "latin-1" if options.get("encoding", "").lower() in LATIN_1 else "utf-8"
        self.segnam = options.get("segnam")
        self.keep = options.get("include_unknown", "true").lower() != "false"
        self.only = options.get("only", {"control": "C", "data": "D", "segment": "D", "fields": "D"}.get(self.name, ""))
        if self.name not in ("raw", "data", "control", "segment", "fields", "xml", "records"):
            raise ValueError(f"unknown kind '{self.name}': use raw, data, control, segment, fields, xml or records")
        if self.name in ("segment", "fields", "records") and not options.get("dict"):
            raise ValueError(f"kind '{self.name}' needs the option 'dict'")
        if self.name == "segment" and not self.segnam:
            raise ValueError("kind 'segment' needs the option 'segnam'")
        self.rules: dict[str, list[dict]] = {}
        for r in dictionary_rows(options["dict"]) if options.get("dict") else []:
            if self.name != "records" and not inside(r) and self.segnam in (None, r["segnam"]):
                raise ValueError(f"field '{r['field_name']}' offset/length out of SDATA bounds")
            self.rules.setdefault(r["segnam"], []).append(r)
        if self.name == "segment" and self.segnam not in self.rules:
            raise ValueError(f"dictionary has no fields for segment '{self.segnam}'")

    def schema(self) -> str:
        if self.name in ("raw", "records"):
            return RAW
        if self.name == "control":
            middle = ", ".join(f"{n.lower()} string" for n, _ in CONTROL_FIELDS)
        elif self.name == "data":
            middle = ", ".join(f"{n.lower()} string" for n in (*_HEADS, "SDATA"))
        elif self.name == "segment":
            seen: dict[str, int] = {}
            names = ["segnum"]
            for r in self.rules[self.segnam]:
                name = (r["field_name"] or "").lower()
                seen[name] = seen.get(name, -1) + 1
                names.append(f"{name}_{seen[name]}" if seen[name] else name)
            middle = ", ".join(f"`{n}` string" for n in names)
        elif self.name == "fields":
            middle = "segnum string, psgnum string, hlevel string, segnam string, field_pos int, field_name string, datatype string, value string"
        else:
            middle = "seq long, segnam string, hlevel int, field_name string, value string"
        return f"document_key long, {middle}, filename string"

    def wanted(self, record: Record) -> bool:
        """Whether a raw record is among those that ``only`` and ``segnam`` leave."""
        if self.only and record[2] != self.only:
            return False
        return not (self.segnam and record[2] == "D" and record[3][:30].rstrip(b" ") != self.segnam.encode())

    def _text(self, raw: bytes) -> str:
        return raw.rstrip(b" ").decode(self.encoding, "replace")

    def rows(self, found: Iterator[Record], name: str) -> Iterator[tuple]:
        """The kind's rows of a file's records (for all kinds but ``xml`` and ``records``)."""
        for document, index, kind, raw in filter(self.wanted, found):
            if self.name == "raw":
                yield document, index, kind, raw, name
                continue
            if len(raw) < (CONTROL_LEN if kind == "C" else DATA_LEN):
                raise ValueError(f"record is too short: {len(raw)} bytes")
            if kind == "C":
                yield document, *(self._text(raw[o : o + n]) for _, o, n in placed(CONTROL_FIELDS)), name
                continue
            head = {n: raw[slice(*_AT[n])].rstrip(b" ").decode("utf-8", "replace") for n in _HEADS}
            body = raw[slice(*_AT["SDATA"])]
            if self.name == "data":
                yield document, *head.values(), body.decode(self.encoding, "replace"), name
                continue
            rules = self.rules.get(head["SEGNAM"], [])
            cut = [self._text(body[r["offset"] : r["offset"] + r["length"]]) for r in rules]
            if self.name == "segment":
                yield document, head["SEGNUM"], *cut, name
                continue
            start = (document, head["SEGNUM"], head["PSGNUM"], head["HLEVEL"], head["SEGNAM"])
            for r, value in zip(rules, cut, strict=True):
                yield *start, r["field_pos"], r["field_name"], r.get("datatype") or None, value, name
            if not rules and self.keep:
                yield *start, None, None, None, self._text(body), name

    def xml_rows(self, chunks: Iterable[bytes], name: str) -> Iterator[tuple]:
        """The rows of an IDoc-XML file for the kinds ``xml`` and ``records``."""
        index = 0
        for k, doc in enumerate(xml.documents(chunks), 1):
            if self.name == "records":
                for kind, record in xml.records(doc, self.rules):
                    yield k, index, kind, record, name
                    index += 1
                continue
            for n, v in doc.control:
                yield k, 0, "EDI_DC40", 0, n, v.rstrip(" "), name
            for seq, s in enumerate(doc.segments, 1):
                for n, v in s.fields or [("", "")]:
                    yield k, seq, s.name, s.level, n, v.rstrip(" "), name
