"""IDoc-XML: parse a file to documents, and write documents as text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from xml.parsers import expat

from edispark.functions.layout import CONTROL_FIELDS, SDATA_LEN


class XmlError(ValueError):
    pass


@dataclass
class Element:
    name: str
    segment: bool
    text: str | None = None  # what stands before the first child
    children: list[Element] = field(default_factory=list)


_GONE = Element("", False)


@dataclass
class Segment:
    name: str
    level: int
    fields: list[tuple[str, str]]


@dataclass
class Document:
    control: list[tuple[str, str]]
    segments: list[Segment]


def _idocs(chunks: Iterable[bytes]) -> Iterator[Element]:
    """The IDOC elements of a file as they end: the root's children, or the root if it is one and has none; other children are not kept."""
    top = Element("", False)
    open_: list[Element] = [top]
    ended: list[Element] = []
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def start(name, attrs):
        e = Element(name, "SEGMENT" in attrs)
        parent = open_[-1]
        parent.children.append(e)
        parent.text = parent.text or ""
        open_.append(e)

    def end(_):
        e = open_.pop()
        if len(open_) == 2:
            root = open_[1]
            if idoc := e.name.upper() == "IDOC":
                ended.append(e)
                top.segment = True  # some were found
            if idoc or top.segment or root.name.upper() != "IDOC":
                # what stands before the first child is the text of the root, which has a child for it
                root.children = [_GONE]

    def text(data):
        e = open_[-1]
        if not e.children:
            e.text = (e.text or "") + data

    def refuse(*_):
        raise XmlError("document type definitions are not accepted")

    parser.StartElementHandler, parser.CharacterDataHandler, parser.StartDoctypeDeclHandler = start, text, refuse
    parser.EndElementHandler = end
    try:
        for block in chunks:
            parser.Parse(block, False)
            yield from ended
            ended.clear()
        parser.Parse(b"", True)
    except expat.ExpatError as e:
        raise XmlError(f"malformed IDoc-XML: {e}") from None
    yield from ended
    root = top.children[0]
    if not top.segment:
        if root.name.upper() != "IDOC":
            raise XmlError("no <IDOC> element found")
        yield root


def _own_text(e: Element) -> str:
    return e.text or ""


def _collect(top: Element, out: list[Segment]) -> None:
    """The segments of an element and those in it, in document order, to any depth."""
    waiting = [(top, 1)]
    while waiting:
        e, level = waiting.pop()
        inner = [c for c in e.children if c.segment or c.children]
        out.append(Segment(e.name, level, [(c.name, _own_text(c)) for c in e.children if not (c.segment or c.children)]))
        waiting += [(c, level + 1) for c in reversed(inner)]


def parse(raw: bytes) -> list[Document]:
    """Documents of a file: the root's IDOC children, or the root if it is one."""
    return list(documents([raw]))


def documents(chunks: Iterable[bytes]) -> Iterator[Document]:
    """Documents of a file that comes in chunks; one document is held at a time."""
    for idoc in _idocs(chunks):
        doc = Document([], [])
        for child in idoc.children:
            if child.name.startswith("EDI_DC"):
                doc.control = [(f.name, _own_text(f)) for f in child.children]
            else:
                _collect(child, doc.segments)
        if not doc.control and not doc.segments:
            raise XmlError("an <IDOC> element has neither a control record nor segments")
        yield doc


def lookup(fields: list[tuple[str, str]], name: str) -> str:
    """The first value under a name, in any case; empty if there is none."""
    return next((v for k, v in fields if k.upper() == name.upper()), "")


def control_bytes(fields: list[tuple[str, str]]) -> bytes:
    return b"".join(lookup(fields, name).encode()[:n].ljust(n) for name, n in CONTROL_FIELDS)


def records(doc: Document, rules: dict[str, list[dict]]) -> Iterator[tuple[str, bytes]]:
    """('C' or 'D', bytes) of a document's records, fields placed by the dictionary's rules; segments without rules stay blank."""
    yield "C", control_bytes(doc.control)
    number = lookup(doc.control, "DOCNUM")
    head = lookup(doc.control, "MANDT").encode()[:3].ljust(3) + _digits(int(number) if number else 0, 16)
    latest: dict[int, int] = {}
    for seq, s in enumerate(doc.segments, 1):
        latest[s.level] = seq
        body = bytearray(b" " * SDATA_LEN)
        for r in rules.get(s.name, []):
            o, n = r["offset"] or 0, r["length"] or 0
            if o < 0 or n < 0 or o + n > SDATA_LEN:
                raise ValueError("encode_sdata: offset/length out of SDATA bounds")
            body[o : o + n] = lookup(s.fields, r["field_name"] or "").rstrip(" ").encode()[:n].ljust(n)
        yield "D", s.name.encode()[:30].ljust(30) + head + _digits(seq, 6) + _digits(latest.get(s.level - 1, 0), 6) + _digits(s.level, 2) + bytes(body)


def _digits(number: int, width: int) -> bytes:
    return f"{max(number, 0):0{width}d}"[-width:].encode()


HEAD = '<?xml version="1.0" encoding="utf-8"?>\n'
IDOC_HEAD = '  <IDOC BEGIN="1">\n    <EDI_DC40 SEGMENT="1">\n'
IDOC_CONTROL_END = "    </EDI_DC40>\n"
IDOC_END = "  </IDOC>\n"


class OpenSegments:
    """The segments that are open while a document is written; nesting follows the levels."""

    def __init__(self):
        self.open: list[tuple[str, int]] = []

    def enter(self, name: str, level: int) -> str:
        self.open.append((name, level))
        return f'{" " * (4 + 2 * level)}<{name} SEGMENT="1">\n'

    def leave(self, level: int) -> Iterator[str]:
        """The ends of all open segments at a level or below it, the innermost first."""
        while self.open and self.open[-1][1] >= level:
            name, own = self.open.pop()
            yield f"{' ' * (4 + 2 * own)}</{name}>\n"
