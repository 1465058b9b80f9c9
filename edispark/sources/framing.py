"""Cut a stream of bytes into IDoc records, holding one record and one chunk at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from edispark.functions.layout import CONTROL_LEN, DATA_LEN, is_control


class FramingError(ValueError):
    pass


def looks_like_xml(head: bytes) -> bool:
    """The first byte that is no blank and no byte-order mark is ``<``."""
    return head[:4096].lstrip(b" \t\r\n\xef\xbb\xbf\xfe\xff")[:1] == b"<"


class _Chunks:
    """Bytes from chunks on demand; what is taken is not copied but once."""

    def __init__(self, chunks: Iterable[bytes]):
        self.source, self.held, self.at = iter(chunks), b"", 0

    def fill(self, n: int) -> int:
        """Hold at least ``n`` bytes if there are so many; the number held."""
        while len(self.held) - self.at < n:
            more = next(self.source, None)
            if more is None:
                break
            self.held, self.at = self.held[self.at :] + more, 0
        return len(self.held) - self.at

    def starts_control(self) -> bool:
        return self.held.startswith(b"EDI_DC", self.at)

    def line_end(self, within: int) -> int:
        """Bytes before the first line feed among the next ``within``; -1 without one."""
        found = self.held.find(b"\n", self.at, self.at + within)
        return found - self.at if found >= 0 else -1

    def take(self, n: int) -> bytes:
        out = self.held[self.at : self.at + n]
        self.at += n
        return out


def detect(head: bytes) -> str:
    if len(head) < CONTROL_LEN:
        raise FramingError("cannot detect the framing: the file is shorter than a control record")
    if head[CONTROL_LEN : CONTROL_LEN + 2] == b"\r\n":
        return "crlf"
    return "lf" if head[CONTROL_LEN : CONTROL_LEN + 1] == b"\n" else "fixed"


def _fixed(data: _Chunks, lenient: bool) -> Iterator[bytes]:
    while held := data.fill(6):
        want = CONTROL_LEN if data.starts_control() else DATA_LEN
        if held < 6 or data.fill(want) < want:
            if lenient:
                return
            raise FramingError("the file is not aligned to fixed-width records (truncated or wrong framing)")
        yield data.take(want)


class _Overlong(FramingError):
    """A line without its end where one must be; a lenient scan of a file ends there."""


def _terminated(data: _Chunks, crlf: bool, lenient: bool, number: int) -> Iterator[bytes]:
    longest = DATA_LEN + 2
    while held := data.fill(longest + 1):
        end = data.line_end(longest + 1)
        if end < 0 and held > longest:
            raise _Overlong(f"malformed terminated IDoc record #{number}: no line end within {longest} bytes (wrong framing)")
        line = data.take(end + 1)[:-1] if end >= 0 else data.take(held)
        if crlf and line.endswith(b"\r"):
            line = line[:-1]
        want = CONTROL_LEN if is_control(line) else DATA_LEN
        if not lenient and len(line) != want:
            raise FramingError(f"malformed terminated IDoc record #{number}: got {len(line)} bytes, expected {want}")
        yield line
        number += 1


def records(chunks: Iterable[bytes], framing: str = "auto", lenient: bool = False, document: int = 0, first: int = 0) -> Iterator[tuple[int, int, str, bytes]]:
    """(document_key, record_index, 'C' or 'D', bytes) of a file's records in order.

    ``document`` and ``first`` are the documents and records before the first chunk, for a part of a file.
    """
    data = _Chunks(chunks)
    if not data.fill(CONTROL_LEN + 2):
        return
    kind = detect(data.held) if framing == "auto" else framing
    index = first
    try:
        for raw in _fixed(data, lenient) if kind == "fixed" else _terminated(data, kind == "crlf", lenient, first):
            control = is_control(raw)
            document += control
            yield document, index, "C" if control else "D", raw
            index += 1
    except _Overlong:
        if not lenient:
            raise


def line_start(file, at: int, size: int) -> int:
    """The start of the first line at or after ``at`` (``size`` if none begins there)."""
    if at <= 0:
        return 0
    at -= 1
    file.seek(at)
    while block := file.read(1 << 12):
        found = block.find(b"\n")
        if found >= 0:
            return min(at + found + 1, size)
        at += len(block)
    return size


def counted(chunks: Iterable[bytes], framing: str, lenient: bool) -> tuple[int, int, bool]:
    """(documents, records, whether a lenient scan goes on behind them) of a part of a file with line ends."""
    data = _Chunks(chunks)
    documents = number = 0
    try:
        for raw in _terminated(data, framing == "crlf", lenient, 0):
            documents += is_control(raw)
            number += 1
    except _Overlong:
        if not lenient:
            raise
        return documents, number, False
    return documents, number, True


def cuts(file, size: int, every: int) -> list[tuple[int, int, int, int]] | None:
    """Parts of a file without line ends as (start, stop, documents before, records before), each of about ``every`` bytes.

    Only the heads of records are looked at, since a record's first bytes tell its length: the same
    walk that reads the file. None if it does not end where a record does: then it is read as a whole.
    """
    out, at, start, document, number = [], 0, 0, 0, 0
    before = (0, 0)
    while at < size:
        if at - start >= every:
            out.append((start, at, *before))
            start, before = at, (document, number)
        file.seek(at)
        control = is_control(file.read(6))
        document += control
        number += 1
        at += CONTROL_LEN if control else DATA_LEN
    if at != size:
        return None
    return [*out, (start, size, *before)]
