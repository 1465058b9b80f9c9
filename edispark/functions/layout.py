"""Record layouts of IDoc files and the options that readers and writers share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL_LEN, DATA_LEN, SDATA_LEN = 524, 1063, 1000

# Field names and lengths of the control and data records, in order.
CONTROL_FIELDS = [
    ("TABNAM", 10), ("MANDT", 3), ("DOCNUM", 16), ("DOCREL", 4), ("STATUS", 2), ("DIRECT", 1), ("OUTMOD", 1), ("EXPRSS", 1), ("TEST", 1),
    ("IDOCTYP", 30), ("CIMTYP", 30), ("MESTYP", 30), ("MESCOD", 3), ("MESFCT", 3), ("STD", 1), ("STDVRS", 6), ("STDMES", 6), ("SNDPOR", 10),
    ("SNDPRT", 2), ("SNDPFC", 2), ("SNDPRN", 10), ("SNDSAD", 21), ("SNDLAD", 70), ("RCVPOR", 10), ("RCVPRT", 2), ("RCVPFC", 2), ("RCVPRN", 10),
    ("RCVSAD", 21), ("RCVLAD", 70), ("CREDAT", 8), ("CRETIM", 6), ("REFINT", 14), ("REFGRP", 14), ("REFMES", 14), ("ARCKEY", 70), ("SERIAL", 20),
]
DATA_FIELDS = [("SEGNAM", 30), ("MANDT", 3), ("DOCNUM", 16), ("SEGNUM", 6), ("PSGNUM", 6), ("HLEVEL", 2), ("SDATA", 1000)]
FRAMINGS = {"fixed": "fixed", "contiguous": "fixed", "lf": "lf", "newline": "lf", "terminated_lf": "lf", "crlf": "crlf", "terminated_crlf": "crlf"}
LATIN_1 = frozenset({"latin-1", "latin1", "iso-8859-1", "iso8859-1"})


def placed(fields: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    """(name, offset, length) of consecutive fields."""
    out, at = [], 0
    for name, length in fields:
        out.append((name, at, length))
        at += length
    return out


def framing_of(name: str | None) -> str:
    """The canonical framing; None is detected from the file."""
    if name is None:
        return "auto"
    if name.lower() not in FRAMINGS:
        raise ValueError(f"unknown framing '{name}': use fixed, lf or crlf")
    return FRAMINGS[name.lower()]


def is_control(record: bytes) -> bool:
    return record[:6] == b"EDI_DC"


def decoded(raw: Column, encoding: str | None) -> Column:
    """Text of bytes: Latin-1 under its usual names, any other name passes the bytes through."""
    return F.decode(raw, "ISO-8859-1") if encoding and encoding.lower() in LATIN_1 else raw.cast("string")


def slice_of(record: Column, offset: int, length: int) -> Column:
    return F.substring(record, offset + 1, length)
