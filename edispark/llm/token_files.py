"""Token ids in ORC files: stripes, run-length encoded integers, row indexes, Bloom filters.

``write_tokens`` sorts documents by id over a range partitioning, encodes each text and writes one
ORC file for each partition: ids are integer lists under ORC's run-length encoding, ``doc_id`` has
row indexes (least and greatest value of every 10,000 rows) and a Bloom filter. ``read_tokens``
reads whole files stripe by stripe in parallel; a filter on ``doc_id`` skips files, stripes and row
groups by their metadata.

Encoding is by the tokenizers library. Its cost is in the merges, and words repeat, so a
worker keeps the ids of pieces it has met. A text is cut where a character that is no white space
meets ASCII white space, and where a letter meets an ASCII sign other than the apostrophe; the vocabulary's own
splitting pattern always ends a token there, so the
ids of the pieces in a row are the ids of the text. The distinct pieces of many texts are looked up, and the new ones merged, together. Texts with other white space or with an
added token of the vocabulary are encoded whole.

Each row carries its place: the number of its range (``part``) and of the row in it (``place``). The order of
the corpus is by these two, whatever files are called and however they are read.

Defined cases: a null or empty text is only the end id; rows with the same id, null too, are ordered by a hash
of their texts (equal rows stay as they are) and start one behind the other as in the file; null ids come first;
an empty table gives no rows; further input columns are not written.
"""

from __future__ import annotations

import codecs
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edispark.shipping import shared_dir, ship

END = 2
#: Pieces that a worker keeps before it starts anew.
KEPT_PIECES = 1_200_000
_PIECE = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
#: Single blanks and line ends between words need no pattern to cut at; these do.
_RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")
_ASCII_OTHERS = ("\x1c", "\x1d", "\x1e", "\x1f")
_OTHER_SPACES = _ASCII_OTHERS + tuple(map(chr, (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)))


#: Characters of the texts whose pieces are looked up together, and how many new parts go to the library in one call at least.
_TOGETHER, _FEW = 1 << 21, 4
#: Bytes that are a blank, a line end, a sign other than the apostrophe of contractions, or an ASCII letter.
_KINDS = np.zeros(256, np.uint8)
_KINDS[32], _KINDS[10] = 1, 2
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 4
_KINDS[[c for c in range(128) if chr(c).isalpha()]] = 16


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts by a tokenizer file, with the ids of met pieces kept.

    For a byte-level vocabulary a new piece is split by the vocabulary's pattern and its parts go to
    the library's merge model; any other tokenizer file encodes whole texts. Pieces, most of them words behind a blank, are kept in two
    generations: when the younger is full it becomes the older, from which a word that comes again moves back, so that
    words met once make room and the others stay.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model = self.tokenizer.model
        self.merges = Tokenizer(self.model)
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, k in vocabulary.items():
            self.lengths[k] = len(token)
        made = json.loads(self.tokenizer.to_str())
        kind = made.get("pre_tokenizer") or {}
        self.by_piece = made.get("normalizer") is None and made["model"]["type"] == "BPE" and kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind.get("add_prefix_space")
        import public_tokenizers

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # the byte alphabet: printable Latin-1 stands for itself, the other bytes for code points from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        made_of = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.alphabet = "".join(made_of[b] for b in range(256))
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.after_blank: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, part: str) -> bytes:
        tokens = self.model.tokenize(codecs.charmap_decode(part.encode(), "strict", self.alphabet)[0])
        return array("I", [t.id for t in tokens]).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of what the pattern finds in a piece; behind a blank it is a word of its own."""
        if part[0] == " " and not part[-1].isspace():
            got = self.after_blank.get(part) or self.older.get(part) or self._merged(part)
        else:
            got = self.parts.get(part)
            if got is None:
                got = self.parts[part] = self._merged(part)
        return got

    def _piece(self, piece: str) -> bytes:
        got = self.pieces[piece] = b"".join(map(self._part, self.pattern.findall(piece)))
        return got

    def _learned(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that the younger generation lacks; they are kept in it."""
        out = list(map(self.older.get, pieces))
        fresh = [k for k, got in enumerate(out) if got is None]
        simple = []
        for k in fresh:
            word = pieces[k][1:] if pieces[k][0] == " " else pieces[k]
            # Latin letters are one part without the pattern
            if word.isalpha() and (word.isascii() or max(word) < "\u0250"):
                simple.append(k)
            else:
                out[k] = b"".join(map(self._part, self.pattern.findall(pieces[k])))
        for k, got in zip(simple, self._merged_all([pieces[k] for k in simple]), strict=True):
            out[k] = got
        self.after_blank.update(zip(pieces, out, strict=True))
        return out

    def _merged_all(self, parts: list[str]) -> list[bytes]:
        """Ids of parts without carriage returns, each by the merge model alone; many go to the library in one call."""
        if len(parts) < _FEW:
            return list(map(self._merged, parts))
        shown = codecs.charmap_decode("\r".join(parts).encode(), "strict", self.alphabet)[0].split(self.alphabet[13])
        (made,) = self.merges.encode_batch_fast([shown], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(made.ids, np.uint32)
        # a token stands for as many bytes as it has characters, so the bytes tell where a part ends
        reached, ends = np.cumsum(self.lengths[ids]), np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown)))
        at = np.searchsorted(reached, ends)
        if at[-1] == len(ids) or not np.array_equal(reached[at], ends):
            # a vocabulary that lacks a byte
            return list(map(self._merged, parts))
        raw, cut = ids.tobytes(), (at * 4 + 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cut], cut, strict=False)]

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of texts whose white space is single blanks and line ends: each distinct piece of theirs is looked up once."""
        column = pa.array(texts, pa.large_string())
        _, offsets, content = column.buffers()
        first = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
        data = np.frombuffer(content, np.uint8)[: first[-1]]
        # a piece begins with a text, at a blank or a line end, behind a line end, and where a sign follows a letter
        kind = _KINDS[data]
        cut = kind & 3 > 0
        letter = kind == 16
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut[1:] |= letter[:-1] & (kind[1:] == 4) | (kind[:-1] == 2)
        cut[first[:-1]] = True
        begins = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(data))), content)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.after_blank.get, distinct))
        unmet = [k for k, got in enumerate(ids) if got is None]
        if unmet:
            for k, got in zip(unmet, self._learned([distinct[k] for k in unmet]), strict=True):
                ids[k] = got
        spot = coded.indices.to_numpy()
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(length) - length
        own = length[spot]
        ends = np.append(0, np.cumsum(own))
        raw = np.frombuffer(b"".join(ids), np.uint32)[np.arange(ends[-1]) + np.repeat(start[spot] - ends[:-1], own)].tobytes()
        bounds = (ends[np.searchsorted(begins, first)] * 4).tolist()
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield raw[a:b]

    def _other(self, text: str) -> bytes | None:
        """Ids of a text that is not cut at single blanks and line ends, or None."""
        if not self.by_piece or any(c in text for c in self.added) or any(c in text for c in (_ASCII_OTHERS if text.isascii() else _OTHER_SPACES)):
            return self._whole([text])[0]
        if any(c in text for c in _RUNS):
            return b"".join([self.pieces.get(p) or self._piece(p) for p in _PIECE.findall(text)])
        return None if text else b""

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        at = 0
        while at < len(texts):
            if len(self.pieces) + len(self.parts) > KEPT_PIECES // 4:
                self.pieces.clear()
                self.parts.clear()
            if len(self.after_blank) > KEPT_PIECES // 2:
                self.older, self.after_blank = self.after_blank, {}
            group, size = [], 0
            while at < len(texts) and size < _TOGETHER:
                group.append(texts[at])
                size += len(texts[at])
                at += 1
            others = list(map(self._other, group))
            plain = [t for t, got in zip(group, others, strict=True) if got is None]
            ids = self._plain(plain) if plain else iter(())
            for got in others:
                yield next(ids) if got is None else got


_FILE = "doc_id long, n_tokens long, ids array<int>, part int, place long"
_NAMES = [c.split()[0] for c in _FILE.split(", ")]


def _encoded(path: str, end: int):
    tail = array("I", [end]).tobytes()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        encoder = Encoder.of(path)
        own, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = [ids + tail for ids in encoder.encode(texts)]
                ends = array("i", [0])
                for r in rows:
                    ends.append(ends[-1] + len(r) // 4)
                values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(rows))])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                numbers = pa.array(range(place, place + len(rows)), pa.int64())
                place += len(rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(r) // 4 for r in rows], pa.int64()), ids, pa.array([own] * len(rows), pa.int32()), numbers], _NAMES)

    return over


def write_tokens(docs: DataFrame, out: str, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, partitions: int | None = None) -> None:
    """Write ``docs`` as token files under ``out``, in ascending order of ids over the files' names."""
    spark = docs.sparkSession
    ship(spark)
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    df = df.mapInArrow(_encoded(path, end), _FILE)
    (
        df.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").option("orc.stripe.size", str(64 << 20))
        .option("orc.row.index.stride", "10000").option("compression", "none").orc(out)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, part, place`` of token files; filters on ``doc_id`` are pushed down to stripes."""
    return spark.read.schema(_FILE).orc(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(4)
        raw = memoryview(ids.values.buffers()[1])
        at = ids.offsets.to_pylist()
        base = ids.values.offset
        crc = [zlib.crc32(raw[4 * (base + a) : 4 * (base + b)]) for a, b in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], ["part", "place", "doc_id", "n_tokens", "ids_crc32"])


def index_of(spark: SparkSession, path: str) -> DataFrame:
    """From the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts the ids of all documents before.

    Sums by range come first; a window over the ranges alone, one row each, gives their starts, and one in each range the rest.
    """
    rows = read_tokens(spark, path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    checked = rows.select("part", "place", "doc_id", "n_tokens", "ids").mapInArrow(_checksums, "part int, place long, doc_id long, n_tokens long, ids_crc32 long")
    in_part = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    checked = checked.withColumn("_at", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)))
    return checked.join(parts, "part").select("doc_id", (F.col("_before") + F.col("_at")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def tokenized(docs: DataFrame, path: str, **how) -> DataFrame:
    """Write token files to the shared folder and give their index as read back."""
    out = shared_dir(docs.sparkSession, "token-files")
    write_tokens(docs, out, path, **how)
    return index_of(docs.sparkSession, out)
