"""A log-bilinear language model with noise-contrastive estimation, over the whole corpus.

Tokens are words (A-Z lower-cased) and one end for each text, each known by a 64-bit hash. The net predicts a
*unit*: a frequent token (the shortlist: as many as ``SHORTLIST`` of those seen three times or more), or one of the buckets
that share the others out by their last bytes; the number of buckets grows with the square root of the
vocabulary. Units go by frequency into classes of about the square root of their number.

With context vectors r of the ``CONTEXT`` units before, position weights c, and output vectors q, the score of a
class or of a unit in its class is ``(sum over k of c_k * r_k) . q + b``; softmax over the classes, and over the units of a
class, normalises both exactly, so a token costs two products of about the square root of the vocabulary.
A bucket's mass goes to its words by absolute discounting of their corpus counts, and what the discount
frees to a word that training has not seen.

Over this net lies a memory of the corpus for words outside the shortlist: with g a hash of the two words
before, P(w) = (n(g, w) - 1) / n(g) + rest(g) * P_net(w), where the first term needs n(g, w) of two at least
and rest(g) is the mass that these terms leave. A pair seen once adds nothing, so a text of the training part gains
nothing from itself, but passages that recur in other texts are told apart. All probabilities of a context add up to 1.

What is gathered grows with the corpus: counts of every token, and of every (g, w) with w outside the shortlist, both
distributed tables that texts meet in a join. Only bounded parts travel to the driver and to all tasks: the shortlist,
vectors, sums by bucket and by g (at most ``MEMORY`` of them).

Training is spread over the corpus: each task makes a pass over all texts of its part (more than one until it has
made ``STEPS`` steps) with sampled noise, classes against draws of class frequencies and units against draws within their class;
the parts' vectors are averaged row by row, weighted by how often each row was met. Of targets that hold a share of more
than ``FREQUENT``, one in ``THIN`` makes a step and counts that often; every token is context, and every rarer one a target.

Defined cases: a null or empty text is its end alone; equal rows get a row each; a null id counts by
the checksum of an empty string; with no training text all counts are 0 and the base gives 0;
further columns are ignored. Two tokens with one 64-bit hash would be one token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edispark.llm import shingles as S
from edispark.shipping import ship, stored

SHORTLIST, CONTEXT, WIDTH = 20_000, 4, 16
#: Most buckets and most contexts of the memory; both are powers of two.
BUCKETS, MEMORY = 2048, 1 << 20
#: Training: tokens of a step, steps of a part at least, tokens of a part at least, noise draws of classes (shared) and of units (each token).
BATCH, STEPS, PART, CLASS_NOISE, UNIT_NOISE = 2048, 300, 400_000, 16, 4
#: Units above this share of all tokens are thinned as targets.
FREQUENT, THIN = 2.0**-14, 4
END = 1
_U = np.uint64
_DRAWS = 1024
#: Slots of the table that finds tokens of the shortlist.
_SLOTS = 1 << 18
#: Tokens that a task holds before it hands counts on, and that are scored in one go.
_HELD, _CACHED = 3_000_000, 2048
_FINE = float(1 << 26)


_LOWER = np.arange(256)
_LOWER[65:91] += 32
_FIRST, _SECOND, _THIRD = _LOWER * 7919, _LOWER * 104729, _LOWER * 1299709


@dataclass
class Read:
    """Tokens of several texts in a row: hashes, 16 bits of the last bytes, and the texts' offsets (one entry more)."""

    hashes: np.ndarray
    last: np.ndarray
    at: np.ndarray


def read(data: np.ndarray, offsets: np.ndarray) -> Read:
    rows = len(offsets) - 1
    starts, stops = S.word_bounds(data, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
    w_at = np.searchsorted(starts, offsets)
    spot = np.arange(len(starts)) + np.repeat(np.arange(rows), np.diff(w_at))
    at = w_at + np.arange(rows + 1)
    hashes, last = np.full(at[-1], END, _U), np.zeros(at[-1], np.int64)
    if len(starts):
        hashes[spot] = S.bounded_hashes(data, starts, stops)
        own = _FIRST[data[stops]]
        for k, table in ((1, _SECOND), (2, _THIRD)):
            own += np.where(stops - starts >= k, table[data[np.maximum(stops - k, 0)]], 0)
        last[spot] = own >> 3 & 0xFFFF
    return Read(hashes, last, at)


def reads(texts: pa.Array, tokens: int = 1 << 62) -> Iterator[tuple[int, int, Read]]:
    """(first row, last row + 1, tokens) of a column in steps."""
    for a, b, data, offsets in S.parts(texts):
        yield a, b, read(data, offsets)


def memory_of(r: Read, size: int) -> np.ndarray:
    """The context g of each token: a hash of the two tokens before it in its text."""
    one, two = np.zeros_like(r.hashes), np.zeros_like(r.hashes)
    one[1:], two[2:] = r.hashes[:-1], r.hashes[:-2]
    first = r.at[:-1]
    one[first], two[first] = 0, 0
    second = first[np.diff(r.at) > 1] + 1
    two[second] = 0
    return (S.mix(one * _U(0x9E3779B97F4A7C15) + two) & _U(size - 1)).astype(np.int64)


@dataclass
class Units:
    """Units by frequency: which token or bucket each is, and how tokens find theirs."""

    hashes: np.ndarray  # of the shortlist, ascending
    unit: np.ndarray  # their units
    counts: np.ndarray  # their counts
    bucket: np.ndarray  # unit of each bucket
    mass: np.ndarray  # occurrences of each unit
    totals: np.ndarray  # of each bucket
    types: np.ndarray
    discount: float
    memory: int

    @property
    def step(self) -> int:
        """Units of a class."""
        return max(1, int(np.ceil(np.sqrt(len(self.mass)))))

    @cached_property
    def _slots(self) -> tuple[np.ndarray, bool]:
        """Places in the shortlist by the last bits of a hash, -1 where several share these; any place where none has them."""
        slot = (self.hashes & _U(_SLOTS - 1)).astype(np.int64)
        table = np.zeros(_SLOTS, np.int32)
        table[slot] = np.arange(len(slot))
        several = np.bincount(slot, minlength=_SLOTS) > 1
        table[several] = -1
        return table, bool(several.any())

    def of(self, r: Read) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit of each token, its place in the shortlist or -1, and its bucket."""
        table, shared = self._slots
        spot = table[(r.hashes & _U(_SLOTS - 1)).astype(np.int64)]
        if shared:
            # places of several tokens are few: the least of them is looked for
            odd = np.flatnonzero(spot < 0)
            spot[odd] = np.minimum(np.searchsorted(self.hashes, r.hashes[odd]), len(self.hashes) - 1)
        hit = self.hashes[spot] == r.hashes
        bucket = r.last & (len(self.bucket) - 1)
        return np.where(hit, self.unit[spot], self.bucket[bucket]), np.where(hit, spot, -1), bucket


def units_of(hashes: np.ndarray, counts: np.ndarray, totals: np.ndarray, types: np.ndarray, discount: float, memory: int) -> Units:
    """Units from the shortlist (the end among it) and the sums of each bucket."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    mass = np.concatenate([counts, totals]).astype(float) + 0.5
    rank = np.empty(len(mass), np.int64)
    by_mass = np.argsort(-mass, kind="stable")
    rank[by_mass] = np.arange(len(mass))
    return Units(hashes, rank[: len(hashes)], counts, rank[len(hashes) :], mass[by_mass], totals.astype(float), types.astype(float), discount, memory)


@dataclass
class Net:
    """``context`` has a row for each unit and one for the start; ``out`` and ``bias`` for classes, then units."""

    context: np.ndarray
    position: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    classes: int
    step: int

    def hidden(self, contexts: np.ndarray) -> np.ndarray:
        h = np.take(self.context, contexts[:, 0], axis=0)
        h *= self.position[0]
        for k in range(1, CONTEXT):
            own = np.take(self.context, contexts[:, k], axis=0)
            own *= self.position[k]
            h += own
        return h

    def log_probabilities(self, contexts: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Normalised natural logs of units after contexts: a product with all classes, and one with the units of each class."""
        # a component that is always one carries the bias through the products
        h = np.ones((len(units), WIDTH + 1), np.float32)
        for a in range(0, len(units), _CACHED):
            h[a : a + _CACHED, :WIDTH] = self.hidden(contexts[a : a + _CACHED])
        out_t = np.concatenate([self.out, self.bias[:, None]], axis=1).T.astype(np.float32)
        # no score is larger than the longest vectors' product
        small = float(np.sqrt(np.einsum("bd,bd->b", h, h).max(initial=0.0) * np.einsum("dk,dk->k", out_t, out_t).max(initial=0.0))) < 59
        cls, got = units // self.step, np.empty(len(units), np.float32)
        for a in range(0, len(units), _CACHED):
            got[a : a + _CACHED] = _log_share(h[a : a + _CACHED] @ out_t[:, : self.classes], cls[a : a + _CACHED], small)
        order = np.argsort(cls, kind="stable")
        ends = np.searchsorted(cls[order], np.arange(self.classes + 1))
        for c in np.flatnonzero(np.diff(ends)):
            a, b = self.classes + c * self.step, min(self.classes + (c + 1) * self.step, len(self.out))
            for k in range(ends[c], ends[c + 1], _CACHED):
                own = order[k : min(k + _CACHED, ends[c + 1])]
                got[own] += _log_share(np.take(h, own, axis=0) @ out_t[:, a:b], units[own] - c * self.step, small)
        return got


def _log_share(s: np.ndarray, at: np.ndarray, small: bool = False) -> np.ndarray:
    """The log of one column's share of the exponentials in each row; ``s`` is worked on in place. ``small``: no entry is over 60."""
    hit = s[np.arange(len(s)), at]
    if small or float(np.abs(hit).max(initial=0)) < 60 and float(s.max(initial=0.0)) < 60:
        return hit - np.log(np.exp(s, out=s) @ np.ones(s.shape[1], s.dtype))
    top = s.max(axis=1)
    return hit - np.log(np.exp(s - top[:, None]).sum(axis=1)) - top


def contexts_of(units: np.ndarray, at: np.ndarray, start: int) -> np.ndarray:
    """The ``CONTEXT`` units before each token, the nearest first; ``start`` where the text has fewer."""
    own = np.arange(len(units)) - np.repeat(at[:-1], np.diff(at))
    out = np.full((len(units), CONTEXT), start, np.int32)
    for k in range(CONTEXT):
        here = own > k
        out[here, k] = units[np.flatnonzero(here) - k - 1]
    return out


def new_net(units: Units, seed: int = 5) -> Net:
    """A net that gives the unit frequencies, whatever the context."""
    n, step = len(units.mass), units.step
    classes = -(-n // step)
    own = np.add.reduceat(units.mass, np.arange(0, n, step))
    bias = np.concatenate([np.log(own / own.sum()), np.log(units.mass / np.repeat(own, step)[:n])])
    f4 = np.float32
    rng = np.random.default_rng(seed)
    return Net(rng.normal(0, 0.3, (n + 1, WIDTH)).astype(f4), np.full((CONTEXT, WIDTH), 0.5, f4), np.zeros((classes + n, WIDTH), f4), bias.astype(f4), classes, step)


class Trainer:
    """Noise-contrastive steps over a net, with a step size for each row by its past gradients."""

    def __init__(self, net: Net, units: Units, seed: int, rate: float = 0.05):
        self.net, self.rate = net, np.float32(rate)
        self.rng = np.random.default_rng(seed)
        n, step, f4 = len(units.mass), net.step, np.float32
        own = np.add.reduceat(units.mass, np.arange(0, n, step))
        # noise is drawn from tables of draws, in which every class, and every unit of a class, stands once at least
        self.class_draws, self.class_log = self._table(own)
        tables = [self._table(units.mass[a : a + step]) for a in range(0, n, step)]
        self.unit_draws = np.array([t + k * step for k, (t, _) in enumerate(tables)])
        self.unit_log = np.concatenate([x for _, x in tables]).astype(f4)
        self.past = [np.full(len(x), 1e-2, f4) for x in (net.context, net.out)]
        self.met = [np.zeros(len(x), f4) for x in (net.context, net.out)]
        self.past_position = f4(1.0)
        self.often = units.mass > FREQUENT * units.mass.sum()

    @staticmethod
    def _table(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draws by mass, and the log of each one's share of the table."""
        times = np.maximum(1, np.round(mass / mass.sum() * _DRAWS)).astype(np.int64)
        table = np.repeat(np.arange(len(mass)), times)
        table = table[np.linspace(0, len(table) - 1, _DRAWS).astype(np.int64)] if len(mass) <= _DRAWS else table
        share = np.bincount(table, minlength=len(mass)) / len(table)
        return table, np.log(np.maximum(share, 0.5 / len(table)))

    def _add(self, which: int, rows: np.ndarray, grads: np.ndarray, bias: np.ndarray | None = None) -> None:
        """One step up along the sums of gradients (a row for each component) by row of the table."""
        order = np.argsort(rows.astype(np.uint16) if len(self.met[which]) < 1 << 16 else rows, kind="stable")
        ordered = rows[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        own, place = ordered[new], np.empty(len(rows), np.int64)
        place[order] = np.cumsum(new) - 1
        total = np.array([np.bincount(place, g, len(own)) for g in grads], np.float32)
        target = self.net.context if which == 0 else self.net.out
        past = self.past[which][own] + np.einsum("wm,wm->m", total, total) / np.float32(WIDTH)
        self.past[which][own] = past
        size = self.rate / np.sqrt(past)
        moved = np.take(target, own, axis=0)
        moved += (total * size).T
        # a row is put back as one item
        item = f"V{moved.strides[0]}"
        target.view(item)[own] = moved.view(item)
        self.met[which][own] += 1
        if bias is not None:
            self.net.bias[own] += size * np.float32(0.3) * np.bincount(place, bias, len(own)).astype(np.float32)

    def targets(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens to learn from, in random order, and how often each counts."""
        often = self.often[units]
        own = np.flatnonzero(~often | (self.rng.integers(0, THIN, len(units)) == 0))
        own = own[self.rng.permutation(len(own))]
        return own, np.where(often[own], np.float32(THIN), np.float32(1))

    def step(self, contexts: np.ndarray, units: np.ndarray, weights: np.ndarray) -> None:
        # indexes by component come before those by token, so that inner loops are long
        net, f4 = self.net, np.float32
        r = np.take(net.context, contexts, axis=0)
        h = r[:, 0] * net.position[0]
        for k in range(1, CONTEXT):
            h += r[:, k] * net.position[k]
        cls = units // net.step
        # classes: all tokens of the step against the same draws
        noise = self.class_draws[self.rng.integers(0, len(self.class_draws), CLASS_NOISE)]
        k = f4(np.log(CLASS_NOISE))
        q = np.take(net.out, cls, axis=0)
        up = weights / (1 + np.exp((h * q).sum(axis=1) + net.bias[cls] - self.class_log[cls].astype(f4) - k))
        down = -weights[:, None] / (1 + np.exp(-(h @ net.out[noise].T + net.bias[noise] - self.class_log[noise].astype(f4) - k)))
        g_h = up[:, None] * q + down @ net.out[noise]
        # units: each token against draws of its own class
        drawn = self.unit_draws[cls[:, None], self.rng.integers(0, self.unit_draws.shape[1], (len(units), UNIT_NOISE))]
        rows = net.classes + np.concatenate([units[:, None], drawn], axis=1)
        qs = np.take(net.out, rows, axis=0)
        s = np.einsum("bd,bkd->bk", h, qs) + net.bias[rows] - self.unit_log[rows - net.classes] - f4(np.log(UNIT_NOISE))
        rise = -1 / (1 + np.exp(-s))
        rise[:, 0] += 1
        rise *= weights[:, None]
        g_h += np.einsum("bk,bkd->bd", rise, qs)
        h_t = np.ascontiguousarray(h.T)
        rise_t, n = np.ascontiguousarray(rise.T), rows.size
        out_rows = np.concatenate([rows.T.ravel(), cls, noise]).astype(np.int32)
        out_grads = np.empty((WIDTH, len(out_rows)), f4)
        np.multiply(h_t[:, None], rise_t, out=out_grads[:, :n].reshape(WIDTH, *rise_t.shape))
        np.multiply(h_t, up, out=out_grads[:, n : n + len(cls)])
        out_grads[:, n + len(cls) :] = h_t @ down
        out_bias = np.concatenate([rise_t.ravel(), up, down.sum(axis=0)])
        g_position = np.einsum("bd,bkd->kd", g_h, r)
        self._add(1, out_rows, out_grads, out_bias)
        self._add(0, contexts.T.ravel().astype(np.int32), (np.ascontiguousarray(g_h.T)[:, None] * net.position.T[:, :, None]).reshape(WIDTH, -1))
        self.past_position += float((g_position**2).mean())
        net.position += f4(0.05) * g_position / np.sqrt(self.past_position)


# ---- what runs in Spark's tasks ----


def _batch(columns: list, names: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    pairs = [c.split() for c in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(columns, pairs, strict=True)], [n for n, _ in pairs])


class _Held:
    """Rows of integers that are counted before they leave a task; ``key`` tells equal rows by one 64-bit number."""

    def __init__(self, names: str):
        self.names, self.parts, self.size = names, [], 0

    def add(self, key: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((key, *columns))
        self.size += len(key)
        if self.size > _HELD:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        key, *columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
        self.parts, self.size = [], 0
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times, spots = np.diff(np.append(first, len(order))), order[first]
        for a in range(0, len(first), 1 << 16):
            own = spots[a : a + (1 << 16)]
            yield _batch([*(c[own] for c in columns), times[a : a + (1 << 16)]], self.names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, last bytes, n) of texts."""
    held = _Held("w long, last int, n long")
    for batch in batches:
        for _, _, r in reads(batch.column(0)):
            yield from held.add(r.hashes, r.hashes.view(np.int64), r.last)
    yield from held.out()


def _pairs(units):
    """(w, g, n) of the tokens outside the shortlist with what stands before them."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = units.value, _Held("w long, g int, n long")
        for batch in batches:
            for _, _, r in reads(batch.column(0)):
                rare = known.of(r)[1] < 0
                w, g = r.hashes[rare], memory_of(r, known.memory)[rare]
                yield from held.add(S.mix(w + S.mix(g.astype(_U) + _U(1))), w.view(np.int64), g)
        yield from held.out()

    return over


_SLICES = 32
_PIECE = "kind int, slice int, weight binary, content binary"


def _bounds(n: int) -> list[int]:
    return [n * k // _SLICES for k in range(_SLICES + 1)]


def _trained(units, steps: int):
    """Vectors of a part, in slices of rows with how often each was met, and its counts of contexts."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = units.value
        start = len(known.mass)
        seed = TaskContext.get().partitionId()
        trainer = Trainer(new_net(known), known, seed)
        contexts = np.zeros(known.memory, np.int64)
        kept, done, size = [], 0, 0

        def learn(u: np.ndarray, at: np.ndarray) -> int:
            ctx, (turn, weights) = contexts_of(u, at, start), trainer.targets(u)
            for a in range(0, len(turn), BATCH):
                own = turn[a : a + BATCH]
                trainer.step(ctx[own], u[own], weights[a : a + BATCH])
            return -(-len(turn) // BATCH)

        for batch in batches:
            for _, _, r in reads(batch.column(0)):
                u = known.of(r)[0].astype(np.int32)
                contexts += np.bincount(memory_of(r, known.memory), minlength=known.memory)
                done += learn(u, r.at)
                size += len(u)
                # a small part is kept for further passes; a large one makes its steps in one
                if kept is not None:
                    kept.append((u, r.at))
                    kept = None if done >= steps else kept
        if not size:
            return
        while kept and done < steps:
            for u, at in kept:
                done += learn(u, at)
        net = trainer.net
        for kind, rows, met in ((0, net.context, trainer.met[0]), (1, np.concatenate([net.out, net.bias[:, None]], axis=1), trainer.met[1])):
            cut = _bounds(len(rows))
            for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                yield _batch([[kind], [k], [(met[a:b] + 1e-3).astype("<f4").tobytes()], [rows[a:b].astype("<f2").tobytes()]], _PIECE)
        yield _batch([[2], [0], [np.full(CONTEXT, size, "<f4").tobytes()], [net.position.astype("<f2").tobytes()]], _PIECE)
        cut = _bounds(known.memory)
        for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
            yield _batch([[3], [k], [b""], [contexts[a:b].astype("<u4").tobytes()]], _PIECE)

    return over


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the same rows from all parts, as one: means by weight, or sums of counts."""
    sums: dict[tuple[int, int], list] = {}
    for batch in batches:
        for kind, k, weight, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == 3:
                value, w = np.frombuffer(content, "<u4").astype(np.int64), 0
            else:
                w = np.frombuffer(weight, "<f4").astype(float)
                value = np.frombuffer(content, "<f2").reshape(len(w), -1) * w[:, None] if len(w) else np.zeros((0, 1))
            have = sums.get((kind, k))
            sums[kind, k] = [value, w] if have is None else [have[0] + value, have[1] + w]
    for (kind, k), (value, w) in sums.items():
        content = value.astype("<i8") if kind == 3 else (value / w[:, None] if len(w) else value).astype("<f4")
        yield _batch([[kind], [k], [b""], [content.tobytes()]], _PIECE)


def _packed(*names: str):
    """Columns of integers as bytes, a row for each batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(k).to_numpy().astype("<i8").tobytes()], pa.binary()) for k in range(len(names))], list(names))

    return over


def _arrays(df: DataFrame) -> list[np.ndarray]:
    """Columns of long integers on the driver, as packed bytes; only for tables of a known bound."""
    names = df.columns
    rows = df.mapInArrow(_packed(*names), ", ".join(f"{n} binary" for n in names)).collect()
    return [np.frombuffer(b"".join(r[n] for r in rows), "<i8") for n in names]


def fit(texts: DataFrame) -> tuple[Units, Net, np.ndarray, DataFrame, DataFrame, int, int]:
    """From the column ``text``: units, net, log10 of rest(g), tables ``w, c`` and ``w, before`` of tokens outside the shortlist, N and V.

    ``before`` maps contexts g to the first term of the memory.
    """
    spark = texts.sparkSession
    sc = spark.sparkContext
    texts = texts.select("text")
    counts = texts.mapInArrow(_counted, "w long, last int, n long").groupBy("w").agg(F.sum("n").alias("c"), F.max("last").alias("last"))
    counts = stored(counts, "lm-counts")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    n, v = total["n"] or 0, total["v"]
    # the least count of the shortlist, from a histogram of eight steps to each doubling
    histogram = counts.groupBy(F.floor(F.log2("c") * 8).cast("long").alias("k")).agg(F.count("*").alias("n")).collect()
    least, room = 2**62, SHORTLIST
    for r in sorted(histogram, key=lambda r: -r["k"]):
        room -= r["n"]
        if room < 0:
            break
        least = int(np.ceil(2 ** (r["k"] / 8) - 1e-9))
    shortlisted = (F.col("c") >= max(least, 3)) | (F.col("w") == END)
    hashes, seen = _arrays(counts.where(shortlisted).select("w", "c"))
    if not len(hashes):
        hashes, seen = np.array([END], "<i8"), np.zeros(1, "<i8")
    buckets = 1 << int(np.clip(np.round(np.log2(max(v, 1)) / 2), 4, np.log2(BUCKETS)))
    per_bucket = counts.where(~shortlisted).groupBy(F.col("last").bitwiseAND(F.lit(buckets - 1)).cast("long").alias("b")).agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    own, sums, kinds = _arrays(per_bucket)
    totals, types = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    totals[own], types[own] = sums, kinds
    discount = min(max(total["n1"] / max(total["n1"] + 2 * total["n2"], 1), 0.1), 0.95)
    memory = 1 << int(np.clip(np.ceil(np.log2(max(n, 1) / 128)), 6, np.log2(MEMORY)))
    units = units_of(hashes.view(np.uint64), seen, totals, types, discount, memory)
    sent = sc.broadcast(units)
    # the net: parts of the corpus, each large enough to learn from
    parts = texts.coalesce(max(1, n // PART))
    pieces = parts.mapInArrow(_trained(sent, STEPS), _PIECE).repartition(_SLICES, "kind", "slice").mapInArrow(_averaged, _PIECE)
    got = {(r["kind"], r["slice"]): r["content"] for r in pieces.select("kind", "slice", "content").collect()}
    net, contexts = new_net(units), np.zeros(memory, np.int64)
    if got:
        joined = [b"".join(got.get((kind, k), b"") for k in range(_SLICES)) for kind in range(4)]
        out = np.frombuffer(joined[1], "<f4").reshape(-1, WIDTH + 1)
        net = Net(np.frombuffer(joined[0], "<f4").reshape(-1, WIDTH), np.frombuffer(joined[2], "<f4").reshape(-1, WIDTH), out[:, :WIDTH].copy(), out[:, WIDTH].copy(), net.classes, net.step)
        contexts = np.frombuffer(joined[3], "<i8")
    # the memory: counts of tokens outside the shortlist by what stands before them
    after = sc.broadcast(np.maximum(contexts, 1))
    each = texts.mapInArrow(_pairs(sent), "w long, g int, n long").groupBy("w", "g").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    repeated = stored(each.select("w", "g", (F.col("n") - 1).alias("m")), "lm-repeated")
    by_token = repeated.groupBy("w").agg(F.collect_list("g").alias("g"), F.collect_list("m").alias("m"))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A map of contexts to the counts over those of the contexts."""
        for batch in batches:
            g, m = (batch.column(k) for k in (1, 2))
            flat = g.flatten().to_numpy()
            entries = pa.MapArray.from_arrays(pa.array(np.append(0, np.cumsum(pc.list_value_length(g).to_numpy())), pa.int32()), pa.array(flat, pa.int32()), pa.array(m.flatten().to_numpy() / after.value[flat], pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), entries], ["w", "before"])

    table = by_token.mapInArrow(shares, "w long, before map<int,double>")
    taken = repeated.groupBy(F.col("g").cast("long").alias("g")).agg(F.sum("m").alias("m"))
    g, m = _arrays(taken)
    rest = np.ones(memory)
    rest[g] = 1 - m / np.maximum(contexts[g], 1)
    return units, net, np.log10(np.maximum(rest, 1e-12)), counts.where(~shortlisted).select("w", "c"), table, n, v


_ROW = "w long, rid long, x long, doc_id long, held int, n_tokens long, n_known long, base double, score double"


def _scored(units, net, rest, floor: float):
    """A row for each text with what its frequent tokens give, and one for each other token, which meets its counts in a join.

    ``x`` of a token holds its context g, its bucket, and log10 of rest(g) times the bucket's probability in 1/2**26.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model, left = units.value, net.value, rest.value
        start = len(known.mass)
        base = np.append(np.log10(known.counts + 0.1) - floor, 0.0)
        known_count = np.append((known.counts > 0).astype(np.int64), 0)
        for batch in batches:
            for a, b, r in reads(batch.column(3)):
                rid, ids, held = (batch.column(k).slice(a, b - a) for k in range(3))
                u, spot, bucket = known.of(r)
                g, ctx = memory_of(r, known.memory), contexts_of(u, r.at, start)
                log_p = model.log_probabilities(ctx, u) / np.log(10) + left[g]
                rare = np.flatnonzero(spot < 0)
                first = r.at[:-1]
                sums = [np.add.reduceat(x, first) for x in (np.where(spot < 0, 0.0, log_p), base[spot], known_count[spot])]
                rows = np.repeat(np.asarray(rid), np.diff(r.at))
                fine = np.minimum(np.round(-log_p[rare] * _FINE), 2**32 - 1).astype(np.int64)
                x = (g[rare] << 43) | (bucket[rare] << 32) | fine
                blank = pa.nulls(len(rare), pa.int64())
                # a text's own row meets no count; its key is its number, so it has a partition of its own
                texts = np.asarray(rid)
                own = S.mix(texts.astype(_U) + _U(2)).view(np.int64)
                columns = [
                    pa.array(np.concatenate([r.hashes[rare].view(np.int64), own])), pa.array(np.concatenate([rows[rare], texts])), pa.array(np.concatenate([x, np.full(b - a, -1)])),
                    pa.concat_arrays([blank, ids]), pa.concat_arrays([blank.cast(pa.int32()), held]), pa.concat_arrays([blank, pa.array(np.diff(r.at))]), pa.concat_arrays([blank, pa.array(sums[2])]),
                    pa.concat_arrays([blank.cast(pa.float64()), pa.array(sums[1])]), pa.concat_arrays([blank.cast(pa.float64()), pa.array(sums[0])]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ROW.split(", ")])

    return over


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Scores of all texts by a model of those whose id's checksum is not 0 modulo ``folds``."""
    spark = docs.sparkSession
    ship(spark)
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("held", held)
    units, net, rest, rarer, table, n, v = fit(rows.where("held = 0"))
    floor = float(np.log10(n + 0.1 * (v + 1)))
    sc = spark.sparkContext
    apart = rows.withColumn("rid", F.monotonically_increasing_id()).select("rid", "doc_id", "held", "text")
    parts = apart.mapInArrow(_scored(sc.broadcast(units), sc.broadcast(net), sc.broadcast(rest), floor), _ROW)
    each = parts.join(rarer.hint("shuffle_hash"), "w", "left").join(table.hint("shuffle_hash"), "w", "left")
    token, x = F.col("x") >= 0, F.col("x")
    g = F.shiftright(x, 43).cast("int")
    bucket = F.shiftright(x, 32).bitwiseAND(F.lit(BUCKETS - 1)).cast("int") + 1

    def by_bucket(values: np.ndarray):
        return F.element_at(F.array(*[F.lit(float(y)) for y in values]), bucket)

    size, d = np.maximum(units.totals, 1), units.discount
    share = F.when(F.col("c").isNotNull(), (F.col("c") - d) * by_bucket(1 / size)).otherwise(by_bucket(np.where(units.totals > 0, d * units.types / size, 1.0)))
    net_p = F.pow(F.lit(10.0), -x.bitwiseAND(F.lit(2**32 - 1)) / _FINE) * share
    score = F.when(token, F.log10(F.coalesce(F.try_element_at("before", g), F.lit(0.0)) + net_p)).otherwise(F.col("score"))
    base = F.when(token, F.log10(F.coalesce("c", F.lit(0)) + 0.1) - floor).otherwise(F.col("base"))
    known = F.when(token, F.col("c").isNotNull().cast("long")).otherwise(F.col("n_known"))
    return each.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), (F.max("held") == 1).alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum(known).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), F.sum(base).alias("base_score"), F.sum(score).alias("score"),
    ).drop("rid")
