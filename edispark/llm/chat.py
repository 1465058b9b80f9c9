"""Chat formatting of typed content parts.

A turn's content is a list of parts. A visitor flattens them in order: text parts give their text,
image, audio and document parts an ordered placeholder, an attachment reference and the number of
tokens the placeholder stands for. The template marks turns; control strings inside texts are
escaped reversibly.

Every turn is formatted on its own (``formatted_turns``), so a conversation of any length is spread
over tasks; a conversation's text is its segments in order of ``turn_no``. ``read_back`` parses segments
again, streaming over each partition, with a running digest as its only state for a conversation.

Escape: in a control string of a text, one backslash more goes after its first character, whatever
number stands there already; unescaping takes one away. No control string holds another's first
character behind its own first, so the matches never overlap.

Defined cases: a null text is empty; a null role is an empty role; turns go by ``turn`` (null first),
then role and text, so equal rows are told apart only by place; a null conversation id is a
conversation of its own; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edispark.shipping import ship

OPEN, SHUT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that mean something in this or a common template.
CONTROLS = (
    OPEN, SHUT, END, "<|image|>", "<|audio|>", "<|document|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "<unk>",
)
# "<<SYS>>" would hold its own first character again; its inner "<SYS>" alone is escaped
_HEADS = [(c[0], c[1:]) for c in (x.replace("<<", "<").replace(">>", ">") for x in CONTROLS)]
_ESCAPE = re.compile("|".join(rf"{re.escape(a)}\\*{re.escape(b)}" for a, b in _HEADS))
_UNESCAPE = re.compile("|".join(rf"{re.escape(a)}\\+{re.escape(b)}" for a, b in _HEADS))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


@dataclass(frozen=True)
class Part:
    """``kind`` is text, image, audio or document; ``amount`` is pixels wide and high, seconds, or pages."""

    kind: str
    text: str | None = None
    uri: str | None = None
    width: int = 0
    height: int = 0
    seconds: float = 0.0
    pages: int = 0


@dataclass
class Flattener:
    """Visits parts in order. ``text`` is escaped text with placeholders; ``spans`` are its text parts' places."""

    tile: int = 512
    tile_tokens: int = 170
    image_tokens: int = 85
    audio_tokens_per_second: float = 25.0
    page_tokens: int = 1000
    text: str = ""
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: Part) -> None:
        getattr(self, f"visit_{part.kind}", self.visit_other)(part)

    def visit_other(self, part: Part) -> None:
        """A kind without a rule of its own: its text if it has one, else a reference that keeps the kind's name."""
        if part.text:
            self.visit_text(part)
        else:
            self._attach(part, max(1, part.pages) * self.page_tokens)

    def visit_text(self, part: Part) -> None:
        start = len(self.text)
        self.text += escape(part.text or "")
        self.spans.append((start, len(self.text)))

    def _attach(self, part: Part, tokens: int) -> None:
        self.attachments.append({"kind": part.kind, "uri": part.uri, "place": len(self.text), "tokens": tokens})
        self.text += f"<|{part.kind}|>" if part.kind in ("image", "audio") else "<|document|>"

    def visit_image(self, part: Part) -> None:
        tiles = -(-max(part.width, 1) // self.tile) * -(-max(part.height, 1) // self.tile)
        self._attach(part, self.image_tokens + tiles * self.tile_tokens)

    def visit_audio(self, part: Part) -> None:
        self._attach(part, max(1, round(part.seconds * self.audio_tokens_per_second)))

    def visit_document(self, part: Part) -> None:
        self._attach(part, max(1, part.pages) * self.page_tokens)


PART_TYPE = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
SEGMENT_COLUMNS = ["conv_id", "turn", "role", "segment", "loss", "attachments", "expanded_tokens", "sort_text"]
SEGMENT_TYPE = (
    "conv_id long, turn long, role string, segment string, loss array<struct<start:int,stop:int>>, "
    "attachments array<struct<kind:string,uri:string,place:int,tokens:int>>, expanded_tokens long, sort_text string"
)


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    f = {"text": text}
    kinds = [("kind", "string"), ("text", "string"), ("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")]
    return F.array(F.struct(*[(F.lit("text") if n == "kind" else f.get(n, F.lit(None))).cast(t).alias(n) for n, t in kinds]))


def format_turn(role: str, parts: list[Part], trained: tuple[str, ...] = ("assistant",)) -> tuple[str, list[tuple[int, int]], list[dict]]:
    """Segment, loss spans in it and attachments. Only the text parts of trained roles are under the loss mask."""
    flat = Flattener()
    for part in parts:
        flat.visit(part)
    head = f"{OPEN}{escape(role)}{SHUT}"
    spans = [(len(head) + a, len(head) + b) for a, b in flat.spans] if role in trained else []
    attached = [a | {"place": a["place"] + len(head)} for a in flat.attachments]
    return head + flat.text + END, spans, attached


def formatted_turns(turns: DataFrame, parts: Column, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """A segment for each turn of ``turns`` (conv_id, turn, role) with content ``parts`` (``PART_TYPE``)."""
    ship(turns.sparkSession)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            # ids travel inside a struct, as pandas would turn nullable integers to floats
            for key, role, content in zip(pdf["key"], pdf["role"], pdf["parts"], strict=True):
                own = [Part(**{k: v for k, v in p.items() if v is not None}) for p in ([] if content is None else content)]
                segment, loss, attached = format_turn(role, own, trained)
                tokens = sum(a["tokens"] for a in attached)
                sort_text = "".join(p.text or "" for p in own)
                rows.append((key["conv_id"], key["turn"], role, segment, [{"start": a, "stop": b} for a, b in loss], attached, tokens, sort_text))
            yield pd.DataFrame(rows, columns=SEGMENT_COLUMNS).astype({"conv_id": "Int64", "turn": "Int64"})

    key = F.struct(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"))
    return turns.select(key.alias("key"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts")).mapInPandas(over, SEGMENT_TYPE)


_SEGMENT = re.compile(rf"{re.escape(OPEN)}(.*?){re.escape(SHUT)}(.*?){re.escape(END)}", re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation without attachments."""
    return [(unescape(m[1]), unescape(m[2])) for m in _SEGMENT.finditer(formatted)]


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation from its segments, in one pass over sorted partitions."""
    ship(segments.sparkSession)
    order = ["conv_id", "turn", "role", "sort_text"]
    df = segments.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "segment", "loss")

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None

        def done() -> dict:
            return {"conv_id": now[0], "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2], "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}

        def frame(rows: list[dict]) -> pd.DataFrame:
            return pd.DataFrame(rows).astype({"conv_id": "Int64"})

        for pdf in batches:
            out = []
            for conv, segment, loss in zip(pdf["conv_id"], pdf["segment"], pdf["loss"], strict=True):
                key = (None if pd.isna(conv) else int(conv),)
                if key != now:
                    if now is not None:
                        out.append(done())
                    now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(segment[span["start"] : span["stop"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(segment)
            if out:
                yield frame(out)
        if now is not None:
            yield frame([done()])

    return df.mapInPandas(over, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
