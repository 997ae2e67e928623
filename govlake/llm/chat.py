"""Conversations as one training text each, with a loss mask, from typed content parts.

A turn is `### role: ` + content + ` </turn>` + line feed. Control strings inside contents are
escaped with a backslash, and backslashes with another, so every text comes back whole. A visitor
flattens the parts of a turn in order: text as it is, an image, an audio clip or a document as a
numbered placeholder `<|kind:n|>` with an attachment record and the tokens it expands to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions, text_of

OPEN, CLOSE, PLACE = "###", "</turn>", "<|"
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.S)
#: Not part of any escaped text: there a backslash, not a blank, stands in front of the mark.
_TAIL = f" {CLOSE}\n"
_ESCAPED = re.compile(r"\\(.)", re.S)
#: A row of formatted text is closed at so many characters, at the end of a turn.
ROW = 2_000_000
#: Tokens of an attachment: an image by 14-pixel patches, audio by seconds, a document by pages.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 600

PARTS = "array<struct<type:string,text:string,uri:string,width:long,height:long,seconds:double,pages:long>>"
FORMATTED = ("conv_id long, piece long, formatted string, loss array<struct<start:long,stop:long>>, "
             "attachments array<struct<number:long,kind:string,uri:string,tokens:long>>")


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in (OPEN, CLOSE, PLACE):
        text = text.replace(control, "\\" + control)
    return text


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Visitor:
    """Flattens the parts of the turns of one conversation; numbers its attachments."""

    def __init__(self) -> None:
        self.count = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> str:
        known = getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_unknown)
        return known(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict) -> str:
        across, down = (-(-(part.get(side) or 0) // PATCH) for side in ("width", "height"))
        return self.attach("image", part, max(1, across * down))

    def visit_audio(self, part: dict) -> str:
        return self.attach("audio", part, max(1, round((part.get("seconds") or 0) * AUDIO_RATE)))

    def visit_document(self, part: dict) -> str:
        return self.attach("document", part, max(1, (part.get("pages") or 0) * PAGE_TOKENS))

    def visit_unknown(self, part: dict) -> str:
        return self.attach("other", part, 1)

    def attach(self, kind: str, part: dict, tokens: int) -> str:
        self.attachments.append({"number": self.count, "kind": kind, "uri": part.get("uri"), "tokens": tokens})
        self.count += 1
        return f"<|{kind}:{self.count - 1}|>"


def _formatted(trained: tuple[str, ...]):
    names = ["conv_id", "piece", "formatted", "loss", "attachments"]
    kinds = [pa.int64(), pa.int64(), pa.string(),
             pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
             pa.list_(pa.struct([("number", pa.int64()), ("kind", pa.string()), ("uri", pa.string()),
                                 ("tokens", pa.int64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = run  # no conversation yet
        piece, size, text, loss = 0, 0, [], []
        visitor = Visitor()
        ready: list[tuple] = []

        def close() -> None:
            nonlocal piece, size, text, loss
            if text:
                ready.append((now, piece, "".join(text), loss, visitor.attachments))
                piece, size, text, loss = piece + 1, 0, [], []
                visitor.attachments = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*ready, strict=True), kinds, strict=True)], names)
            ready.clear()
            return out

        waiting = 0
        for rows in batches:
            for conv, role, parts in zip(rows.column("conv_id").to_pylist(), rows.column("role"),
                                         rows.column("parts"), strict=True):
                if conv != now or now is run:
                    close()
                    now, piece, visitor = conv, 0, Visitor()
                role = role.as_py()
                head = f"{OPEN} {escape_role(role)}: "
                body = "".join(map(visitor.visit, parts.as_py() or []))
                turn = f"{head}{body} {CLOSE}\n"
                if role in trained:
                    loss.append({"start": size + len(head), "stop": size + len(head) + len(body)})
                text.append(turn)
                size += len(turn)
                waiting += len(turn)
                if size >= ROW:
                    close()
                if waiting >= 4 * ROW and ready:
                    yield batch()
                    waiting = 0
        close()
        if ready:
            yield batch()

    return run


def format_turns(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Formatted conversations: conv_id, piece, formatted, loss (spans of code points under the loss
    mask), attachments. `turns` has conv_id, turn, role and text or parts (see PARTS).

    Turns go by turn (null first), equal ones by role and text; repeated rows are turns of their
    own. Null roles and texts are empty; rows without conv_id are one conversation. A conversation
    over ROW characters goes on in a further row, in order within its partition, so a task holds a
    few of those at most whatever a conversation's length. Other columns are not read.
    """
    parts = F.col("parts") if "parts" in turns.columns else F.array(
        F.struct(F.lit("text").alias("type"), text_of().alias("text"), F.lit(None).cast("string").alias("uri"),
                 F.lit(None).cast("long").alias("width"), F.lit(None).cast("long").alias("height"),
                 F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("long").alias("pages")))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.cast(PARTS).alias("parts"))
    dealt = (rows.repartition(partitions(turns.sparkSession), "conv_id")
             .sortWithinPartitions("conv_id", "turn", "role", "parts").select("conv_id", "role", "parts"))
    return dealt.mapInArrow(_formatted(trained), FORMATTED)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, stop) of each turn, texts unescaped; placeholders stay."""
    at = 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        stop = formatted.find(_TAIL, head.end()) if head else -1
        if stop < 0:
            raise ValueError(f"not a formatted turn at character {at}")
        yield unescape(head[1]), unescape(formatted[head.end():stop]), head.end(), stop
        at = stop + len(_TAIL)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now: dict | None = None
    for rows in batches:
        done = []
        for conv, text, loss in zip(rows.column("conv_id").to_pylist(), rows.column("formatted"),
                                    rows.column("loss"), strict=True):
            if now is None or now["conv"] != conv:
                if now:
                    done.append(now)
                now = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0,
                       "loss": hashlib.sha256(), "size": 0}
            text = text.as_py()
            now["size"] += len(text)
            for role, said, _, _ in parse(text):
                now["turns"] += 1
                now["all"].update(f"{role}\n{said}\n".encode())
            for span in loss.as_py():
                said = unescape(text[span["start"]:span["stop"]])
                now["chars"] += len(said)
                now["loss"].update(said.encode())
        if done:
            yield _digest_rows(done, names, kinds)
    if now:
        yield _digest_rows([now], names, kinds)


def _digest_rows(done: list[dict], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*((d["conv"], d["turns"], d["all"].hexdigest(), d["chars"], d["loss"].hexdigest(), d["size"])
                    for d in done), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted texts hold, one row per conversation: conv_id, n_turns, turns_sha256 (of
    role, line feed, text, line feed per turn), loss_chars and loss_sha256 (of the unescaped text
    under the mask), formatted_chars. Takes the rows of `format_turns` in any order, also stored and read
    again in other partitions: pieces are put in order here."""
    ordered = (formatted.repartition(partitions(formatted.sparkSession), "conv_id")
               .sortWithinPartitions("conv_id", "piece"))
    return ordered.mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                  "formatted_chars long")
