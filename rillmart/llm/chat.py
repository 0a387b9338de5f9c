"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are its context, and
only its reply is trainable. A turn reads ``<turn ROLE>\\nTEXT</turn>\\n``; wherever a text
(or role) holds one of the control strings, or a backslash, a backslash goes in front, so the
template can be read back without loss.

Turns are sorted by Spark (which spills) and stream through a task one conversation after the
other; a task holds the formatted turns of one conversation, which its longest example holds
anyhow.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

TRAINED = "assistant"
_ESCAPE_TEXT = re.compile(r"\\|<(?=/?turn)")
_ESCAPE_ROLE = re.compile(r"[\\<>]")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.|<(?!/?turn))*)</turn>\n", re.S)
#: characters of examples gathered before they are handed on
FLUSH = 1 << 22


def escaped(text: str, pattern: re.Pattern = _ESCAPE_TEXT) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def turn(role: str, text: str) -> tuple[str, int]:
    """A formatted turn, and where its text begins in it."""
    head = f"<turn {escaped(role, _ESCAPE_ROLE)}>\n"
    return f"{head}{escaped(text)}</turn>\n", len(head)


def turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, as (role, text)."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn begins at {at}")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return out


EXAMPLE = "conv_id long, example int, n_context int, formatted string, loss_start int, loss_end int"
_NAMES = [p.split()[0] for p in EXAMPLE.split(", ")]
_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.large_string(), pa.int32(), pa.int32()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0
    now, parts, size, example, done = object(), [], 0, 0, True

    def rest() -> None:
        if not done:
            rows.append((now, example, len(parts), "".join(parts), None, None))

    for b in batches:
        for conv, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if conv != now:
                rest()
                now, parts, size, example, done = conv, [], 0, 0, True
            shown, begin = turn(role or "", text or "")
            parts.append(shown)
            done = role == TRAINED
            if done:
                whole = "".join(parts)
                end = len(whole) - len("</turn>\n")
                rows.append((now, example, len(parts) - 1, whole, size + begin, end))
                example += 1
                held += len(whole)
            size += len(shown)
            if held > FLUSH:
                yield _batch(rows)
                rows, held = [], 0
    rest()
    yield _batch(rows)


def examples(turns_of: DataFrame) -> DataFrame:
    """The training examples of all conversations: columns of EXAMPLE.

    Code points ``loss_start`` up to ``loss_end`` of ``formatted`` are the trainable reply. A
    conversation that does not end with a reply gets one more row, without a trainable part,
    that holds all its turns, so nothing of the input is missing from the output.

    Turns go by turn number (null first), then role, then text; repeated rows are turns of
    their own. Null texts and roles are empty; rows without conv_id are one conversation. An
    empty table gives no rows; other columns are not read. A conversation's rows come out
    next to each other in order.
    """
    return (
        turns_of.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(_expand, EXAMPLE)
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    now, last, chars, formatted, digest = object(), None, 0, 0, hashlib.sha256()

    def close() -> None:
        if last is not None:
            seen = turns(last)
            text = "".join(f"{r}\n{t}\n" for r, t in seen)
            out.append((now, len(seen), hashlib.sha256(text.encode()).hexdigest(), chars, digest.hexdigest(), formatted))

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for b in batches:
        for conv, whole, start, end in zip(
            *(b.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_start", "loss_end"))
        ):
            if conv != now:
                close()
                now, chars, formatted, digest = conv, 0, 0, hashlib.sha256()
            last = whole
            formatted += len(whole)
            if start is not None:
                reply = unescaped(whole[start:end])
                chars += len(reply)
                digest.update(reply.encode())
        yield batch()
        out.clear()
    close()
    yield batch()


def digests(of: DataFrame) -> DataFrame:
    """What is read back from examples, per conversation; map side only.

    Expects a conversation's examples next to each other and in order, as ``examples`` leaves
    them, and reads all turns from the longest, its last.
    """
    return of.mapInArrow(
        _read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
