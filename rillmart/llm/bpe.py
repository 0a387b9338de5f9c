"""Byte-pair encoding by backtracking over longest matches, decoding by an offset table.

An Aho-Corasick automaton over the vocabulary finds, for every position of a word, the
longest token that starts there. Tokens are taken longest first; two neighbours may stand
together only if merging would not have crossed their border, which a table of compatible
pairs answers (filled as pairs occur). If no shorter token fits, the last token is taken back
and the position it began to fail at is marked. Every position fails at most once, so the
result, which equals that of applying the merges in order, takes linear time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: how the byte-level vocabulary cuts a text into words (fixed by the vocabulary), with
#: white space by its Unicode property
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: words kept with their tokens, and pairs kept with their verdict, per task
CACHED_WORDS, CACHED_PAIRS, CACHED_LENGTH = 200_000, 1_000_000, 48
#: characters of a text that are encoded at once; cuts fall where no word can cross
CHUNK = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, as letter -> byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary, given as the text of its JSON file."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = {
            i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self.special
        }
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        #: (left, right) -> place of the merge; token -> place of the merge that makes it, -1 for bytes
        self.merge, self.made, self.parts = {}, {i: -1 for i in as_bytes}, {}
        for place, (a, b) in enumerate(merges):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merge[left, right] = place
            if whole not in self.parts:
                self.made[whole], self.parts[whole] = place, (left, right)
        self.size = {i: len(b) for i, b in as_bytes.items()}
        self.by_bytes = {b: i for i, b in as_bytes.items()}
        self.shorter = {i: self._shorter(b) for i, b in as_bytes.items()}
        self.automaton = ahocorasick.Automaton()
        for i, b in as_bytes.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        table = {**as_bytes, **{i: t.encode() for t, i in self.special.items()}}
        ordered = [table.get(i, b"") for i in range(max(table) + 1)]
        self.offsets = np.concatenate(([0], np.cumsum([len(b) for b in ordered])))
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.cut = regex.compile(PATTERN)
        self.cut_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special else None
        )

    def _shorter(self, b: bytes) -> int | None:
        """The longest token that is a proper prefix."""
        return next((self.by_bytes[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.by_bytes), None)

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of the two tokens gives just these two.

        Undoes the later of the two tokens' last merges, again and again, and looks whether
        what then touches at the border would have merged before it; of equal merges the one
        further left goes first.
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        limit = len(self.merge)
        while True:
            if self.merge.get((a, b), limit) < limit:
                return False
            at_a, at_b = self.made[a], self.made[b]
            if at_a > at_b:
                limit, a = at_a, self.parts[a][1]
            elif at_b < 0:
                return True
            else:
                limit, b = at_b + 1, self.parts[b][0]

    def word(self, data: bytes) -> tuple[int, ...]:
        """The tokens of one word."""
        longest: list[int | None] = [None] * len(data)
        for end, (token, size) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = token  # later matches from a place are longer
        size, shorter, compatible = self.size, self.shorter, self.compatible
        out: list[int] = []
        dead = bytearray(len(data) + 1)
        at, token = 0, longest[0]
        while at < len(data):
            last = out[-1] if out else None
            while token is not None and (
                dead[at + size[token]] or (last is not None and not compatible(last, token))
            ):
                token = shorter[token]
            if token is not None:
                out.append(token)
                at += size[token]
                token = longest[at] if at < len(data) else None
            else:
                dead[at] = 1
                if last is None:
                    raise ValueError("the vocabulary cannot spell this word")
                out.pop()
                at -= size[last]
                token = last
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Token ids of a whole text; a null or empty text has none."""
        out: list[int] = []
        parts = self.cut_special.split(text or "") if self.cut_special else [text or ""]
        words = self.words
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
                continue
            for w in self.cut.findall(part):
                ids = words.get(w)
                if ids is None:
                    ids = self.word(w.encode())
                    if len(w) <= CACHED_LENGTH:
                        if len(words) >= CACHED_WORDS:
                            words.clear()
                        words[w] = ids
                out.extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """Bytes of all tokens by their offsets in one table, read as UTF-8."""
        ids = np.asarray(ids, np.int64)
        pieces = []
        for at in range(0, len(ids), CHUNK):
            part = ids[at:at + CHUNK]
            start, n = self.offsets[part], self.offsets[part + 1] - self.offsets[part]
            shift = np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            pieces.append(self.bytes[shift + np.arange(len(shift))].tobytes())
        return b"".join(pieces).decode("utf-8", errors="replace")


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoded(docs: DataFrame, vocabulary: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, token_ids of every document.

    ``vocabulary`` is the text of a byte-level vocabulary file; it travels to the tasks as one
    broadcast of fixed size. A null or empty text has no tokens. One row per row, repeated ones
    too; other columns of docs are not read. Map side only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for b in batches:
            ids = [codec.encode(t) for t in b.column("text").to_pylist()]
            columns = [
                b.column("doc_id").cast(pa.int64()),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([_digest(",".join(map(str, i))) for i in ids], pa.string()),
                pa.array([_digest(codec.decode(i)) for i in ids], pa.string()),
            ]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names + ["token_ids"] * keep_ids)

    return docs.select("doc_id", "text").mapInArrow(each, schema + ", token_ids array<int>" * keep_ids)


def decoded(rows: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of rows with doc_id and token_ids; null ids give a null text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for b in batches:
            texts = [None if i is None else codec.decode(i) for i in b.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "token_ids").mapInArrow(each, "doc_id long, text string")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
