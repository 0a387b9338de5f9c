"""Quality rules: base counts, and a linear-chain CRF over the lines of each document.

Every line is described by binary features; a conditional random field with two labels
(boilerplate, content) and weights on features and on neighbouring labels is trained on a
bounded sample of labelled documents, and Viterbi decoding labels the lines of every
document. The share of words in content lines decides whether a document is kept.

Labels are known of documents, not of lines. Lines begin with their document's label; where
labels change is taught by splices, the end of a good document before the start of a bad one or
the other way round; and lines that the first model takes for the other kind than most of their
document change their label before the model is trained again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: labelled documents per class the model is fitted on, chosen by the hash of their id
SAMPLE_DOCS = 1500
#: lines of the sampled documents of a class, together; documents are sampled whole or not at
#: all, and one with more than a tenth of this is not sampled
SAMPLE_LINES = 100_000
#: lines of a training sequence, and of either side of a splice
PIECE, SPLICE = 512, 48
#: a document is kept if at least this share of its words stands in content lines
MIN_CONTENT = 0.5
EPOCHS, AGAIN, RATE, RIDGE = 150, 60, 0.15, 0.01

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = "#*$%&|<>"
_LETTER = re.compile(r"[^\W\d_]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARK = re.compile(r"[#*$%&|<>{}\[\]=~^\\/@_]")
_NOTICE = re.compile(r"(?i)copyright|licen[sc]e|rights reserved|cookie|privacy|terms of|subscribe|click here|log ?in|sign up")
FEATURES = (
    "always", "few_words", "some_words", "many_words", "shouting", "exclaims", "bars", "some_marks",
    "many_marks", "repeats", "stutters", "ends_sentence", "digits", "long_words", "notice", "no_letters",
)


def repeated_words(words: list) -> int:
    """How many words stand in a window of three that is found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    if not again.any():
        return 0
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= again
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = text.encode().split()
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            again += line in seen
            seen.add(line)
    return (
        len(words), len(b"".join(words).decode()), sum(map(text.count, _SYMBOLS)), again, repeated_words(words),
    )


def described(text: str | None) -> tuple[list[tuple], list[int]]:
    """Features and number of words of each line with a word."""
    rows, sizes, seen = [], [], set()
    for line in (text or "").split("\n"):
        words = line.encode().split()
        n = len(words)
        if not n:
            continue
        letters = len(_LETTER.findall(line))
        chars = len(line)
        marks = len(_MARK.findall(line)) / n
        rows.append((
            1, n < 4, 4 <= n < 12, n >= 40, len(_UPPER.findall(line)) > 0.6 * max(letters, 1),
            line.count("!") > 0.3 * n, line.count("|") > 0.2 * n, 0.1 < marks <= 0.5, marks > 0.5,
            line in seen, n > 5 and len(set(words)) < 0.45 * n, line.rstrip()[-1:] in ".!?…",
            sum(map(line.count, "0123456789")) > 0.2 * chars, letters > 12 * n,
            bool(_NOTICE.search(line)), letters < 0.4 * chars,
        ))
        sizes.append(n)
        seen.add(line)
    return rows, sizes


@dataclass
class Field:
    """A conditional random field; label 1 is content. Zero weights call everything content."""

    emit: np.ndarray  # (2, features)
    move: np.ndarray  # (2, 2): from, to
    start: np.ndarray  # (2,)

    @classmethod
    def blank(cls) -> "Field":
        return cls(np.zeros((2, len(FEATURES))), np.zeros((2, 2)), np.zeros(2))


def viterbi(model: Field, scores: np.ndarray) -> list[int]:
    """The best label sequence for lines with these emission scores; ties go to content."""
    if not len(scores):
        return []
    (m00, m01), (m10, m11) = model.move.tolist()
    rows = scores.tolist()
    a, b = rows[0][0] + model.start[0], rows[0][1] + model.start[1]
    back = []
    for s0, s1 in rows[1:]:
        to0, to1 = b + m10 >= a + m00, b + m11 >= a + m01
        back.append((to0, to1))
        a, b = (b + m10 if to0 else a + m00) + s0, (b + m11 if to1 else a + m01) + s1
    out = [int(b >= a)]
    for step in reversed(back):
        out.append(int(step[out[-1]]))
    return out[::-1]


def train(docs: list[tuple[np.ndarray, np.ndarray]], model: Field | None = None, epochs: int = EPOCHS) -> Field:
    """Maximum likelihood by gradient steps (Adam) with forward-backward over padded sequences.

    A sequence is the features of its lines and the label of each.
    """
    model = model or Field.blank()
    docs = [(x[at:at + PIECE], y[at:at + PIECE]) for x, y in docs for at in range(0, len(x), PIECE)]
    if not docs:
        return model
    docs = sorted(docs, key=lambda d: len(d[0]))
    groups = []
    for at in range(0, len(docs), 256):
        part = docs[at:at + 256]
        longest = max(len(x) for x, _ in part)
        x = np.zeros((len(part), longest, len(FEATURES)))
        real = np.zeros((len(part), longest), bool)
        y = np.zeros((len(part), longest), int)
        for i, (rows, labels) in enumerate(part):
            x[i, : len(rows)], real[i, : len(rows)], y[i, : len(rows)] = rows, True, labels
        groups.append((x, real, y))
    shape = [model.emit.shape, model.move.shape, model.start.shape]
    theta = np.concatenate([model.emit.ravel(), model.move.ravel(), model.start.ravel()])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    lines = sum(real.sum() for _, real, _ in groups)

    def unpack(v: np.ndarray) -> Field:
        cut = np.cumsum([int(np.prod(s)) for s in shape])[:-1]
        return Field(*(p.reshape(s) for p, s in zip(np.split(v, cut), shape)))

    for epoch in range(1, epochs + 1):
        model = unpack(theta)
        parts = [np.zeros(s) for s in shape]
        for group in groups:
            for total, g in zip(parts, _gradient(model, *group)):
                total += g
        grad = np.concatenate([p.ravel() for p in parts]) / lines - RIDGE * theta
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        theta = theta + RATE * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.999**epoch)) + 1e-8)
    return unpack(theta)


def _gradient(model: Field, x: np.ndarray, real: np.ndarray, y: np.ndarray):
    """Observed minus expected counts of features, moves and starts; y: labels of lines, or one a row."""
    n, longest, _ = x.shape
    y = np.broadcast_to(y if y.ndim == 2 else y[:, None], (n, longest))
    score = x @ model.emit.T
    fwd = np.zeros((n, longest, 2))
    bwd = np.zeros((n, longest, 2))
    fwd[:, 0] = score[:, 0] + model.start
    for t in range(1, longest):
        step = np.logaddexp(fwd[:, t - 1, :1] + model.move[0], fwd[:, t - 1, 1:] + model.move[1]) + score[:, t]
        fwd[:, t] = np.where(real[:, t, None], step, fwd[:, t - 1])
    for t in range(longest - 2, -1, -1):
        ahead = score[:, t + 1] + bwd[:, t + 1]
        step = np.logaddexp(model.move[:, 0] + ahead[:, :1], model.move[:, 1] + ahead[:, 1:])
        bwd[:, t] = np.where(real[:, t + 1, None], step, bwd[:, t])
    norm = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
    node = np.exp(fwd + bwd - norm[:, None, None]) * real[:, :, None]
    truth = (y[:, :, None] == np.arange(2)) * real[:, :, None]
    gap = truth - node
    move = np.zeros((2, 2))
    both = real[:, 1:]
    for i in (0, 1):
        for j in (0, 1):
            pair = np.exp(fwd[:, :-1, i] + model.move[i, j] + score[:, 1:, j] + bwd[:, 1:, j] - norm[:, None])
            seen = (y[:, :-1] == i) & (y[:, 1:] == j)
            move[i, j] = ((seen - pair) * both).sum()
    return np.einsum("ntk,ntf->kf", gap, x), move, gap[:, 0].sum(axis=0)


def splices(good: list[np.ndarray], bad: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ends of documents of one class before starts of the other, in either order by turns."""
    out = []
    for i, (g, b) in enumerate(zip(good, bad)):
        sides = ((g, 1), (b, 0)) if i % 2 else ((b, 0), (g, 1))
        (x, p), (y, q) = sides
        x, y = x[-SPLICE:], y[:SPLICE]
        out.append((np.concatenate([x, y]), np.repeat([p, q], [len(x), len(y)])))
    return out


def learned(good: list[np.ndarray], bad: list[np.ndarray]) -> Field:
    """The field of two classes of documents, each the features of its lines."""
    whole = [(x, np.full(len(x), q)) for q, part in ((1, good), (0, bad)) for x in part]
    mixed = splices(good, bad)
    model = train(whole + mixed)
    if not (good and bad):
        return model
    relabelled = []
    for x, y in whole:
        found = np.array(viterbi(model, x @ model.emit.T))
        relabelled.append((x, found if 2 * (found == y).sum() > len(y) else y))
    return train(relabelled + mixed, model, AGAIN)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, lines: int = SAMPLE_LINES) -> Field:
    """The field fitted on at most ``sample`` labelled documents and ``lines`` lines per class."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64(F.lit(1), "doc_id")
    ids = None
    for q in (0, 1):
        part = known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(sample)
        ids = part if ids is None else ids.unionByName(part)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("quality", "text", F.xxhash64("text").alias("h"), "doc_id")
    longest = lines // 10

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = (described(t)[0] for t in b.column("text").to_pylist())
            x = [np.array(r if len(r) <= longest else [], np.uint8).tobytes() for r in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("h"), b.column("quality").cast(pa.int32()), pa.array(x, pa.binary())],
                ["doc_id", "h", "quality", "x"],
            )

    # repeated rows of a sampled id count once, so the sample stays bounded
    once = rows.mapInArrow(each, "doc_id long, h long, quality int, x binary").groupBy("doc_id").agg(
        F.min(F.struct("h", "quality", "x")).alias("r")
    ).select("doc_id", "r.quality", "r.x")
    so_far = Window.partitionBy("quality").orderBy(order, "doc_id")
    within = once.withColumn("upto", F.sum(F.length("x")).over(so_far)).where(
        F.col("upto") <= lines * len(FEATURES)
    )
    classes: tuple[list, list] = ([], [])
    for r in within.orderBy(order, "doc_id").select("quality", "x").collect():
        x = np.frombuffer(r["x"], np.uint8).reshape(-1, len(FEATURES)).astype(float)
        if len(x):
            classes[r["quality"]].append(x)
    return learned(classes[1], classes[0])


REPORT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)


def judged(model: Field, texts: list[str | None]) -> list[tuple]:
    """Base counts, verdicts and content share of each text."""
    lines = [described(t) for t in texts]
    rows = [r for of, _ in lines for r in of]
    scores = np.array(rows, float).reshape(-1, len(FEATURES)) @ model.emit.T
    out, at = [], 0
    for text, (of, sizes) in zip(texts, lines):
        labels = viterbi(model, scores[at:at + len(of)])
        at += len(of)
        counts = base_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        share = sum(s for s, y in zip(sizes, labels) if y) / counts[0] if counts[0] else 0.0
        out.append((*counts, failed, not failed and share >= MIN_CONTENT, share))
    return out


def judge(docs: DataFrame, model: Field) -> DataFrame:
    """docs with the columns of REPORT, one row per row, map side only.

    A null or empty text has no words and fails the base rules; content_share is 0 there.
    Columns of docs that have a name of REPORT must be renamed before.
    """
    names = [p.split()[0] for p in REPORT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
    schema = docs.select("*", *[F.lit(None).cast(p.split()[1]).alias(p.split()[0]) for p in REPORT.split(", ")]).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(zip(*judged(model, b.column("text").to_pylist()))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *(pa.array(c, k) for c, k in zip(found, kinds))], [*b.schema.names, *names]
            )

    return docs.mapInArrow(each, schema)


def kept_documents(docs: DataFrame, model: Field) -> DataFrame:
    """The documents the rules keep, with their own columns, whatever their names."""
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return judge(packed, model).where("kept").select("_row.*")
