"""Personal data by candidate generation and gradient-boosted trees, in SQL functions only.

Base rules find e-mail addresses, IP addresses, payment cards and phone numbers; what they
accept is always redacted. High-recall generators propose more spans, which may overlap each
other and the base rules' rejected matches (a phone number that ran into the card number
behind it). Boosted trees score every candidate by its format and context, and a threshold
per kind, calibrated on held-out documents, decides which are redacted as well.

Training is distributed: candidates of all documents are counted by their (discrete) features
in one aggregation, and the driver boosts trees over these counts, whose number is bounded by
the ranges of the features, whatever the size of the corpus. The model is applied as nested
CASE expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")

#: the base rules; lookbehinds and possessive quantifiers only spare the regex engine
#: attempts that cannot succeed
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: the generators: looser forms, wherever they stand
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}(?: @ |@ | @| \[at\] |\(at\))[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: words in front of a span that speak of its kind, in five languages' common stems
HINTS = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|server|addr",
    "card": r"(?i)card|visa|pay|kart|carte|tarjeta",
    "phone": r"(?i)tel|phone|call|mobil|fax",
}
#: feature: largest value; all are whole numbers from 0
FEATURES = {
    "kind": 3, "digits": 20, "checks": 1, "plus": 1, "parens": 1, "separators": 3, "issuer": 1,
    "before": 2, "after": 2, "hint": 1, "secret": 1, "loose": 1,
}
ROUNDS, RATE, DEPTH = 24, 0.4, 3
#: the calibrated precision a threshold must reach on held-out candidates
PRECISION = 0.98
SPAN = "array<struct<s:int,e:int,m:string>>"


def spans(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches with start and end (exclusive) in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.arrays_zip(found.alias("m"), gaps.alias("g"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        end = start + F.length(x["m"])
        one = F.array(F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m")))
        return F.when(x["m"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["out"], one).alias("out"))
        )

    listed = F.aggregate(steps, empty, step, lambda state: state["out"])
    return F.when(text.rlike(pattern), listed).otherwise(F.array().cast(SPAN))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check-digit rule over a string of ASCII digits."""
    back = F.reverse(digits)
    doubled = F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(back, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, F.element_at(doubled, digit + 1)).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return (F.length(digits) > 0) & (total % 10 == 0)


def accepts(kind: str, m: Column) -> Column:
    """What the base rule of a kind asks of a match beyond its pattern."""
    n = F.length(_digits(m))
    if kind == "ip":
        parts = F.split(m, r"\.")
        return F.forall(parts, lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return n.between(12, 19) & luhn(_digits(m))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _class(c: Column) -> Column:
    """0: nothing or white space, 1: a letter or digit, 2: anything else."""
    return F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"[\p{L}\p{N}]"), 1).otherwise(2)


def _described(text: Column, kind: str, x: Column, loose: int) -> Column:
    """A candidate with its features."""
    m, digits = x["m"], _digits(x["m"])
    lead = F.substr(text, F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24)))
    lead = F.when(x["s"] > 0, lead).otherwise(F.lit(""))
    tail = F.substr(text, x["e"] + 1, F.lit(1))
    number = lambda c: c.cast("int")
    return F.struct(
        x["s"].alias("s"), x["e"].alias("e"),
        F.lit(KINDS.index(kind)).alias("kind"),
        F.least(F.length(digits), F.lit(20)).alias("digits"),
        number(accepts(kind, m)).alias("checks"),
        number(m.contains("+")).alias("plus"),
        number(m.contains("(")).alias("parens"),
        F.least(F.length(F.regexp_replace(m, r"[^\x20.-]", "")), F.lit(3)).alias("separators"),
        number(digits.rlike("^[3-6]")).alias("issuer"),
        _class(F.substr(lead, F.length(lead), F.lit(1))).alias("before"),
        _class(tail).alias("after"),
        number(lead.rlike(HINTS[kind])).alias("hint"),
        number(lead.rlike(r"[=\"']\s*$") | tail.isin("\"", "'")).alias("secret"),
        F.lit(loose).alias("loose"),
    )


def base_spans(text: Column) -> Column:
    """Spans the base rules accept: array of (s, kind, e), by start, then kind."""

    def of(k: int, kind: str) -> Column:
        good = F.filter(spans(text, BASE[kind]), lambda x: accepts(kind, x["m"]))
        return F.transform(good, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("kind"), x["e"].alias("e")))

    return F.sort_array(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)]))


def candidates(text: Column) -> Column:
    """Every proposed span, base and loose, with its features."""

    def of(kind: str, loose: int) -> Column:
        found = spans(text, (BASE, LOOSE)[loose][kind])
        return F.transform(found, lambda x: _described(text, kind, x, loose))

    return F.concat(*[of(kind, loose) for kind in KINDS for loose in (0, 1)])


# -- the model ---------------------------------------------------------------------


@dataclass
class Node:
    """A split on feature <= cut, or a leaf with a value."""

    value: float = 0.0
    feature: str | None = None
    cut: int = 0
    low: "Node | None" = None
    high: "Node | None" = None


@dataclass
class Model:
    bias: float = 0.0
    trees: list[Node] = field(default_factory=list)
    #: kind number: raw score from which a candidate is redacted
    thresholds: dict[int, float] = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum((_predict(t, x) for t in self.trees), np.zeros(len(x)))

    def score(self, c: Column) -> Column:
        """The raw score of a candidate as an SQL expression."""
        total = F.lit(self.bias)
        for tree in self.trees:
            total = total + _expression(tree, c)
        return total

    def selects(self, c: Column) -> Column:
        limit = F.lit(float("inf"))
        for k, t in self.thresholds.items():
            limit = F.when(c["kind"] == k, F.lit(t)).otherwise(limit)
        return self.score(c) >= limit


def _predict(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature is None:
        return np.full(len(x), node.value)
    low = x[:, list(FEATURES).index(node.feature)] <= node.cut
    return np.where(low, _predict(node.low, x), _predict(node.high, x))


def _expression(node: Node, c: Column) -> Column:
    if node.feature is None:
        return F.lit(node.value)
    return F.when(c[node.feature] <= node.cut, _expression(node.low, c)).otherwise(_expression(node.high, c))


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> Node:
    """A regression tree on gradients and curvatures, split where the gain is largest."""
    weight = lambda a, b: a * a / (b + 1.0)
    leaf = Node(value=float(-RATE * g.sum() / (h.sum() + 1.0)))
    best, whole = None, weight(g.sum(), h.sum())
    if depth:
        for j, (name, top) in enumerate(FEATURES.items()):
            by_g = np.bincount(x[:, j], weights=g, minlength=top + 1).cumsum()
            by_h = np.bincount(x[:, j], weights=h, minlength=top + 1).cumsum()
            for cut in range(top):
                gain = weight(by_g[cut], by_h[cut]) + weight(g.sum() - by_g[cut], h.sum() - by_h[cut]) - whole
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, name, j, cut)
    if best is None:
        return leaf
    low = x[:, best[2]] <= best[3]
    return Node(
        feature=best[1], cut=best[3],
        low=_grow(x[low], g[low], h[low], depth - 1),
        high=_grow(x[~low], g[~low], h[~low], depth - 1),
    )


def boost(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> Model:
    """Logistic boosting over weighted cells: ``good`` and ``bad`` count the examples of each."""
    model = Model(bias=float(np.log((good.sum() + 1) / (bad.sum() + 1))))
    raw = np.full(len(x), model.bias)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-raw))
        n = good + bad
        tree = _grow(x, n * p - good, n * p * (1 - p), DEPTH)
        model.trees.append(tree)
        raw = raw + _predict(tree, x)
    return model


def calibrate(model: Model, x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> None:
    """Per kind, the lowest score at and above which held-out precision holds; never below 0.

    A kind without held-out evidence takes nothing.
    """
    raw = model.raw(x)
    for k in range(len(KINDS)):
        of = x[:, 0] == k
        order = np.argsort(-raw[of], kind="stable")
        score, hit, miss = raw[of][order], good[of][order].cumsum(), bad[of][order].cumsum()
        ok = (hit >= PRECISION * (hit + miss)) & (hit > 0) & (score > 0)
        # a threshold lies between two scores: all candidates of one score go together
        last = np.append(score[1:] != score[:-1], True) if len(score) else ok
        at = np.flatnonzero(ok & last)
        if len(at):
            model.thresholds[k] = float(score[at[-1]])


def cells(docs: DataFrame) -> DataFrame:
    """Candidates of all documents counted by features, split in a training and a held-out half.

    Labels are silver: a candidate is good if the base rule of its kind accepts exactly its
    span, bad if it fails that kind's check or lies across an accepted span's edge. Others
    carry no label; they are what the model is for.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        (F.pmod(F.xxhash64(text), F.lit(2))).alias("held_out"),
        text.alias("text"),
    ).where(F.col("text").rlike("[0-9@]|(?:\\[at\\]|\\(at\\))"))
    rows = rows.select("held_out", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("found"))
    one = rows.select("held_out", "base", F.explode("found").alias("c"))
    same = F.exists("base", lambda b: (b["kind"] == F.col("c.kind")) & (b["s"] == F.col("c.s")) & (b["e"] == F.col("c.e")))
    across = F.exists(
        "base",
        lambda b: (b["kind"] == F.col("c.kind")) & (b["s"] < F.col("c.e")) & (F.col("c.s") < b["e"])
        & ((b["s"] > F.col("c.s")) | (b["e"] < F.col("c.e"))),
    )
    label = F.when(same, 1).when((F.col("c.checks") == 0) | across, 0)
    return (
        one.select("held_out", *[F.col(f"c.{f}").alias(f) for f in FEATURES], label.alias("label"))
        .where("label is not null")
        .groupBy("held_out", *FEATURES)
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
    )


def fit(docs: DataFrame) -> Model:
    """The model of these documents; one without candidates selects nothing."""
    rows = cells(docs).orderBy("held_out", *FEATURES).collect()
    parts = []
    for half in (0, 1):
        own = [r for r in rows if r["held_out"] == half]
        x = np.array([[r[f] for f in FEATURES] for r in own], dtype=np.int64).reshape(len(own), len(FEATURES))
        parts.append((x, *(np.array([r[c] for r in own], dtype=float) for c in ("good", "bad"))))
    if not len(parts[0][0]):
        return Model()
    model = boost(*parts[0])
    calibrate(model, *parts[1])
    return model


def selected(base: Column, found: Column, model: Model) -> Column:
    """Candidates the model adds: scored above their threshold, clear of base spans and of
    each other (of two that overlap, the better scored stays, then the longer, then the first)."""
    good = F.filter(
        found,
        lambda c: ~F.exists(base, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])) & model.selects(c),
    )
    ranked = F.transform(
        good,
        lambda c: F.struct(
            (-model.score(c)).alias("loss"), (c["s"] - c["e"]).alias("short"),
            c["s"].alias("s"), c["kind"].alias("kind"), c["e"].alias("e"),
        ),
    )
    none = F.array().cast("array<struct<s:int,kind:int,e:int>>")

    def take(out: Column, c: Column) -> Column:
        one = F.struct(c["s"].alias("s"), c["kind"].alias("kind"), c["e"].alias("e"))
        return F.when(
            F.exists(out, lambda o: (o["s"] < c["e"]) & (c["s"] < o["e"])), out
        ).otherwise(F.concat(out, F.array(one)))

    return F.when(F.size(good) > 0, F.aggregate(F.sort_array(ranked), none, take)).otherwise(none)


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans as one."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, x["s"] - state["at"])
        new = F.concat(state["out"], F.array(gap, F.element_at(tags, x["kind"] + 1)))
        return F.struct(
            F.greatest(state["at"], x["e"]).alias("at"),
            F.when(x["s"] >= state["at"], new).otherwise(state["out"]).alias("out"),
        )

    def end(state: Column) -> Column:
        rest = F.substr(text, state["at"] + 1, F.length(text))
        return F.array_join(F.concat(state["out"], F.array(rest)), "")

    return F.when(F.size(found) > 0, F.aggregate(found, begin, step, end)).otherwise(text)


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The columns of docs, and ``_pii``: (base spans, all spans), each by start, then kind.

    A null or empty text has no spans. Rows stay as they are, repeated ones too.
    """
    model = model or fit(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    any_sign = text.rlike("[0-9@]|(?:\\[at\\]|\\(at\\))")
    none = F.array().cast("array<struct<s:int,kind:int,e:int>>")
    base = F.when(any_sign, base_spans(text)).otherwise(none)
    step = docs.withColumn("_base", base)
    step = step.withColumn("_found", F.when(any_sign, candidates(text)))
    added = F.when(F.col("_found").isNotNull(), selected(F.col("_base"), F.col("_found"), model)).otherwise(none)
    step = step.withColumn("_all", F.sort_array(F.concat("_base", added)))
    return step.withColumn("_pii", F.struct(F.col("_base").alias("base"), F.col("_all").alias("all"))).drop(
        "_base", "_found", "_all"
    )


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with the spans of ``find`` redacted; ``n_chars``, if a column, follows the text."""
    packed = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    found = find(packed, model or fit(docs)).withColumn("_text", redacted(F.col("text"), F.col("_pii.all")))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed = F.size("_pii.all") > 0
        length = F.length("_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("_row.n_chars"))
    return found.select(*[(new[c] if c in new else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def listed(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def report(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, counts of base spans by kind, their digest, and all spans as text."""
    found = find(docs.select("doc_id", "text"), model)

    def count(k: int) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    base = F.col("_pii.base")
    return found.select(
        "doc_id",
        *[count(k) for k in range(len(KINDS))],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("_pii.all")).alias("spans"),
    )
