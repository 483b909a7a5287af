"""Personal data by weak supervision.

Fixed patterns find the base spans.  Wider patterns propose further candidates:
written-out e-mail addresses, phone numbers without a country code, card
numbers that miss a check digit, social security numbers.  Five labelers
(pattern, layout, gazetteer, context, neighbours) vote for, against or not at
all on every candidate, base spans included.  Expectation-maximisation
(Dawid and Skene) estimates how reliable each labeler is from the counts of
vote patterns over the whole corpus.  Its posteriors are the targets of a
logistic span classifier, which sees no votes but features of the span itself:
shape, length, the words and characters around it, its place in line and text.
Base spans always stay; a candidate is added when the classifier gives it
`threshold` or more and it touches no span kept before.

The fit takes every candidate of the corpus: votes and features lie in a table
in the shared folder, and each of the classifier's steps sums gradients by
feature slot.  The number of vote patterns (kinds x 3**5 x layouts) and of
slots is fixed, so what reaches the driver does not grow with the corpus.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow
from planweave.session import discard, stored

KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("ssn",)
LABELERS = ("pattern", "layout", "gazetteer", "context", "neighbours")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WIDE_AT = re.compile(r"[(\[{] ?(?:at|AT) ?[)\]}]")
_WIDE_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?: ?(?:[(\[{] ?(?:dot|DOT) ?[)\]}]|\.) ?[A-Za-z0-9-]+)+")
_WIDE_PHONE = re.compile(r"(?<![0-9+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Gazetteers and cue words (fixed values).
_HOST_ENDS = frozenset("com org net edu gov int info io de fr es uk us eu ch at it nl be ca example test".split())
_CALLING_CODES = ("1", "7", "20", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "64", "65", "81", "82", "86", "90", "91")
_CARD_STARTS = ("34", "35", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "64", "65")
_CUES = re.compile(r"\b(?:e-?mail|mail|contact|write|reach|call|tel|telephone|phone|mobile|fax|whatsapp|card|visa|mastercard|amex|credit|payment|ip|host|server|address|addr|login|from|ssn|social|security|correo|telefon|carte|karte|tarjeta|adresse)\b", re.I)
_AGAINST = re.compile(r"\b(?:version|ver|isbn|issn|order|invoice|ticket|token|hash|key|serial|section|figure|page|build|release|doi)\b|[=#v]\s*\"?$", re.I)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


class _Covered:
    """Stretches of a text that spans cover; finds by bisection whether another span touches one."""

    def __init__(self, spans=()):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a), self.ends.append(b)

    def touches(self, a: int, b: int) -> bool:
        at = bisect_left(self.starts, b)
        return at > 0 and self.ends[at - 1] > a

    def add(self, a: int, b: int) -> None:
        """A span that touches none."""
        at = bisect_left(self.starts, a)
        self.starts.insert(at, a), self.ends.insert(at, b)


def _emails(s: str):
    end, at = 0, s.find("@")
    while at != -1:
        start = at
        while start > end and s[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(s, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = s.find("@", end if found else at + 1)


def base_spans(s: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    out = [("email", a, b) for a, b in _emails(s)] if "@" in s else []
    if _DIGIT.search(s):
        for m in _IP.finditer(s):
            if all(_at_most_255(p) for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(s):
            if m.end() - m.start() >= 16 and 16 <= len(d := _only_digits(m[0])) <= 19 and _luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in s:
            for m in _PHONE.finditer(s):
                if 8 <= len(_only_digits(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def wide_spans(s: str) -> list[tuple[str, int, int]]:
    """Further candidates; may overlap base spans."""
    out = []
    if "(" in s or "[" in s or "{" in s:
        for m in _WIDE_AT.finditer(s):
            end = start = m.start() - (s[m.start() - 1 : m.start()] == " ")
            while start > 0 and s[start - 1] in _LOCAL:
                start -= 1
            right = _WIDE_DOMAIN.match(s, m.end()) if start < end else None
            if right:
                out.append(("email", start, right.end()))
    if _DIGIT.search(s):
        for m in _CARD.finditer(s):
            if m.end() - m.start() >= 13 and 13 <= len(_only_digits(m[0])) <= 19:
                out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in _WIDE_PHONE.finditer(s)]
        out += [("ssn", m.start(), m.end()) for m in _SSN.finditer(s)]
    return out


def votes(s: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """A vote of each labeler, 1 for, -1 against, 0 none, and the layout (0 bare, 1 with separators, 2 mixed)."""
    span = s[start:end]
    digits = _only_digits(span)
    marks = {c for c in span if not c.isalnum()}
    layout = 0 if not marks else 1 if len(marks) == 1 else 2
    before = s[max(0, start - 32) : start]
    if kind == "email":
        shape = 1 if "." in span.partition("@")[0] or "(" in span or "[" in span else 0
        known = 1 if span.rpartition(".")[2].rpartition(")")[2].strip(" )]}").lower() in _HOST_ENDS else -1
    elif kind == "ip":
        shape = 1 if all(str(int(p)) == p for p in span.split(".") if len(p) < 4) else -1
        known = -1 if span.split(".")[0].lstrip("0") in ("", "255") else 1
    elif kind == "card":
        groups = re.split(r"[\x20-]", span)
        shape = 1 if len({len(g) for g in groups[:-1]}) == 1 and len(groups[0]) == 4 else 0 if len(groups) == 1 else -1
        known = 1 if digits.startswith(_CARD_STARTS) else -1
    elif kind == "phone":
        shape = 1 if layout else 0
        known = 1 if (digits.startswith(_CALLING_CODES) if span[0] == "+" else digits[0] in "23456789") else -1
    else:
        shape = 1
        known = -1 if digits.startswith(("000", "666", "9")) or digits[3:5] == "00" or digits[5:] == "0000" else 1
    near = before[-1:] + s[end : end + 1]
    alone = -1 if any(c.isalnum() or c in "-_/=" for c in near) else 1
    context = -1 if _AGAINST.search(before) else 1 if _CUES.search(before) else 0
    return (1 if base else -1 if kind == "card" else 0, shape, known, context, alone, layout)


def candidates(s: str) -> list[tuple[str, int, int, bool, tuple[int, ...]]]:
    """Base spans, then further candidates that touch no base span of any kind."""
    base = base_spans(s)
    out = [(k, a, b, True, votes(s, k, a, b, True)) for k, a, b in base]
    covered = _Covered((a, b) for _, a, b in base)
    for k, a, b in wide_spans(s):
        if not covered.touches(a, b):
            out.append((k, a, b, False, votes(s, k, a, b, False)))
    return out


SLOTS = 4096
_CLASSES = str.maketrans({**{c: "9" for c in "0123456789"}, **{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}})
_RUN = re.compile(r"(.)\1+", re.S)
_WORD = re.compile(r"[^\W_]+")


def span_features(s: str, kind: str, start: int, end: int) -> list[int]:
    """Slots of a span's features: its shape, length, the words and characters around it and its place; no votes."""
    span = s[start:end]
    before, after = s[max(0, start - 48) : start], s[end : end + 48]
    words = _WORD.findall(before.lower())[-2:]
    follows = _WORD.search(after.lower())
    told = (
        "any",
        "shape " + _RUN.sub(r"\1", span[:64].translate(_CLASSES)),
        f"size {min(end - start, 48) // 4}",
        f"digits {min(len(_only_digits(span)), 24)}",
        "last " + (words[-1] if words else ""),
        "last but one " + (words[0] if len(words) == 2 else ""),
        "next " + (follows[0] if follows else ""),
        "char before " + before[-1:].translate(_CLASSES),
        "char after " + after[:1].translate(_CLASSES),
        f"line {before[-1:] in ('', chr(10))} {after[:1] in ('', chr(10))}",
        f"place {4 * start // len(s)}",
    )
    return sorted({zlib.crc32(f"{kind} {t}".encode("utf-8", "replace")) % SLOTS for t in told})


def _told(batches):
    """Votes and features of all candidates, equal ones of a batch once with their number."""
    for batch in batches:
        total: Counter = Counter()
        for s in batch.column(0).to_pylist():
            if s:
                total.update((k, v, tuple(span_features(s, k, a, b))) for k, a, b, _, v in candidates(s))
        keys = list(total)
        lists = lambda i: pa.array([list(k[i]) for k in keys], pa.list_(pa.int32()))  # noqa: E731, B023
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), lists(1), lists(2), pa.array([total[k] for k in keys], pa.int64())], names=["kind", "vote", "slots", "n"])


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> tuple[dict[str, np.ndarray], dict[tuple, float]]:
    """Dawid and Skene's estimates: each labeler's vote probabilities by kind, and the posterior of every vote pattern."""
    reliability, posterior = {}, {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = sorted((v, n) for k, v, n in patterns if k == kind)
        v = np.array([r[0][: len(LABELERS)] for r in rows]) + 1
        n = np.array([r[1] for r in rows], float)
        p = 1 / (1 + np.exp(-1.5 * (v - 1).sum(axis=1)))
        for _ in range(rounds):
            prior = ((p * n).sum() + 1) / (n.sum() + 2)
            like = np.zeros((2, len(LABELERS), 3))
            for j in range(len(LABELERS)):
                for c in range(3):
                    hit = v[:, j] == c
                    like[1, j, c] = (p * n)[hit].sum() + (1.0 if c == 2 else 0.5)
                    like[0, j, c] = ((1 - p) * n)[hit].sum() + (1.0 if c == 0 else 0.5)
            like /= like.sum(axis=2, keepdims=True)
            logit = np.log(prior / (1 - prior)) + sum(np.log(like[1, j, v[:, j]] / like[0, j, v[:, j]]) for j in range(len(LABELERS)))
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        reliability[kind] = like
        posterior.update({(kind, r[0]): float(q) for r, q in zip(rows, p)})
    return reliability, posterior


class SpanModel:
    """Labeler reliabilities by kind and the span classifier's weights by slot; without weights it adds nothing."""

    def __init__(self, reliability: dict[str, np.ndarray] | None = None, weights: np.ndarray | None = None):
        self.reliability, self.weights = reliability or {}, weights

    def score(self, slots: list[int]) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.weights[slots].sum(), -30, 30))))


def _gradients(weights: np.ndarray, posterior: dict[tuple, float]):
    """Gradient and curvature of the log loss by slot, over a task's candidates."""

    def run(batches):
        grad, bend = np.zeros(SLOTS), np.zeros(SLOTS)
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            slots = np.asarray(col["slots"].flatten())
            size = np.diff(col["slots"].offsets.to_numpy())
            y = np.array([posterior[k, tuple(v)] for k, v in zip(col["kind"].to_pylist(), col["vote"].to_pylist())])
            n = col["n"].to_numpy().astype(float)
            owner = np.repeat(np.arange(len(batch)), size)
            p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, weights=weights[slots], minlength=len(batch)), -30, 30)))
            grad += np.bincount(slots, weights=(n * (p - y))[owner], minlength=SLOTS)
            bend += np.bincount(slots, weights=(n * p * (1 - p) * size)[owner], minlength=SLOTS)
        at = np.flatnonzero(bend)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(grad[at]), pa.array(bend[at])], names=["slot", "grad", "bend"])

    return run


def fit(docs: DataFrame, text: str = "text", steps: int = 12) -> SpanModel:
    """The model of all candidates of all documents; without any, one that adds nothing.

    The classifier is fitted by damped diagonal Newton steps over the whole
    table: curvatures are scaled by the number of a span's features, which
    bounds the full matrix, so every step lowers the loss.
    """
    told = stored(docs.select(text).mapInArrow(*_arrow.batches(_told, "kind string, vote array<int>, slots array<int>, n bigint")), "pii")
    rows = told.groupBy("kind", "vote").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return SpanModel()
    reliability, posterior = reliabilities([(r["kind"], tuple(r["vote"]), r["n"]) for r in rows])
    weights = np.zeros(SLOTS)
    for _ in range(steps):
        sums = told.mapInArrow(*_arrow.batches(_gradients(weights, posterior), "slot int, grad double, bend double")).groupBy("slot").agg(F.sum("grad").alias("grad"), F.sum("bend").alias("bend")).toPandas()
        at = sums["slot"].to_numpy()
        step = (sums["grad"].to_numpy() + 0.05 * weights[at]) / (sums["bend"].to_numpy() + 0.05)
        weights[at] -= np.clip(step, -2, 2)
    discard(told)
    return SpanModel(reliability, weights)


def find(s: str, model: SpanModel, threshold: float) -> tuple[list, list]:
    """(base spans, all spans), each by kind as listed, then start."""
    base = base_spans(s)
    covered = _Covered((a, b) for _, a, b in base)
    rest = [(k, a, b) for k, a, b in wide_spans(s) if not covered.touches(a, b)]
    if not rest:
        return base, base
    kept, added = list(base), _Covered()
    for p, k, a, b in sorted(((model.score(span_features(s, k, a, b)), k, a, b) for k, a, b in rest), key=lambda x: (-x[0], x[2], x[3], x[1])):
        if p >= threshold and not added.touches(a, b):
            kept.append((k, a, b))
            added.add(a, b)
    order = {k: i for i, k in enumerate(KINDS + EXTRA_KINDS)}
    return base, sorted(kept, key=lambda x: (order[x[0]], x[1], x[2]))


def redact(s: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [s[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, s[at:]])


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, text: str = "text", threshold: float = 0.9, model: SpanModel | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns of docs (or those in keep) in a struct `row`, then base_spans, spans (strings), counts by kind and redacted text.

    A null text counts as empty and has no spans; its redacted text stays null.
    Repeated rows get the same answer each; an empty table gives no rows and
    fits an empty model, which adds nothing.
    """
    model = model or fit(docs, text)
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for s in batch.column(1).to_pylist():
                base, spans = find(s, model, threshold) if s else ([], [])
                n = Counter(k for k, _, _ in base)
                for c, v in zip(out, [_joined(base), _joined(spans), redact(s, spans) if s else s, *(n[k] for k in KINDS), len(spans) - len(base)]):
                    c.append(v)
            kinds = [pa.string()] * 3 + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds))], names=["row", "base_spans", "spans", "redacted", *(f"n_{k}" for k in KINDS), "n_added"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, base_spans string, spans string, redacted string, {', '.join(f'n_{k} bigint' for k in KINDS)}, n_added bigint"
    return rows.mapInArrow(*_arrow.batches(run, schema))


def sha256(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs)
    found = find_pii(docs, model=model, keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), *(f"n_{k}" for k in KINDS), F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_added")
