"""Language identification by mixture inference.

A document's words are taken to come from a mixture of the learned languages;
a word's likelihood in a language is that of its byte trigrams.
Expectation-maximisation estimates the document's proportions, and the number
of languages, taken in the order of their proportions, is the one with the best
penalised likelihood; sizes are compared up to all learned languages, and only
those are passed over whose penalty exceeds what any mixture could gain.  Trigram counts are gathered over all documents that may
be learned from: tasks count into a table of fixed size and the tables are
summed by key, so what is shuffled or sent depends on the table's size and the
number of tasks and languages, never on a language's share of the rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow, _words

SLOTS = 1 << 16


def _letter_table() -> np.ndarray:
    """Bytes of words: letters in lower case and all bytes over 127 stay; everything else ends a word."""
    t = np.full(256, 32, np.uint8)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


def trigrams(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each trigram, first trigram of each word, first word of each document and the total)."""
    data, offsets = _words.buffers(texts)
    n = len(offsets) - 1
    padded = np.full(len(data) + 2 * n + 2, 32, np.uint8)  # two spaces before each document, so that none runs into the next
    padded[np.arange(len(data)) + 2 * (np.repeat(np.arange(n), np.diff(offsets)) + 1)] = table[data]
    inside = padded != 32
    own = inside[2:] | inside[1:-1]  # a trigram belongs to a word if it ends on one of its bytes or right after
    code = (padded[:-2].astype(np.uint64) << np.uint64(16)) | (padded[1:-1].astype(np.uint64) << np.uint64(8)) | padded[2:].astype(np.uint64)
    at = np.flatnonzero(own)
    slots = (_words.mix(code[at]) >> np.uint64(48)).astype(np.int64)
    starts = np.flatnonzero(inside[2:] & ~inside[1:-1])
    first = np.searchsorted(at, starts)
    begin = offsets + 2 * np.arange(n + 1)
    return slots, first, np.searchsorted(starts, begin)


def _count(batches):
    table = _letter_table()
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for at, texts in _words.pieces(batch.column(0)):
            langs = batch.column(1).slice(at, len(texts)).dictionary_encode()
            slots, first, docs = trigrams(texts, table)
            if not len(first):
                continue
            names = langs.dictionary.to_pylist()
            which = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(docs))
            which = np.repeat(which, np.diff(np.append(first, len(slots))))
            counts = np.bincount(which * SLOTS + slots, minlength=len(names) * SLOTS).reshape(len(names), SLOTS)
            for name, c in zip(names, counts):
                totals[name] = totals[name] + c if name in totals else c
    for name, c in totals.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])], names=["lang", "slot", "n"])


class Model:
    """Languages and the log likelihood of each trigram slot in each of them."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        c = counts.astype(np.float64) + 0.5
        self.loglik = np.log(c / c.sum(axis=1, keepdims=True)).T.astype(np.float32).copy() if langs else np.zeros((SLOTS, 0), np.float32)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over every row of docs whose lang is not null."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    summed = known.mapInArrow(*_arrow.batches(_count, "lang string, slot int, n bigint")).groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    t = summed.toArrow()
    langs = sorted(set(t["lang"].to_pylist()), key=lambda s: s.encode())
    counts = np.zeros((len(langs), SLOTS), np.int64)
    place = {x: i for i, x in enumerate(langs)}
    if langs:
        rows = np.array([place[x] for x in t["lang"].to_pylist()])
        counts[rows, t["slot"].to_numpy()] = t["n"].to_numpy()
    return Model(langs, counts)


def _mixture(like: np.ndarray, base: np.ndarray, docs: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log likelihood) by document; like: words x languages relative to base, docs: first word of each.

    Every document here has a word."""
    counts = np.diff(docs)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    heads = docs[:-1]
    for _ in range(steps):
        joint = like * np.repeat(share, counts, axis=0)
        joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(joint, heads, axis=0) / counts[:, None]
    total = (like * np.repeat(share, counts, axis=0)).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-30)) + base, heads)


def _bound(like: np.ndarray, base: np.ndarray, docs: np.ndarray, share: np.ndarray, got: np.ndarray) -> np.ndarray:
    """What no mixture's log likelihood exceeds, by document: it is concave, so its slopes at `share`, where it is `got`, bound it."""
    counts = np.diff(docs)
    total = (like * np.repeat(share, counts, axis=0)).sum(axis=1)
    slope = np.add.reduceat(like / np.maximum(total, 1e-30)[:, None], docs[:-1], axis=0) / counts[:, None]
    return np.minimum(got + counts * np.log(slope.max(axis=1)), np.add.reduceat(base, docs[:-1])) + 1e-6


def infer(model: Model, texts: pa.Array, table: np.ndarray, steps: int = 12, penalty: float = 3.0) -> tuple[list, np.ndarray, list]:
    """(language, score, languages of the set) by document; texts has no nulls."""
    n, k = len(texts), len(model.langs)
    langs: list = ["und"] * n
    scores = np.zeros(n)
    sets: list = [""] * n
    slots, first, docs = trigrams(texts, table)
    has = np.flatnonzero(np.diff(docs) > 0)
    if k and len(has):
        word = np.add.reduceat(model.loglik[slots], first, axis=0).astype(np.float64)
        heads = np.append(docs[has], docs[-1])
        counts = np.diff(heads)
        top = word.max(axis=1)
        like = np.exp(np.maximum(word - top[:, None], -60))
        full, reached = _mixture(like, top, heads, np.ones((len(has), k)), steps)
        most = _bound(like, top, heads, full, reached)
        single = np.add.reduceat(word, heads[:-1], axis=0)
        best_set = np.zeros((len(has), k))
        best_set[np.arange(len(has)), single.argmax(axis=1)] = 1
        best = single.max(axis=1)
        share = best_set.copy()
        order = np.argsort(-full, axis=1, kind="stable")
        for size in range(2, k + 1):
            cost = penalty * (size - 1) * np.log(counts + 1)
            open_ = np.flatnonzero(most - cost > best)
            if not len(open_):
                break
            keep = np.repeat(np.isin(np.arange(len(has)), open_), counts)
            sub = np.append(0, np.cumsum(counts[open_]))
            allowed = np.zeros((len(open_), k))
            np.put_along_axis(allowed, order[open_, :size], 1, axis=1)
            got, ll = _mixture(like[keep], top[keep], sub, allowed, steps)
            better = ll - cost[open_] > best[open_]
            at = open_[better]
            best[at] = (ll - cost[open_])[better]
            share[at], best_set[at] = got[better], allowed[better]
        pick = share.argmax(axis=1)
        # How sure the pick is: its proportion, times the posterior of the whole document where one language is left.
        gap = single - single.max(axis=1, keepdims=True)
        posterior = np.exp(np.maximum(gap, -60))
        posterior /= posterior.sum(axis=1, keepdims=True)
        alone = best_set.sum(axis=1) == 1
        for i, d in enumerate(has):
            langs[d] = model.langs[pick[i]]
            scores[d] = min(1.0, posterior[i, pick[i]] if alone[i] else share[i, pick[i]])
            sets[d] = ",".join(x for x, s in zip(model.langs, best_set[i]) if s)
    return langs, scores, sets


_LETTERS = re.compile(r"[A-Za-z]")


def _has_letter(s: str | None) -> bool:
    return bool(s) and (bool(_LETTERS.search(s)) or any(c.isalpha() for c in s))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of docs (or those in keep) in a struct `row`, then lang_pred, score and lang_set.

    A null text, or one without a letter, is `und` with score 0, as is every
    text where nothing was learned.  A text whose letters are all outside the
    learned languages gets the least unlikely one.  Repeated rows get the same answer.
    """
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text).alias("text"))
    most = max(1 << 18, (16 << 20) // max(1, len(model.langs)) // 4)

    def run(batches):
        table = _letter_table()
        for batch in batches:
            langs, scores, sets = [], [], []
            for _, texts in _words.pieces(batch.column(1), most):
                a, b, c = infer(model, texts, table)
                bare = [i for i, s in enumerate(texts.to_pylist()) if not _has_letter(s)]
                for i in bare:
                    a[i], b[i], c[i] = "und", 0.0, ""
                langs += a
                scores.append(b)
                sets += c
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0)), pa.array(sets, pa.string())], names=["row", "lang_pred", "score", "lang_set"])

    return rows.mapInArrow(*_arrow.batches(run, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, lang_set string"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    model = learn(docs.where(rest != 1))
    found = identify(docs, model, keep=["doc_id"])
    return found.select("row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "lang_set")
