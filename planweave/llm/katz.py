"""Katz backoff language model over words, of order 2, with Good-Turing discounts.

A text is its words, A-Z in lower case, then one end token; the first is
predicted from a start mark.  P(w | u) is r(c) / c(u) where the pair was
seen c times in training, and alpha(u) * P(w) where it was not.  r(c) is c by
Good-Turing's ratio up to a cutoff of 5 and c above, less LEAST at any rate, so
that every word leaves something for what was never seen after it; alpha(u)
makes each distribution sum to exactly 1 over the vocabulary, the end included,
and one class for all unknown words.  After a word that training doesn't know,
alpha is 1.  P(w) is (c(w) + DELTA) / (N + DELTA * (V + 1)).

How it runs.  Pairs are dealt by the word that they predict, so that a range of
word hashes knows c(w) without a further exchange; words that make up 1/HEAVY of
all tokens or more, HEAVY of them at most, are known to every task and their
pairs are dealt by the pair instead.  A document's score is a sum over its
tokens, so ranges return sums by document: its pairs by count class, to which
the discounts are applied afterwards, and for unseen pairs the word before,
which is looked up once the backoff weights are known.  The weights of the heavy
words and of the start mark go to every task, so their unseen pairs are dealt by
batch of documents.  All tables lie in the shared folder, in parts by hash or by
batch of documents; none is held by one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow, _blobs, _words
from planweave.session import discard, release, stored

CUTOFF = 5
DELTA = 0.1
LEAST = 0.05
HEAVY = 2000
END = np.uint64(0xE7D5_0A11_0000_0001)
START = np.uint64(0x57A7_0A11_0000_0001)


def _tokens(texts: pa.Array, hasher: _words.Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, ends included; first token of each document and the total)."""
    data, offsets = _words.buffers(texts)
    starts, ends, first = _words.spans(data, offsets)
    h = hasher.words(data, starts, ends)
    n = len(offsets) - 1
    out = np.empty(len(h) + n, np.uint64)
    begin = first + np.arange(n + 1)
    out[begin[1:] - 1] = END
    out[np.arange(len(h)) + np.repeat(np.arange(n), np.diff(first))] = h
    return out, begin


def _flags(batch: pa.RecordBatch, at: int, n: int) -> np.ndarray:
    return batch.column(1).slice(at, n).fill_null(False).to_numpy(zero_copy_only=False)


def _count_words(slots: int):
    """Training counts by word: a task's counts, in ranges of hashes."""

    def run(batches):
        hasher = _words.Hasher(True)
        held: list = []
        size = 0

        def out():
            words, inverse = np.unique(np.concatenate([a for a, _ in held]), return_inverse=True)
            counts = np.bincount(inverse, weights=np.concatenate([b for _, b in held])).astype(np.uint64)
            slot = _blobs.slot(words, slots)
            cut = np.append(np.flatnonzero(np.diff(slot, prepend=slot[:1] + np.uint64(1))), len(words))
            blobs = [_blobs.pack(_blobs.delta(words[a:b]), counts[a:b]) for a, b in zip(cut, cut[1:])]
            return pa.RecordBatch.from_arrays([pa.array(slot[cut[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], names=["slot", "blob"])

        for batch in batches:
            for at, texts in _words.pieces(batch.column(0)):
                h, first = _tokens(texts, hasher)
                h = h[np.repeat(_flags(batch, at, len(texts)), np.diff(first))]
                if len(h):
                    words, counts = np.unique(h, return_counts=True)
                    held.append((words, counts))
                    size += len(words)
                if size > 2 << 20:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return run


def _sum_words(heavy_above: int):
    """Of a range of hashes: its number of tokens and words, and the words with heavy_above tokens or more."""

    def run(table: pa.Table) -> pa.Table:
        cols = [_blobs.unpack(b) for b in table.column("blob").to_pylist()]
        words, inverse = np.unique(np.concatenate([_blobs.undelta(c[0]) for c in cols]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([c[1] for c in cols])).astype(np.int64)
        most = np.argsort(-counts, kind="stable")[:heavy_above]
        return pa.table([pa.array([int(counts.sum())]), pa.array([len(words)]), pa.array([words[most].view(np.int64).tolist()], pa.list_(pa.int64())), pa.array([counts[most].tolist()], pa.list_(pa.int64()))], names=["n", "v", "words", "counts"])

    return run


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _words.mix(u * np.uint64(0xD1342543DE82EF95) + w)


def _runs(a: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(a), 1), bool), a[1:] != a[:-1]]))


def _deal_pairs(slots: int, heavy: np.ndarray, most: int = 2 << 20):
    """The pairs of batches of documents, a blob for each range: pairs once each, then the documents that hold them.

    kind 0: pairs; kind 1: the batch's documents (id, whether it is null, whether learned from, whether held out).
    """

    def run(batches):
        from pyspark import TaskContext

        hasher = _words.Hasher(True)
        parts: list = []
        size, batch_no = 0, TaskContext.get().partitionId() << 24

        def out():
            shift, owners = 0, []
            for p in parts:
                owners.append(p[2] + np.uint32(shift))
                shift += len(p[3])
            u, w = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            owner = np.concatenate(owners)
            ids, null, train, held = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 5, 6))
            parts.clear()
            deal = w.copy()
            hot = np.isin(w, heavy)
            deal[hot] = _pair(u[hot], w[hot])
            slot = _blobs.slot(deal, slots).astype(np.int32)
            del deal, hot
            order = np.argsort(slot, kind="stable")
            cuts = np.searchsorted(slot[order], np.arange(slots + 1))
            names, kinds, blobs = [batch_no % slots], [1], [_blobs.pack(ids, null.astype(np.uint64), train.astype(np.uint64), held.astype(np.uint64))]
            for k in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[k] : cuts[k + 1]]
                before, bi = np.unique(u[at], return_inverse=True)
                words, wi = np.unique(w[at], return_inverse=True)
                key = wi.astype(np.int64) * len(before) + bi
                o = np.lexsort((owner[at], key))
                key, doc = key[o], owner[at][o]
                entry = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]))
                times = np.diff(np.append(entry, len(key)))
                pair = _runs(key[entry])
                docs, local = np.unique(doc[entry], return_inverse=True)
                pk = key[entry][pair]
                names.append(int(k)), kinds.append(0)
                blobs.append(_blobs.pack(_blobs.delta(before), _blobs.delta(words), np.diff(pk // len(before), prepend=0), pk % len(before), np.diff(np.append(pair, len(entry))), local, times, docs.astype(np.uint64), train[docs].astype(np.uint64)))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(kinds, pa.int32()), pa.array([batch_no] * len(names), pa.int64()), pa.array(blobs, pa.binary())], names=["slot", "kind", "batch", "blob"])

        for batch in batches:
            for at, texts in _words.pieces(batch.column(0)):
                w, first = _tokens(texts, hasher)
                u = np.concatenate([[START], w[:-1]]).astype(np.uint64)
                u[first[:-1]] = START
                n = len(texts)
                ids = batch.column(2).slice(at, n)
                held = batch.column(3).slice(at, n).fill_null(False).to_numpy(zero_copy_only=False)
                parts.append((u, w, np.repeat(np.arange(n, dtype=np.uint32), np.diff(first)), ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ~ids.is_valid().to_numpy(zero_copy_only=False), _flags(batch, at, n), held))
                size += len(w)
                if size >= most:
                    yield out()
                    size, batch_no = 0, batch_no + 1
        if parts:
            yield out()

    return run


ONE = float(1 << 30)
RANGE = "kind int, slot int, batch bigint, blob binary, counts array<bigint>"


def _fixed(x: np.ndarray) -> np.ndarray:
    """Sums as whole numbers of 2**-30, sign last."""
    v = np.rint(np.asarray(x) * ONE).astype(np.int64)
    return ((v << 1) ^ (v >> 63)).view(np.uint64)


def _unfixed(v: np.ndarray) -> np.ndarray:
    return ((v >> np.uint64(1)).view(np.int64) ^ -(v & np.uint64(1)).view(np.int64)) / ONE


def _hot_before(heavy: np.ndarray) -> np.ndarray:
    """The words before whose weights every task gets: the heavy ones and the start mark."""
    return np.union1d(heavy, np.array([START]))


def _range_of_pairs(slots: int, heavy: np.ndarray, heavy_counts: np.ndarray, n_tokens: int, n_words: int):
    """What a range of pairs tells: kind 0 sums by document, 1 its batch's documents as they came, 2 sums by the word before, 3 unseen pairs, 4 counts of counts, 6 sums by a heavy word before."""
    hot_before = _hot_before(heavy)
    unit = n_tokens + DELTA * (n_words + 1)

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        cols, spans, shift = [], [], 0
        for kind, batch, blob in zip(*(table.column(c).to_pylist() for c in ("kind", "batch", "blob"))):
            if kind == 1:
                out.append((1, -1, batch, blob, None))
                continue
            before, words, wi, bi, n_docs, local, times, docs, train = _blobs.unpack(blob)
            words = _blobs.undelta(words)[np.cumsum(wi.astype(np.int64))]
            cols.append((_blobs.undelta(before)[bi.astype(np.int64)], words, n_docs.astype(np.int64), local.astype(np.int64) + shift, times.astype(np.int32), train.astype(bool)))
            spans.append((batch, shift, shift + len(docs), docs))
            shift += len(docs)
        if cols:
            u, w, n_docs, doc, times, train = (np.concatenate([c[i] for c in cols]) for i in range(6))
            del cols
            order = np.lexsort((u, w))
            su, sw = u[order], w[order]
            new = np.concatenate([[True], (sw[1:] != sw[:-1]) | (su[1:] != su[:-1])])
            pair_of = np.empty(len(u), np.int32)
            pair_of[order] = np.cumsum(new) - 1
            pu, pw = su[new], sw[new]
            del u, w, su, sw, order, new
            entry = np.repeat(pair_of, n_docs)
            count = np.bincount(entry, weights=times * train[doc], minlength=len(pu)).astype(np.int64)
            # c(w) is whole in this range, but for heavy words, whose pairs lie in all ranges.
            heads = _runs(pw)
            size = np.diff(np.append(heads, len(pw)))
            c_w = np.add.reduceat(count, heads)
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, pw[heads]), len(heavy) - 1)
                hot = heavy[at] == pw[heads]
                c_w[hot] = heavy_counts[at[hot]]
            log_w = np.repeat(np.log10((c_w + DELTA) / unit), size)
            log_c = np.repeat(np.where(pw[heads] == END, 0.0, np.log10(np.maximum(c_w, 1))), size)
            c_w = np.repeat(c_w, size)
            # What a token adds besides the classes: an unseen pair P(w), one above the cutoff its count; each word, as the next token's word before, takes its own count away.
            own = np.where(count == 0, log_w, np.where(count > CUTOFF, np.log10(np.maximum(count - LEAST, LEAST)), 0.0)) - log_c
            add = lambda x: np.bincount(doc, weights=times * x[entry], minlength=shift)
            sums = [_fixed(add(log_w)), _fixed(add(own)), add(c_w > 0).astype(np.uint64), np.bincount(doc, weights=times, minlength=shift).astype(np.uint64), *(add(count == k).astype(np.uint64) for k in range(1, CUTOFF + 1))]
            for batch, a, b, docs in spans:
                out.append((0, -1, batch, _blobs.pack(_blobs.delta(docs), *(x[a:b] for x in sums)), None))
            has = count > 0
            order = np.argsort(pu[has], kind="stable")
            hu, hc, hw = pu[has][order], count[has][order], c_w[has][order]
            if len(hu):
                heads = _runs(hu)
                rows = [hu[heads], *(np.add.reduceat((hc == k).astype(np.int64), heads) for k in range(1, CUTOFF + 1)), np.add.reduceat(np.where(hc > CUTOFF, hc, 0), heads), np.add.reduceat(hw, heads), np.diff(np.append(heads, len(hu)))]
                hot = np.isin(rows[0], hot_before)
                for i in np.flatnonzero(hot):
                    out.append((6, -1, int(np.searchsorted(hot_before, rows[0][i])), None, [int(r[i]) for r in rows[1:]]))
                rows = [r[~hot] for r in rows]
                slot = _blobs.slot(rows[0], slots).astype(np.int64)
                cut = np.append(_runs(slot), len(slot))
                for a, b in zip(cut, cut[1:]):
                    out.append((2, int(slot[a]), -1, _blobs.pack(_blobs.delta(rows[0][a:b]), *(r[a:b] for r in rows[1:])), None))
            lost = np.flatnonzero(count[entry] == 0)
            if len(lost):
                ends = np.array([b for _, _, b, _ in spans])
                places = np.concatenate([d for _, _, _, d in spans])
                hu, hd = pu[entry[lost]], doc[lost]
                hb, hd, ht = np.searchsorted(ends, hd, "right"), places[hd], times[lost]
                deal = hu.copy()
                hot = np.isin(hu, hot_before)
                deal[hot] = _words.mix(np.array([s[0] for s in spans], np.uint64)[hb[hot]])
                slot = _blobs.slot(deal, slots).astype(np.int64)
                order = np.lexsort((hu, slot))
                hu, hb, hd, ht, slot = (x[order] for x in (hu, hb, hd, ht, slot))
                cut = np.append(_runs(slot), len(slot))
                for a, b in zip(cut, cut[1:]):
                    held, at = np.unique(hb[a:b], return_inverse=True)
                    out.append((3, int(slot[a]), -1, _blobs.pack(_blobs.delta(hu[a:b]), at, hd[a:b], ht[a:b].astype(np.uint64), np.array([spans[k][0] for k in held], np.uint64)), None))
            out.append((4, -1, -1, None, np.bincount(np.minimum(count, CUTOFF + 2), minlength=CUTOFF + 3).tolist()))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        return pa.table([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["kind", "slot", "batch", "blob", "counts"])

    return run


def discounted(counts_of_counts, cutoff: int = CUTOFF) -> np.ndarray:
    """r(0..cutoff): Katz's form of Good-Turing's ratio, times the count, where it lies between 0 and 1; LEAST below the count at any rate.

    counts_of_counts[c] is the number of distinct pairs seen c times, up to cutoff + 1.
    """
    n = np.asarray(counts_of_counts, float)
    r = np.maximum(np.arange(cutoff + 1) - LEAST, 0.0)
    common = (cutoff + 1) * n[cutoff + 1] / n[1] if n[1] > 0 else 1.0
    for c in range(1, cutoff + 1):
        if n[c] > 0 and common < 1:
            ratio = ((c + 1) * n[c + 1] / (c * n[c]) - common) / (1 - common)
            if 0 < ratio < 1:
                r[c] = min(r[c], c * ratio)
    return r


def _weights(classes: np.ndarray, above: np.ndarray, word_sum: np.ndarray, pairs: np.ndarray, r: np.ndarray, unit: float) -> np.ndarray:
    """log10 of alpha(u) * c(u), from the pairs after u by count class, their counts above the cutoff, the counts of their words and their number."""
    free = sum((c + 1 - r[c + 1]) * x for c, x in enumerate(classes)) + LEAST * (pairs - sum(classes))
    return np.log10(free / (1 - (word_sum + DELTA * pairs) / unit))


def _backoff(r: np.ndarray, n_tokens: int, n_words: int, hot: np.ndarray, hot_weights: np.ndarray):
    """log10 of alpha(u) * c(u) for the unseen pairs of a range of words before, summed by document."""
    unit = n_tokens + DELTA * (n_words + 1)

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "batch", "blob"))))
        stats = [_blobs.unpack(b) for k, _, b in rows if k == 2]
        words, beta = np.zeros(0, np.uint64), np.zeros(0)
        if stats:
            words, inverse = np.unique(np.concatenate([_blobs.undelta(s[0]) for s in stats]), return_inverse=True)
            classes = [np.bincount(inverse, weights=np.concatenate([s[i].astype(float) for s in stats])) for i in range(1, CUTOFF + 4)]
            beta = _weights(np.array(classes[:CUTOFF]), *classes[CUTOFF:], r, unit)
        # The heavy words' own weights, known to every task.
        words, beta = np.concatenate([words, hot]), np.concatenate([beta, hot_weights])
        order = np.argsort(words, kind="stable")
        words, beta = words[order], beta[order]
        parts = []
        for _, _, blob in (x for x in rows if x[0] == 3):
            u, of, doc, times, held = _blobs.unpack(blob)
            u = _blobs.undelta(u)
            value = np.zeros(len(u))
            if len(words):
                at = np.minimum(np.searchsorted(words, u), len(words) - 1)
                value = np.where(words[at] == u, beta[at], 0.0) * times.astype(float)
            parts.append((held[of.astype(np.int64)], doc, value))
        batches, blobs = [], []
        if parts:
            of, doc, value = (np.concatenate([x[i] for x in parts]) for i in range(3))
            order = np.lexsort((doc, of))
            of, doc, value = of[order], doc[order], value[order]
            heads = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (doc[1:] != doc[:-1])]))
            of, doc, value = of[heads], doc[heads], _fixed(np.add.reduceat(value, heads))
            cut = np.append(_runs(of), len(of))
            for a, b in zip(cut, cut[1:]):
                batches.append(int(of[a]))
                blobs.append(_blobs.pack(_blobs.delta(doc[a:b]), value[a:b]))
        return pa.table([pa.array([5] * len(blobs), pa.int32()), pa.array(batches, pa.int64()), pa.array(blobs, pa.binary())], names=["kind", "batch", "blob"])

    return run


def _scores(r: np.ndarray, n_train: int):
    """The documents of a batch, scored."""

    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "blob"))))
        ids, null, _, held = _blobs.unpack(next(b for k, b in rows if k == 1))
        n = len(ids)
        base, score = np.zeros(n), np.full(n, -np.log10(max(n_train, 1)))
        whole = np.zeros((2 + CUTOFF, n), np.int64)
        for kind, blob in rows:
            if kind == 0:
                docs, a, b, *counts = _blobs.unpack(blob)
                at = _blobs.undelta(docs).astype(np.int64)
                base[at] += _unfixed(a)
                score[at] += _unfixed(b)
                for i, c in enumerate(counts):
                    whole[i, at] += c.astype(np.int64)
            elif kind == 5:
                docs, a = _blobs.unpack(blob)
                score[_blobs.undelta(docs).astype(np.int64)] += _unfixed(a)
        for c in range(1, CUTOFF + 1):
            score += whole[1 + c] * np.log10(r[c])
        return pa.table(
            [pa.array(ids.view(np.int64), mask=null.astype(bool)), pa.array(held.astype(bool)), pa.array(whole[1]), pa.array(whole[0]), pa.array(base), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )

    return run


def score_documents(docs: DataFrame, learn, hold=None, text: str = "text", id: str = "doc_id", slots: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10), one row per row of docs.

    learn and hold are conditions: which rows the model is learned from (null: not),
    and which are marked held_out (null: not; default: those not learned from).
    A null text is an empty one: its end is its only token.  Rows are scored one
    by one, so repeated rows, and rows that share an id or have none, each get
    theirs; repeated rows count as often as they are there.  With nothing to
    learn from, every token is unknown and scores log10 of 1: V is 0.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(id).cast("bigint").alias("doc_id"), F.coalesce(~learn if hold is None else hold, F.lit(False)).alias("held"))
    parts = slots or int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = stored(rows.select("text", "learn").mapInArrow(*_arrow.batches(_count_words(parts), "slot int, blob binary")).groupBy("slot").applyInArrow(*_arrow.groups(_sum_words(HEAVY), "n bigint, v bigint, words array<bigint>, counts array<bigint>")), "katz")
    n_tokens, n_words = (int(x or 0) for x in words.agg(F.sum("n"), F.sum("v")).first())
    often = F.filter(F.arrays_zip("words", "counts"), lambda w: w["counts"] * HEAVY >= n_tokens)
    common = words.select(F.explode(often).alias("w"))
    heavy = sorted((r[0] & _words.MASK, r[1]) for r in common.select("w.words", "w.counts").collect())
    discard(words)
    release(spark)
    keys, counts = np.array([h[0] for h in heavy], np.uint64), np.array([h[1] for h in heavy], np.int64)
    slots = slots or _blobs.ranges(spark, n_tokens)
    dealt = rows.mapInArrow(*_arrow.batches(_deal_pairs(slots, keys), "slot int, kind int, batch bigint, blob binary"))
    told = stored(dealt.groupBy("slot").applyInArrow(*_arrow.groups(_range_of_pairs(slots, keys, counts, n_tokens, n_words), RANGE)), "katz")
    release(spark)
    classes = told.where("kind = 4").agg(*(F.sum(F.col("counts")[i]) for i in range(CUTOFF + 2))).first()
    r = discounted([int(x or 0) for x in classes])
    n_train = int(dict(heavy).get(int(END), 0)) or int(rows.where("learn").count())
    hot = _hot_before(keys)
    sums = told.where("kind = 6").groupBy("batch").agg(*(F.sum(F.col("counts")[i]).cast("double").alias(f"c{i}") for i in range(CUTOFF + 3))).orderBy("batch").collect()
    hot = hot[[s["batch"] for s in sums]] if sums else hot[:0]
    cols = np.array([[s[f"c{i}"] for s in sums] for i in range(CUTOFF + 3)]).reshape(CUTOFF + 3, len(sums))
    hot_weights = _weights(cols[:CUTOFF], *cols[CUTOFF:], r, n_tokens + DELTA * (n_words + 1)) if sums else np.zeros(0)
    weights = told.where("kind in (2, 3)").select("slot", "kind", "batch", "blob").groupBy("slot").applyInArrow(*_arrow.groups(_backoff(r, n_tokens, n_words, hot, hot_weights), "kind int, batch bigint, blob binary"))
    sums = told.where("kind in (0, 1)").select("kind", "batch", "blob").unionByName(weights)
    scored = sums.groupBy("batch").applyInArrow(*_arrow.groups(_scores(r, n_train), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"))
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("bigint"))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string")) % 10
    return score_documents(docs, learn=rest != 0, hold=rest == 0).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
