"""Quality classification by co-training.

Two classifiers see a document from two sides: one its text (shares of letters,
marks and capitals, repetition, line shape), one the page's metadata (source,
language, length).  Each is fitted on labelled documents; over some rounds each
gives the unlabelled documents that it is surest about, with its own labels, to
the other.  Both are then calibrated on labelled documents that took no part
(Platt) and their log odds are added, the prior counted once, to score every
document.

Every round looks at every unlabelled document: tasks count confidences by bin,
and the bin that the round's quota ends in is taken by hash.  The fit is bounded
by two parameters: `max_labelled` labelled documents, those of least hash, and
`max_exchanged` pseudo-labels that a view gives in a round.  The features and
scores are of all documents and whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow, _words
from planweave.session import discard, stored

TEXT_FEATURES = (
    "letters", "digits", "marks", "capitals", "spaces", "high_bytes", "word_length", "long_words",
    "same_as_last_word", "distinct_words", "top_word", "marked_words", "bare_marks", "line_words", "stopped_words", "doubled_marks",
)
META_FEATURES = 64  # hashed slots of source and language, then length


def text_features(texts: pa.Array) -> np.ndarray:
    """A row of shares for each text; a text without words has zeros."""
    data, offsets = _words.buffers(texts)
    starts, ends, first = _words.spans(data, offsets)
    n = len(offsets) - 1
    counts = np.diff(first)
    size = np.maximum(np.diff(offsets), 1)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    def per_word(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return (sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1)

    low = (data >= 97) & (data <= 122)
    up = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    high = data >= 128
    mark = ~(low | up | digit | blank | high)
    odd = mark & ~np.isin(data, np.frombuffer(b".,;:'\"-()", np.uint8))
    twice = np.concatenate([[False], odd[1:] & (data[1:] == data[:-1])]) if len(data) else odd
    twice[offsets[:-1][np.diff(offsets) > 0]] = False  # a text doesn't go on from the one before
    hashes = _words.Hasher(True).words(data, starts, ends)
    length = ends - starts
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    same[first[:-1][counts > 0]] = False
    marks_before = np.concatenate([[0], np.cumsum(odd, dtype=np.int64)])
    odd_in = marks_before[ends] - marks_before[starts]
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    stop = (last == 46) | (last == 33) | (last == 63)
    owner = np.repeat(np.arange(n), counts)
    distinct, top = np.zeros(n), np.zeros(n)
    if len(hashes):
        order = np.lexsort((hashes, owner))
        h, o = hashes[order], owner[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
        runs = np.diff(np.append(np.flatnonzero(new), len(h)))
        at = o[new]
        distinct = np.bincount(at, minlength=n) / np.maximum(counts, 1)
        np.maximum.at(top, at, runs)
        top = top / np.maximum(counts, 1)
    lines = per_doc(data == 10) * size + 1
    out = np.stack(
        [
            per_doc(low | up | high), per_doc(digit), per_doc(mark), per_doc(up) / np.maximum(per_doc(low | up), 1e-9), per_doc(blank), per_doc(high),
            np.minimum(per_word(length), 30) / 30, per_word(length > 20), per_word(same), distinct, top,
            per_word(odd_in > 0), per_word(odd_in == length), np.minimum(counts / lines, 400) / 400, per_word(stop), per_doc(twice),
        ],
        axis=1,
    )
    out[counts == 0] = 0
    return out.astype(np.float32)


def features(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", id: str = "doc_id", carry: bool = False) -> DataFrame:
    """doc_id, view_text and view_meta (array<float>), and the documents' own columns in `row` if carry."""
    slot = lambda c, name: F.pmod(F.xxhash64(F.lit(name), F.coalesce(F.col(c).cast("string"), F.lit("\0"))), F.lit(META_FEATURES)).cast("int")
    rows = docs.select(*([F.struct("*").alias("row")] if carry else []), F.col(id).cast("bigint").alias("doc_id"), slot(source, "source").alias("s"), slot(lang, "lang").alias("l"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            texts = col["text"].fill_null("")
            view = np.concatenate([text_features(p) for _, p in _words.pieces(texts)]) if len(texts) else np.zeros((0, len(TEXT_FEATURES)), np.float32)
            size = np.log1p(np.diff(_words.buffers(texts)[1])).astype(np.float32)
            meta = np.stack([col["s"].to_numpy(zero_copy_only=False), col["l"].to_numpy(zero_copy_only=False), size], axis=1).astype(np.float32)
            packed = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([*([col["row"]] if carry else []), col["doc_id"], packed(view), packed(meta)], names=[*(["row"] if carry else []), "doc_id", "view_text", "view_meta"])

    own = f"row {rows.schema['row'].dataType.simpleString()}, " if carry else ""
    return rows.mapInArrow(*_arrow.batches(run, f"{own}doc_id bigint, view_text array<float>, view_meta array<float>"))


class View:
    """Additive logistic regression: every feature is cut at its quantiles and each piece has a weight."""

    def __init__(self, hashed: bool, pieces: int = 12):
        self.hashed, self.pieces = hashed, pieces

    def _rows(self, x: np.ndarray) -> np.ndarray:
        cols = [np.ones((len(x), 1))]
        if self.hashed:
            for j in range(2):
                cols.append((x[:, j : j + 1] == np.arange(META_FEATURES)).astype(float))
            x, cuts = x[:, 2:], self.cuts
        else:
            cuts = self.cuts
        for j, c in enumerate(cuts):
            cols.append((np.searchsorted(c, x[:, j], "right")[:, None] == np.arange(len(c) + 1)).astype(float))
        return np.concatenate(cols, axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> "View":
        plain = x[:, 2:] if self.hashed else x
        self.cuts = [np.unique(np.quantile(plain[:, j], np.linspace(0, 1, self.pieces + 1)[1:-1])) for j in range(plain.shape[1])]
        a = self._rows(x)
        w = np.zeros(a.shape[1])
        penalty = np.full(a.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            v = p * (1 - p) + 1e-6
            w -= np.linalg.solve((a * v[:, None]).T @ a + np.diag(penalty), a.T @ (p - y) + penalty * w)
        self.weights = w
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Log odds: each feature's weight is looked up by its piece."""
        x = np.asarray(x, float)
        z, at = np.full(len(x), self.weights[0]), 1
        if self.hashed:
            for j in range(2):
                z += self.weights[at + x[:, j].astype(np.int64)]
                at += META_FEATURES
            x = x[:, 2:]
        for j, c in enumerate(self.cuts):
            z += self.weights[at + np.searchsorted(c, x[:, j], "right")]
            at += len(c) + 1
        return np.clip(z, -12, 12)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn log odds into calibrated ones."""
    a = np.stack([z, np.ones(len(z))], axis=1)
    w = np.array([1.0, 0.0])
    pos, neg = max(y.sum(), 0.5), max((1 - y).sum(), 0.5)
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        v = p * (1 - p) + 1e-6
        w -= np.linalg.solve((a * v[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (p - t) + 1e-3 * (w - [1, 0]))
    return float(max(w[0], 0.0)), float(w[1])


class CoTraining:
    """The two views, their calibration and the prior; without both labels, or with fewer than 20, every document scores the prior."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, label: np.ndarray):
        self.prior = float((label.sum() + 1) / (len(label) + 2))
        self.ready = len(set(label.tolist())) == 2 and len(label) >= 20
        if not self.ready:
            return
        hold = np.arange(len(label)) % 4 == 0
        self.held = [text[hold], meta[hold], label[hold]]
        self.own = [[v[~hold], label[~hold]] for v in (text, meta)]
        self.models = [View(False), View(True)]
        self.refit()

    def refit(self) -> None:
        """Fit and calibrate both views on what each has now."""
        for m, (x, y) in zip(self.models, self.own):
            m.fit(x, y)
        self.scale = [_platt(m.logit(v), self.held[2]) for m, v in zip(self.models, self.held)]

    def give(self, view: int, want: int, rows: np.ndarray) -> None:
        """Documents, as that view sees them, which the other is sure are of a class."""
        x, y = self.own[view]
        self.own[view] = [np.concatenate([x, rows]), np.concatenate([y, np.full(len(rows), float(want))])]

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: of both views together, of the text's and of the metadata's."""
        if not self.ready:
            p = np.full(len(text), self.prior)
            return p, p, p
        a, b = (s * m.logit(v) + o for m, v, (s, o) in zip(self.models, (text, meta), self.scale))
        both = a + b - np.log(self.prior / (1 - self.prior))
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (both, a, b))


BINS = 16  # of confidence, for each unit of log odds


def _block(col: pa.Array, width: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), float).reshape(len(col), width)


def _views(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [_block(batch.column(batch.schema.get_field_index(c)), w) for c, w in (("view_text", len(TEXT_FEATURES)), ("view_meta", 3))]


def _sure(model: CoTraining, taken: list[np.ndarray], sure: float):
    """Of a batch: (giving view, class, rows it is sure of that the other doesn't have yet, their bins)."""
    least = np.log(sure / (1 - sure))

    def of(batch: pa.RecordBatch):
        h = batch.column(batch.schema.get_field_index("h")).to_numpy()
        views = _views(batch)
        for i in (0, 1):
            z = model.models[i].logit(views[i])
            fresh = ~np.isin(h, taken[1 - i])
            for want in (0, 1):
                at = np.flatnonzero(fresh & ((z if want else -z) >= least))
                yield i, want, at, (np.abs(z[at]) * BINS).astype(np.int32), h, views[1 - i]

    return of


def _confidences(model: CoTraining, taken: list[np.ndarray], sure: float):
    def run(batches):
        total = np.zeros((2, 2, 12 * BINS + 1), np.int64)
        for batch in batches:
            for i, want, _, bins, _, _ in _sure(model, taken, sure)(batch):
                total[i, want] += np.bincount(bins, minlength=total.shape[2])
        i, want, bin_ = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(want.astype(np.int32)), pa.array(bin_.astype(np.int32)), pa.array(total[i, want, bin_])], names=["view", "want", "bin", "n"])

    return run


def _chosen(model: CoTraining, taken: list[np.ndarray], sure: float, bounds: dict):
    """The rows above a bin, and those in it with a hash up to a bound."""

    def run(batches):
        for batch in batches:
            for i, want, at, bins, h, other in _sure(model, taken, sure)(batch):
                if (i, want) in bounds:
                    last, bound = bounds[i, want]
                    at = at[(bins > last) | ((bins == last) & (h[at] <= bound))]
                    rows = other[at]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(at), pa.int32()), pa.array([want] * len(at), pa.int32()), pa.array(h[at]), lists], names=["view", "want", "h", "other"])

    return run


def fit(feats: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality", max_labelled: int = 20_000, max_exchanged: int = 1_000, rounds: int = 5, sure: float = 0.95) -> CoTraining:
    """Fit on labelled documents and exchange pseudo-labels for all others.

    Labels that are null or disagree for one document are left out.  Of more
    than max_labelled labelled documents those of least hash are used; rows that
    repeat wholly share a hash.  In a round a view gives about max_exchanged
    documents, by class as the prior has it, those that it is surest of.
    """
    votes = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).cast("bigint").alias("doc_id")).agg(F.min(label).alias("y"), F.max(label).alias("y2"))
    marked = feats.join(votes, "doc_id", "left").withColumn("h", F.xxhash64("doc_id", "view_text", "view_meta"))
    agreed = marked.where("y = y2")
    # About twice as many by a bound on the hash first, so that tasks don't send `max_labelled` rows each.
    bound = (1 << 64) * min(1.0, 2 * (max_labelled + 100) / max(agreed.count(), 1)) - (1 << 63)
    known = agreed.where(F.col("h") <= F.lit(min(int(bound), (1 << 63) - 1))).orderBy("h", "doc_id").limit(max_labelled).toPandas()
    block = lambda c, width: np.array(known[c].tolist(), float).reshape(len(known), width)
    model = CoTraining(block("view_text", len(TEXT_FEATURES)), block("view_meta", 3), known["y"].to_numpy(float))
    if not model.ready:
        return model
    pool = stored(marked.where("y is null").select("h", "view_text", "view_meta"), "quality")
    taken = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
    for _ in range(rounds):
        counted = pool.mapInArrow(*_arrow.batches(_confidences(model, taken, sure), "view int, want int, bin int, n bigint")).groupBy("view", "want", "bin").agg(F.sum("n").alias("n")).toPandas()
        bounds = {}
        for (i, want), rows in counted.groupby(["view", "want"]):
            left = max(1, int(max_exchanged * (model.prior if want else 1 - model.prior)))
            for bin_, n in rows.sort_values("bin", ascending=False)[["bin", "n"]].itertuples(index=False):
                bounds[int(i), int(want)] = (int(bin_), min(int((1 << 64) * min(1.0, left / n)) - (1 << 63), (1 << 63) - 1))
                left -= n
                if left <= 0:
                    break
        if not bounds:
            break
        given = pool.mapInArrow(*_arrow.batches(_chosen(model, taken, sure, bounds), "view int, want int, h bigint, other array<double>")).orderBy("view", "want", "h").toPandas()
        for (i, want), rows in given.groupby(["view", "want"]):
            model.give(1 - int(i), int(want), np.array(rows["other"].tolist(), float))
            taken[1 - int(i)] = np.union1d(taken[1 - int(i)], rows["h"].to_numpy(np.int64))
        model.refit()
    discard(pool)
    return model


def score(feats: DataFrame, model: CoTraining) -> DataFrame:
    """feats with score, score_text and score_meta."""

    def run(batches):
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            both, a, b = model.score(*_views(batch)) if len(batch) else (np.zeros(0),) * 3
            keep = [c for c in batch.schema.names if c not in ("view_text", "view_meta")]
            yield pa.RecordBatch.from_arrays([*(col[c] for c in keep), pa.array(both), pa.array(a), pa.array(b)], names=[*keep, "score", "score_text", "score_meta"])

    kept = feats.drop("view_text", "view_meta")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields)
    return feats.mapInArrow(*_arrow.batches(run, f"{fields}, score double, score_text double, score_meta double"))


def classify(docs: DataFrame, labels: DataFrame, carry: bool = False, threshold: float = 0.5, **limits) -> DataFrame:
    """doc_id, score (of good quality), score_text, score_meta, kept; with carry also the columns of docs in `row`.

    A null or empty text has zero features; null metadata is a value of its own.
    Repeated rows score alike.  With fewer than 20 labelled documents, or labels
    of one kind, nothing is fitted and every document scores the smoothed share of good ones and, at 0.5 or more, stays.
    """
    feats = stored(features(docs), "quality")
    model = fit(feats, labels, **limits)
    if carry:
        discard(feats)
    return score(features(docs, carry=True) if carry else feats, model).withColumn("kept", F.col("score") >= threshold)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
