"""Substring dedup by level-wise doubling.

Level 0 hashes every window of `words` consecutive words of every document and
finds those that start in more than one document.  A window twice as long can
only repeat where both of its halves do, so each further level looks at the
windows that the level before left over, joined to the window that follows
them, and drops those that repeat no more; it ends when none is left.  A word is
removed if a window of level 0 covers it whose words also start in a document of
a smaller id; the levels tell how long the passages are.

Windows travel as sorted, packed columns: a task packs the windows of a batch of
documents into one blob for each range of hashes, and a range answers with one
blob for each batch.  Only level 0 sends all windows.  Hashes have 64 bits;
those of level 1 and above are combined from the level before.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow, _blobs, _words
from planweave.session import discard, release, stored

# kind 0: windows (a batch's in a range, or a range's answer); kind 1: the batch's documents (id, key of the text).
SENT = "slot int, kind int, batch bigint, blob binary"
ANSWER = "kind int, batch bigint, blob binary"
LEVEL = "batch bigint, docs binary, blob binary"
#: Texts of fewer bytes leave too few shuffle files to wait for their removal.
TIDY_BYTES = 64 << 20


def _runs(a: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(a), 1), bool), a[1:] != a[:-1]]))


def _send(slots: int, batch: int, h: np.ndarray, place: np.ndarray, owner: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """A batch's windows, a blob for each range of hashes, and its documents."""
    order = np.argsort(h, kind="stable")
    h, place, owner = h[order], place[order], owner[order]
    slot = _blobs.slot(h, slots)
    cut = np.append(_runs(slot), len(h))
    names, kinds, blobs = [batch % slots], [1], [_blobs.pack(ids, keys)]
    for a, b in zip(cut, cut[1:]):
        docs, local = np.unique(owner[a:b], return_inverse=True)
        names.append(int(slot[a])), kinds.append(0)
        blobs.append(_blobs.pack(_blobs.delta(h[a:b]), local, place[a:b], docs, ids[docs]))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(kinds, pa.int32()), pa.array([batch] * len(names), pa.int64()), pa.array(blobs, pa.binary())], names=["slot", "kind", "batch", "blob"])


def _first_windows(words: int, slots: int, most: int = 2 << 20):
    """Level 0 of batches of about `most` windows.  Documents with a null id have none."""

    def run(batches):
        from pyspark import TaskContext

        hasher = _words.Hasher(False)
        parts: list = []
        n, batch_no = 0, TaskContext.get().partitionId() << 24

        def out():
            shift, owners = 0, []
            for p in parts:
                owners.append(p[2] + np.uint32(shift))
                shift += len(p[3])
            h, place, ids, keys = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3, 4))
            parts.clear()
            return _send(slots, batch_no, h, place, np.concatenate(owners), ids, keys)

        for batch in batches:
            for at, texts in _words.pieces(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts))
                data, offsets = _words.buffers(texts)
                starts, ends, first = _words.spans(data, offsets)
                h, place = _words.windows(hasher.words(data, starts, ends), first, words)
                owner = np.searchsorted(first, place, "right") - 1
                ok = ids.is_valid().to_numpy(zero_copy_only=False)[owner]
                h, place, owner = h[ok], (place - first[owner])[ok].astype(np.uint32), owner[ok].astype(np.uint32)
                raw = data.tobytes()
                keys = np.array([_words.text_key(raw[a:b]) for a, b in zip(offsets, offsets[1:])], np.int64)
                parts.append((h, place, owner, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), keys))
                n += len(h)
                if n >= most:
                    yield out()
                    n, batch_no = 0, batch_no + 1
        if parts:
            yield out()

    return run


def _next_windows(length: int, slots: int):
    """Windows of twice the length, from the places and hashes of those of `length` words."""

    def run(batches):
        for batch in batches:
            for no, docs, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                owner, place, h, _ = _blobs.unpack(blob)
                at_word = owner << np.uint64(32) | place
                after = at_word + np.uint64(length)
                at = np.minimum(np.searchsorted(at_word, after), len(at_word) - 1)
                ok = at_word[at] == after
                if ok.any():
                    joined = _words.mix(h[ok] * np.uint64(0xD1342543DE82EF95) + h[at[ok]] + np.uint64(length))
                    ids, keys = (c.view(np.int64) for c in _blobs.unpack(docs))
                    yield _send(slots, no, joined, place[ok].astype(np.uint32), owner[ok].astype(np.uint32), ids, keys)

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Of a range of hashes: the windows that start in more than one document, by batch, and whether a smaller id has them."""
    out, cols = [], []
    for kind, batch, blob in zip(*(table.column(c).to_pylist() for c in ("kind", "batch", "blob"))):
        if kind == 1:
            out.append((1, batch, blob))
            continue
        steps, local, place, docs, ids = _blobs.unpack(blob)
        local = local.astype(np.int64)
        cols.append((batch, _blobs.undelta(steps), docs[local].astype(np.uint32), place.astype(np.uint32), ids.view(np.int64)[local]))
    if cols:
        h = np.concatenate([c[1] for c in cols])
        ids = np.concatenate([c[4] for c in cols])
        ends = np.cumsum([len(c[1]) for c in cols])
        order = np.argsort(h, kind="stable")
        heads = _runs(h[order])
        size = np.diff(np.append(heads, len(h)))
        own = ids[order]
        least, most = np.minimum.reduceat(own, heads), np.maximum.reduceat(own, heads)
        keep, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
        keep[order] = np.repeat(least != most, size)
        later[order] = own > np.repeat(least, size)
        for (batch, hashes, docs, place, _), a, b in zip(cols, np.append(0, ends[:-1]), ends):
            at = np.flatnonzero(keep[a:b])
            if len(at):
                out.append((0, batch, _blobs.pack(_blobs.delta(hashes[at]), docs[at], place[at], later[a:b][at].astype(np.uint8))))
    return pa.table([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.binary()))], names=["kind", "batch", "blob"])


def _gathered(table: pa.Table) -> pa.Table:
    """A batch's repeated windows in the order of its words; no row if there are none."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("kind", "batch", "blob"))))
    found = [_blobs.unpack(b) for k, _, b in rows if k == 0]
    if not found:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.binary())], names=["batch", "docs", "blob"])
    h = np.concatenate([_blobs.undelta(f[0]) for f in found])
    owner, place, later = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3))
    order = np.lexsort((place, owner))
    blob = _blobs.pack(owner[order], place[order], h[order], later[order])
    return pa.table([pa.array([rows[0][1]], pa.int64()), pa.array([next(b for k, _, b in rows if k == 1)], pa.binary()), pa.array([blob], pa.binary())], names=["batch", "docs", "blob"])


def _level(windows: DataFrame) -> DataFrame:
    answers = windows.groupBy("slot").applyInArrow(*_arrow.groups(_repeated, ANSWER))
    return stored(answers.groupBy("batch").applyInArrow(*_arrow.groups(_gathered, LEVEL)), "substrings")


def _documents(length: int, places: bool):
    """A row for each document with repeated windows of a level, and with `places` those that also start in a smaller id."""

    def run(batches):
        for batch in batches:
            for docs, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                owner, place, _, later = _blobs.unpack(blob)
                ids, keys = (c.view(np.int64) for c in _blobs.unpack(docs))
                heads = _runs(owner)
                at = owner[heads].astype(np.int64)
                gone = [None] * len(at)
                if places:
                    for i, (a, b) in enumerate(zip(heads, np.append(heads[1:], len(owner)))):
                        p = place[a:b][later[a:b] > 0]
                        gone[i] = _blobs.pack(_blobs.delta(p)) if len(p) else None
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(keys[at]), pa.array([length] * len(at), pa.int64()), pa.array(gone, pa.binary())], names=["doc_id", "text_key", "length", "gone"])

    return run


def _kept(words: int):
    def run(batches):
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            out: list[list] = [[], [], [], []]
            for s, blob in zip(col["text"].to_pylist(), col["gone"].to_pylist()):
                ws = (s or "").encode().split()
                n = len(ws)
                gone = 0
                if blob:
                    at = _blobs.undelta(_blobs.unpack(blob)[0]).astype(np.int64)
                    steps = np.zeros(n + 1, np.int64)
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + words, -1)
                    stay = np.cumsum(steps[:n]) == 0
                    gone = int(n - stay.sum())
                    ws = [w for w, k in zip(ws, stay) if k]
                kept = b" ".join(ws)
                for c, v in zip(out, (n, gone, hashlib.sha256(kept).hexdigest(), kept.decode())):
                    c.append(v)
            names = [c for c in batch.schema.names if c not in ("text", "gone")]
            made = {"n_words": pa.array(out[0], pa.int64()), "n_removed": pa.array(out[1], pa.int64()), "kept_sha256": pa.array(out[2], pa.string())}
            if "kept_text" in names:
                made["kept_text"] = pa.array(out[3], pa.string())
            yield pa.RecordBatch.from_arrays([made.get(c, col.get(c)) for c in names] + [made[c] for c in ("n_words", "n_removed", "kept_sha256")], names=names + ["n_words", "n_removed", "kept_sha256"])

    return run


def _hash_of_text(batches):
    for batch in batches:
        keys = [_words.text_key((s or "").encode()) for s in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), batch.column(1)], names=["doc_id", "text_key", "text"])


def dedup_substrings(docs: DataFrame, words: int = 13, text: str = "text", id: str = "doc_id", texts: bool = False, slots: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, longest_repeat, and kept_text with `texts`; one row per row of docs.

    longest_repeat is the length in words of the longest window of a level
    (words, 2 * words, 4 * words, ...) that also starts in another document, 0
    if none does.  Windows are judged on the input, not on what is left.  A null
    text has no words.  Documents of one id never remove from each other, and a
    row with a null id neither loses words nor costs others theirs.  An empty
    table gives no rows.  docs should be a scan or a stored table, so that a task
    that runs again deals the same batches.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # A word and the space after it take six bytes or so.
    size = int(plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    slots = slots or _blobs.ranges(spark, size // 6)
    tidy = release if size > TIDY_BYTES else lambda spark: None
    now = _level(plain.mapInArrow(*_arrow.batches(_first_windows(words, slots), SENT)))
    tidy(spark)
    found, length = [], words
    row = "doc_id bigint, text_key bigint, length bigint, gone binary"
    while not now.isEmpty():
        found.append(stored(now.mapInArrow(*_arrow.batches(_documents(length, length == words), row)), "substrings"))
        after = _level(now.mapInArrow(*_arrow.batches(_next_windows(length, slots), SENT)))
        discard(now)
        tidy(spark)
        now, length = after, 2 * length
    told = spark.createDataFrame([], row)
    for f in found:
        told = told.unionByName(f)
    # Rows of one id and text tell the same twice.
    told = told.groupBy("doc_id", "text_key").agg(F.max("length").alias("longest_repeat"), F.max("gone").alias("gone"))
    keyed = plain.mapInArrow(*_arrow.batches(_hash_of_text, "doc_id bigint, text_key bigint, text string"))
    rows = keyed.join(told, ["doc_id", "text_key"], "left").select("doc_id", F.coalesce("longest_repeat", F.lit(0).cast("bigint")).alias("longest_repeat"), *([F.lit("").alias("kept_text")] if texts else []), "text", "gone")
    return rows.mapInArrow(*_arrow.batches(_kept(words), "doc_id bigint, longest_repeat bigint, " + ("kept_text string, " if texts else "") + "n_words bigint, n_removed bigint, kept_sha256 string"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", "longest_repeat")


def _op2_sql(words: int = 13, levels: int = 12) -> str:
    """The levels written out: up to `levels` doublings, so for texts of fewer than words * 2 ** (levels + 1) words."""
    parts = [
        rf"""w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g0 AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + {words - 1}], ' ')) AS h FROM w, unnest(range(1, greatest(len(ws) - {words - 2}, 1))) AS t(i)
), m0 AS (
  SELECT h, min(doc_id) AS least FROM g0 GROUP BY h HAVING min(doc_id) < max(doc_id)
), r0 AS (
  SELECT g0.doc_id, g0.i, g0.h, g0.doc_id > m0.least AS later FROM g0 JOIN m0 ON g0.h = m0.h
)"""
    ]
    for k in range(1, levels + 1):
        parts.append(
            f"""g{k} AS (
  SELECT a.doc_id, a.i, md5(a.h || b.h) AS h FROM r{k - 1} a JOIN r{k - 1} b ON a.doc_id = b.doc_id AND b.i = a.i + {words << (k - 1)}
), m{k} AS (
  SELECT h FROM g{k} GROUP BY h HAVING min(doc_id) < max(doc_id)
), r{k} AS (
  SELECT g{k}.doc_id, g{k}.i, g{k}.h FROM g{k} JOIN m{k} ON g{k}.h = m{k}.h
)"""
        )
    lengths = " UNION ALL ".join(f"SELECT DISTINCT doc_id, {words << k} AS n FROM r{k}" for k in range(levels + 1))
    parts.append(
        rf"""l AS (
  SELECT doc_id, max(n) AS n FROM ({lengths}) GROUP BY doc_id
), p AS (
  SELECT DISTINCT doc_id, i + k AS at FROM r0, unnest(range(0, {words})) AS u(k) WHERE later
), x AS (
  SELECT w.doc_id, t.i, w.ws[t.i] AS word FROM w, unnest(range(1, len(w.ws) + 1)) AS t(i)
), k AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS kept, count(*) AS n
  FROM x LEFT JOIN p ON x.doc_id = p.doc_id AND x.i = p.at WHERE p.at IS NULL GROUP BY x.doc_id
)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, (len(w.ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256, coalesce(l.n, 0)::BIGINT AS longest_repeat
FROM w LEFT JOIN k ON w.doc_id = k.doc_id LEFT JOIN l ON w.doc_id = l.doc_id"""
    )
    return "WITH " + ", ".join(parts)


OP2_SQL = _op2_sql()
