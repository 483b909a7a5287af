"""MinHash near-duplicates verified by odd sketches and confirmed on full shingle sets.

Documents with equal shingle sets are one node from the start.  Every node has
`samples` MinHash values in bands; nodes that agree in a band share a bucket.
The MinHash values are also folded into a parity bitmap (odd sketch): the
population count of two bitmaps' XOR estimates how many values differ, precisely
where similarity is high, and rules out pairs far below the threshold.  A second
bitmap holds the parities of the whole set; its XOR's population count is never
above the number of shingles in which two sets differ, so what it rules out is
ruled out for certain.

Links are looked for in two steps, and no bucket is ever expanded into all of
its pairs.  First every member is held against the bucket's lead, the node that
meets the most others over all bands.  Then, in buckets whose members are still
in different components, the members outside the bucket's largest component
seek links among the others: the most similar sketches first, and once those
are joined, all others that are still in another component.  A pair is looked
at in the first band that it shares only.  Links are confirmed on the full sets
of both documents, so none is missed between components that shares a band and
passes the sketch.

At similarity 0.8 a pair shares none of 32 bands of 4 rows with probability
5e-8, and the sketch's margin rules it out with less than 1e-8.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow, _blobs, _words
from planweave.operators.components import connected_components
from planweave.session import discard, release, stored

SAMPLES, ROWS, BITS = 128, 4, 512
MARGIN = 0.22
BLOCK = 4096


def shingle_sets(texts: pa.Array, words: int, hasher: _words.Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each document in turn, first of each document and the total)."""
    data, offsets = _words.buffers(texts)
    starts, ends, first = _words.spans(data, offsets)
    h = hasher.words(data, starts, ends)
    counts = np.diff(first)
    shingle, at = _words.windows(h, first, words)
    owner = np.searchsorted(first, at, "right") - 1
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            has = counts[short] > k
            whole[has] = whole[has] * np.uint64(0xD1342543DE82EF95) + h[first[short[has]] + k]
        shingle = np.concatenate([shingle, _words.mix(whole ^ counts[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    if len(shingle):
        new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])])
        shingle, owner = shingle[new], owner[new]
    return shingle, np.searchsorted(owner, np.arange(len(offsets)))


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    s = _words.mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return s[:n] | np.uint64(1), s[n:]


def sketches(shingle: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, odd sketches) of the documents that have shingles."""
    heads = first[:-1][np.diff(first) > 0]
    a, b = _seeds(SAMPLES)
    n = len(heads)
    keys = np.zeros((n, SAMPLES // ROWS), np.uint64)
    odd = np.zeros((n, BITS // 64), np.uint64)
    if n:
        for i in range(SAMPLES):
            least = np.minimum.reduceat(shingle * a[i] + b[i], heads)
            keys[:, i // ROWS] = _words.mix(keys[:, i // ROWS] * np.uint64(0xD1342543DE82EF95) + least + np.uint64(i))
            bit = _words.mix(least ^ a[i]) % np.uint64(BITS)
            odd[np.arange(n), (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
    return keys, odd


def most_apart(threshold: float) -> int:
    """The largest population count of two sketches' XOR at which a pair is still confirmed on its sets."""
    low = max(0.0, threshold - MARGIN)
    return math.ceil(BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * SAMPLES * (1 - low)))) + 12


def estimate(apart: np.ndarray) -> np.ndarray:
    """The similarity that the odd sketches' distance stands for."""
    return 1 + BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * np.asarray(apart, float) / BITS, 1e-9))


def parities(shingle: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The parity bitmap of each whole set: a power of two of bits, 512 at least, twice the set's size or more."""
    out = []
    for a, b in zip(first, first[1:]):
        bits = 512
        while bits < 2 * (b - a):
            bits *= 2
        odd = np.bincount((shingle[a:b] % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8)).tobytes())
    return out


def _folded(blob: bytes, size: int) -> np.ndarray:
    """A parity bitmap in fewer bytes: its halves XORed, again and again."""
    x = np.frombuffer(blob, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.view(np.uint64)


def differ(x: np.ndarray, y: np.ndarray, blobs: list[bytes]) -> np.ndarray:
    """At least so many shingles differ between the sets x[i] and y[i]."""
    sizes = np.array([len(b) for b in blobs])
    least = np.minimum(sizes[x], sizes[y])
    out = np.zeros(len(x), np.int64)
    for size in np.unique(least).tolist():
        at = np.flatnonzero(least == size)
        rows, inverse = np.unique(np.concatenate([x[at], y[at]]), return_inverse=True)
        bits = np.stack([_folded(blobs[i], size) for i in rows.tolist()])
        for k in range(0, len(at), 1 << 16):
            a, b = inverse[k : min(k + (1 << 16), len(at))], inverse[len(at) + k : len(at) + k + (1 << 16)]
            out[at[k : k + (1 << 16)]] = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1)
    return out


def _fixed(a: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel().view(np.int64)))


def _sketch_rows(words: int):
    def run(batches):
        hasher = _words.Hasher(True)
        for batch in batches:
            for at, texts in _words.pieces(batch.column(1)):
                shingle, first = shingle_sets(texts, words, hasher)
                n = np.diff(first)
                has = n > 0
                sums = lambda x: np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])[first])
                k1, k2 = sums(_words.mix(shingle)), sums(_words.mix(shingle ^ np.uint64(0xA0761D6478BD642F)))
                keys, odd = sketches(shingle, first)
                rows = np.full(len(n), -1)
                rows[has] = np.arange(has.sum())
                pick = pa.array(rows, mask=~has)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(k1.view(np.int64), mask=~has), pa.array(k2.view(np.int64), mask=~has),
                        _fixed(keys, pa.int64()).take(pick), _fixed(odd, pa.int64()).take(pick), pa.array(parities(shingle, first), pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "odd", "parity"],
                )

    return run


def _set_rows(words: int):
    def run(batches):
        hasher = _words.Hasher(True)
        for batch in batches:
            for at, texts in _words.pieces(batch.column(1)):
                shingle, first = shingle_sets(texts, words, hasher)
                blobs = [_blobs.pack(_blobs.delta(shingle[a:b])) for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(blobs, pa.binary())], names=["node", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            held, last = None, None
            for i in range(len(a)):
                if a[i] != last:
                    held, last = _blobs.undelta(_blobs.unpack(x[i])[0]), a[i]
                other = _blobs.undelta(_blobs.unpack(y[i])[0])
                both = len(np.intersect1d(held, other, assume_unique=True))
                if 100 * both >= percent * (len(held) + len(other) - both):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    return run


def _apart(x: str, y: str):
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def _sought(most: int, percent: int, low: int, high: int | None):
    """Of each block of a bucket: its seekers' partners in other components that may be linked, ranked in [low, high) by sketch distance."""

    def of_block(t: dict, a: int, b: int):
        ids, member, comp, size = t["id"][a:b], t["member"][a:b], t["component"][a:b], t["n_shingles"][a:b]
        odd, bands, key = t["odd"][a:b], t["bands"][a:b], t["k"][a]
        m, s = np.flatnonzero(member), np.flatnonzero(t["seeks"][a:b])
        if not len(m) or not len(s):
            return
        take = len(m) if high is None else min(high, len(m))
        for k in range(0, len(s), step := max(1, (1 << 20) // len(m))):
            rows = s[k : k + step]
            z = np.bitwise_count(odd[rows][:, None, :] ^ odd[m][None, :, :]).sum(axis=2, dtype=np.int32)
            z[ids[rows][:, None] == ids[m][None, :]] = BITS + 1
            order = np.argsort(z, axis=1, kind="stable")[:, low:take]
            r, c = np.nonzero(np.take_along_axis(z, order, axis=1) <= most)
            x, y = rows[r], m[order[r, c]]
            ok = (comp[x] != comp[y]) & (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))
            x, y = x[ok], y[ok]
            for i in range(0, len(x), 1 << 16):
                p, q = x[i : i + (1 << 16)], y[i : i + (1 << 16)]
                first = (bands[p] == bands[q]).argmax(axis=1)
                ok = bands[p, first] == key
                p, q = p[ok], q[ok]
                ok = differ(p, q, t["parity"][a:b]) * (100 + percent) <= (size[p] + size[q]) * (100 - percent) if len(p) else ok[:0]
                yield ids[p[ok]], ids[q[ok]]

    def run(batches):
        def flush(t: pa.Table):
            t = t.combine_chunks()
            cols = {c: t.column(c).to_numpy() for c in ("k", "mb", "eb", "id", "member", "seeks", "component", "n_shingles")}
            for c, n in (("odd", BITS // 64), ("bands", SAMPLES // ROWS)):
                cols[c] = t.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, n)
            cols["k"] = cols["k"].view(np.uint64)
            cols["parity"] = t.column("parity").to_pylist()
            k, mb, eb = cols["k"], cols["mb"], cols["eb"]
            cut = np.flatnonzero((k[1:] != k[:-1]) | (mb[1:] != mb[:-1]) | (eb[1:] != eb[:-1])) + 1
            found = [f for a, b in zip(np.append(0, cut), np.append(cut, len(k))) if b - a > 1 for f in of_block(cols, a, b)]
            x = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
            y = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        carry = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if carry is not None and len(carry):
                t = pa.concat_tables([carry, t])
            if not len(t):
                continue
            k, mb, eb = (t.column(c).to_numpy() for c in ("k", "mb", "eb"))
            other = np.flatnonzero((k != k[-1]) | (mb != mb[-1]) | (eb != eb[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield flush(t.slice(0, cut))
            carry = t.slice(cut)
        if carry is not None and len(carry):
            yield flush(carry)

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (the least id reachable) and kept, one row per row of docs.

    Documents are linked with 100 * intersection >= percent * union of their sets
    of distinct `words`-word shingles, A-Z in lower case; with fewer words the
    whole sequence is the one shingle.  A null or empty text has no shingles and
    no links.  Rows with a null id link with nothing, have a null component and
    stay; rows of one id are one document.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    base = stored(plain.mapInArrow(*_arrow.batches(_sketch_rows(words), "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>, odd array<bigint>, parity binary")), "neardup")
    whole = base.where("doc_id is not null and k1 is not null")
    least = whole.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    nodes = stored(whole.join(least, (whole.doc_id == least.node) & (whole.k1 == least.k1) & (whole.k2 == least.k2), "left_semi").dropDuplicates(["doc_id", "k1", "k2"]).select("doc_id", "n_shingles", "bands", "odd", "parity"), "neardup")

    banded = nodes.select(F.col("doc_id").alias("id"), F.explode("bands").alias("k"))
    shared = banded.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    buckets = stored(banded.join(shared, "k").select("k", "id", "n"), "neardup")
    met = buckets.groupBy("id").agg(F.sum("n").alias("met"))
    leads = buckets.join(met, "id").groupBy("k").agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("lead"))
    most = most_apart(percent / 100)
    sizes = nodes.select(F.col("doc_id").alias("id"), "n_shingles", "odd")

    involved = buckets.select(F.col("id").alias("node")).distinct()
    texts = plain.join(involved, plain.doc_id == involved.node, "left_semi")
    sets = stored(texts.mapInArrow(*_arrow.batches(_set_rows(words), "node bigint, shingles binary")).dropDuplicates(["node", "shingles"]), "neardup")
    release(spark)

    def confirmed(pairs: DataFrame, sketched: bool) -> DataFrame:
        p = pairs
        if not sketched:
            of = lambda s: sizes.select(F.col("id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("odd").alias(f"odd_{s}"))
            p = p.join(of("a"), "a").join(of("b"), "b").where(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
            p = p.where(_apart("odd_a", "odd_b") <= most).select("a", "b")
        of = lambda s, x: sets.select(F.col("node").alias(s), F.col("shingles").alias(x))
        return p.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(*_arrow.batches(_confirm(percent), "a bigint, b bigint"))

    edges = stored(confirmed(buckets.join(leads, "k").where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), False), "neardup")
    labels = stored(connected_components(edges), "neardup")

    def labelled(t: DataFrame, labels: DataFrame) -> DataFrame:
        return t.join(labels.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))

    def unresolved(t: DataFrame, labels: DataFrame) -> DataFrame:
        t = labelled(t, labels)
        open_ = t.groupBy("k").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("k")
        return t.join(open_, "k", "left_semi")

    # Who seeks is settled once: all members but those of the bucket's largest component.
    first = unresolved(buckets.select("k", "id"), labels)
    by_size = first.groupBy("k", "component").agg(F.count("*").alias("m"))
    largest = by_size.groupBy("k").agg(F.max_by("component", F.struct("m", -F.col("component"))).alias("main"), F.sum("m").alias("n"), (F.sum("m") - F.max("m")).alias("n_seek"))
    seekers = first.join(largest, "k").withColumn("seeks", F.col("component") != F.col("main"))
    open_ = stored(seekers.select("k", "id", "seeks", "n", "n_seek").join(nodes.withColumnRenamed("doc_id", "id"), "id"), "neardup")
    blocks = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    block = lambda c: F.pmod(F.xxhash64("id"), blocks(c)).cast("int")
    cols = ["k", "mb", "eb", "id", "seeks", "member", "component", "n_shingles", "odd", "bands", "parity"]
    done = [nodes, buckets, sets, open_, edges, labels]
    for low, high in ((0, 8), (8, None)):
        now = unresolved(open_, labels)
        small = now.where(F.col("n") <= BLOCK).withColumn("mb", F.lit(0)).withColumn("eb", F.lit(0)).withColumn("member", F.lit(True))
        large = now.where(F.col("n") > BLOCK)
        members = large.withColumn("mb", block("n")).withColumn("eb", F.explode(F.sequence(F.lit(0), blocks("n_seek") - 1))).withColumn("member", F.lit(True)).withColumn("seeks", F.lit(False))
        asking = large.where("seeks").withColumn("eb", block("n_seek")).withColumn("mb", F.explode(F.sequence(F.lit(0), blocks("n") - 1))).withColumn("member", F.lit(False))
        rows = small.select(cols).unionByName(members.select(cols)).unionByName(asking.select(cols))
        spread = rows.repartition("k", "mb", "eb").sortWithinPartitions("k", "mb", "eb", "id")
        found = stored(spread.mapInArrow(*_arrow.batches(_sought(most, percent, low, high), "a bigint, b bigint")).distinct(), "neardup")
        more = stored(confirmed(found, True), "neardup")
        done += [found, more]
        if not more.isEmpty():
            edges = edges.unionByName(more)
            labels = stored(connected_components(edges), "neardup")
            done.append(labels)

    for t in done:  # only base and the last labels are read by the result
        if t is not labels:
            discard(t)
    release(spark)
    of_key = least.join(labels, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    out = base.select("doc_id", "n_shingles", "k1", "k2").join(of_key, ["k1", "k2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), words=4)


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 3], ' ') END AS g
  FROM w, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS t(i) WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), r AS (
  SELECT s.doc_id, s.g, n.n FROM s JOIN n USING (doc_id)
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM r a JOIN r b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)
), e2 AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), c(a, b) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT c.a, e2.b FROM c JOIN e2 ON c.b = e2.a
)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c.b)::BIGINT AS component_id, w.doc_id = min(c.b) AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN c ON c.a = w.doc_id GROUP BY w.doc_id
"""
