"""Vectors in blocks: what the two embedding operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(vector: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a list column of one length, as doubles."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    n = len(lists)
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def pack(vectors: np.ndarray) -> bytes:
    """Rows as bytes: the shape, then the values as they are."""
    return np.array(vectors.shape, np.int64).tobytes() + vectors.dtype.str.encode().ljust(8) + np.ascontiguousarray(vectors).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    n, d = np.frombuffer(blob, np.int64, 2)
    kind = np.dtype(bytes(blob[16:24]).strip().decode())
    return np.frombuffer(blob, kind, int(n * d), 24).reshape(int(n), int(d))


def pack_all(arrays: list[np.ndarray]) -> bytes:
    """Several arrays of one or two dimensions as bytes."""
    parts = [pack(np.atleast_2d(a)) for a in arrays]
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def unpack_all(blob: bytes) -> list[np.ndarray]:
    """The arrays of pack_all(), all with two dimensions."""
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    view, at, out = memoryview(blob), 8 * (n + 1), []
    for size in np.frombuffer(blob, np.int64, n, 8).tolist():
        out.append(unpack(view[at : at + size]))
        at += size
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest signed type."""
    low, high = (int(a.min()), int(a.max())) if a.size else (0, 0)
    return a.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


#: Most blocks of queries that meet a holder in one task: more make a lost task dear.
MOST_BLOCKS = 64


def meet(holders: DataFrame, asks: DataFrame, group: list[str]) -> DataFrame:
    """Every block of queries meets every holder of its group; rows with kind 0 (a holder) or 1 (queries), dealt and sorted.

    A task's rows are, one after another, a holder and up to `each` blocks of
    queries, so it holds one of each at a time.  Queries travel once for each
    holder; a holder, which is larger, only once for `each` blocks of queries.
    `each` is what gives every shuffle partition some tasks' work, 1 at least
    and MOST_BLOCKS at most.  holders have `block` and asks `q_block`, both
    counted from 0 within the group; both should be stored tables.
    """
    met = holders.groupBy(*group).agg(F.count("*").alias("a")).join(asks.groupBy(*group).agg(F.count("*").alias("b")), group)
    pairs = int(met.agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0)
    each = max(1, min(MOST_BLOCKS, pairs // (4 * int(holders.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    n_holders = holders.groupBy(*group).agg(F.max("block").alias("top"))
    n_salts = asks.groupBy(*group).agg(F.floor(F.max("q_block") / F.lit(each)).cast("int").alias("top"))
    one = holders.join(n_salts, group).withColumn("salt", F.explode(F.sequence(F.lit(0), "top"))).withColumn("q_block", F.lit(-1))
    many = asks.join(n_holders, group).withColumn("block", F.explode(F.sequence(F.lit(0), "top"))).withColumn("salt", F.floor(F.col("q_block") / F.lit(each)).cast("int"))
    both = one.withColumn("kind", F.lit(0)).unionByName(many.withColumn("kind", F.lit(1)), allowMissingColumns=True).drop("top")
    key = [*group, "block", "salt"]
    return both.repartition(*key).sortWithinPartitions(*key, "kind", "q_block")


def blocked(rows: DataFrame, group: list[str], id: str, size: int) -> DataFrame:
    """rows with `block`: each group is dealt by a hash of the id to blocks of about `size` rows."""
    counts = rows.groupBy(*group).agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("n_blocks"))
    return rows.join(counts, group).withColumn("block", F.pmod(F.xxhash64(id), F.col("n_blocks")).cast("int"))
