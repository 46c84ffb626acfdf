"""Searches over vectors: approximate nearest neighbours by cross-polytope hashing, and exact
top-k by inner product with Fagin's threshold algorithm. Both deal vectors and queries out in
blocks; a block returns each query's best rows, never its pairs.

Defined results, both: vectors that are null, empty or hold null or non-finite components (and, for
the nearest neighbours, zero vectors), and rows without an id, take no part; vectors of another
length than the query's are no candidates; equal scores go to the smaller id; a query with fewer candidates than k gets them
all, and none without candidates. Ids are taken to be unique; of rows that repeat an id none is a
candidate of that id's own searches, nearest() gives the id once, with the distance of one of its rows, and
top_products() gives each of them.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable

# ---- cross-polytope hashing ------------------------------------------------------------------

#: Tables, and the buckets of all tables together that a query looks in: those of its nearest axes.
TABLES, PROBES = 8, 100
BLOCK, ASKING = 512, 32  # vectors of a bucket in one block, and queries reranked with it at once


def rotations(dim: int, tables: int, seed: int = 11) -> np.ndarray:
    """Signs of three diagonal matrices per table; dim is a power of two."""
    return np.random.default_rng(seed + dim).choice(np.array([-1.0, 1.0]), (tables, 3, dim))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """H D3 H D2 H D1 x by fast Walsh-Hadamard transforms."""
    n = x.shape[1]
    for d in signs:
        x = x * d
        h = 1
        while h < n:
            y = x.reshape(len(x), n // (2 * h), 2, h)
            x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
            h *= 2
        x = x / np.sqrt(n)
    return x


def axes(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Distances of rows of x from the signed axes (2 i for +e_i, 2 i + 1 for -e_i), as products."""
    r = rotate(x, signs)
    both = np.empty((len(x), 2 * x.shape[1]))
    both[:, 0::2], both[:, 1::2] = -r, r
    return both


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column, all of one length, as doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros((0, 1))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def usable(df: DataFrame, id_col: str, vec_col: str, zero: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, v, the vector in the precision that it came in, and keep of the rows that take part."""
    kind = "array<float>" if df.select(vec_col).schema[0].dataType.simpleString() == "array<float>" else "array<double>"
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True))
    if not zero:
        ok = ok & F.exists(v, lambda x: x != 0)
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v"), *keep).where(ok)


def buckets(df: DataFrame, tables: int, probes: int | None) -> DataFrame:
    """id, dim, tab, bucket, v: the bucket of every vector in each table (probes None), or the
    buckets of the `probes` nearest axes over all tables (0: all buckets of table 0)."""

    def run(batches):
        for b in batches:
            ids, col = b.column("id").to_numpy(zero_copy_only=False), b.column("v")
            sizes = np.diff(col.offsets.to_numpy())
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                vecs = col.take(pa.array(rows))
                x = matrix(vecs)
                x = x / np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(1, keepdims=True)
                wide = 1 << max(1, int(dim - 1).bit_length())
                x = np.pad(x, ((0, 0), (0, wide - int(dim))))
                signs = rotations(wide, tables)
                if probes is None:
                    pick = np.stack([axes(x, signs[t]).argmin(1) + t * 2 * wide for t in range(tables)], 1)
                elif probes:
                    far = np.concatenate([axes(x, signs[t]) for t in range(tables)], 1)
                    pick = np.argsort(far, axis=1, kind="stable")[:, :probes]
                else:
                    pick = np.tile(np.arange(2 * wide), (len(rows), 1))
                many = pick.shape[1]
                pick = pick.ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[rows], many)), pa.array(np.full(len(pick), dim, np.int32)), pa.array((pick // (2 * wide)).astype(np.int32)), pa.array((pick % (2 * wide)).astype(np.int32)), vecs.take(pa.array(np.repeat(np.arange(len(rows)), many)))], names=["id", "dim", "tab", "bucket", "v"])

    return df.mapInArrow(run, f"id long, dim int, tab int, bucket int, v {df.schema['v'].dataType.simpleString()}")


def best(ids: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest distances, ties to the smaller id."""
    if len(ids) > 4 * k:
        edge = np.partition(dist, k - 1)[k - 1]
        some = np.flatnonzero(dist <= edge)
        return some[np.lexsort((ids[some], dist[some]))[:k]]
    return np.lexsort((ids, dist))[:k]


def _probe(vectors: DataFrame, queries: DataFrame, k: int, tables: int, probes: int) -> DataFrame:
    filed = buckets(vectors, tables, None)
    if not probes:
        filed = filed.where("tab = 0")
    # Bounded by tables times signed axes, whatever the number of vectors.
    sizes = filed.groupBy("dim", "tab", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    key = ["dim", "tab", "bucket"]
    rows = filed.join(sizes, key).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).select(*key, "part", F.lit(False).alias("asks"), "id", "v")
    asks = buckets(queries, tables, probes).join(sizes, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*key, "part", F.lit(True).alias("asks"), "id", "v")

    def rerank(t: pa.Table) -> pa.Table:
        is_q = t.column("asks").to_numpy()
        x, ids = matrix(t.column("v")), t.column("id").to_numpy()
        q, v, qi, vi = x[is_q], x[~is_q], ids[is_q], ids[~is_q]
        out = []
        for at in range(0, len(q), ASKING) if len(v) else ():
            some = slice(at, at + ASKING)
            near = np.sqrt(((v[None] - q[some, None]) ** 2).sum(2))
            near[vi[None] == qi[some, None]] = np.inf
            for own, dist in zip(qi[some], near, strict=True):
                top = best(vi, dist, min(k, len(vi)))
                top = top[np.isfinite(dist[top])]
                out.append((np.full(len(top), own), vi[top], dist[top]))
        join = lambda n, kind: pa.array(np.concatenate([o[n] for o in out]) if out else np.zeros(0), kind)
        return pa.table({"query_id": join(0, pa.int64()), "vec_id": join(1, pa.int64()), "score": join(2, pa.float64())})

    near = rows.unionByName(asks).groupBy(*key, "part").applyInArrow(rerank, "query_id long, vec_id long, score double")
    return near.dropDuplicates(["query_id", "vec_id"])


def _ranked(rows: DataFrame, k: int, order) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id and Euclidean distance of the k nearest found of every row for which
    is_query(id column) holds. Queries whose buckets hold fewer than k others look in every bucket.
    Hashing is by direction: it suits vectors of about one length."""
    every = usable(df, id_col, vec_col, zero=False)
    queries = every.where(is_query(F.col("id")))
    found = durable(_ranked(_probe(every, queries, k, tables, probes), k, F.col("score")), "near")
    short = queries.join(found.where(F.col("rank") == k).select(F.col("query_id").alias("id")), "id", "left_anti")
    if short.isEmpty():
        return found
    more = _ranked(_probe(every, short, k, 1, 0), k, F.col("score"))
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(more)


# ---- threshold algorithm ---------------------------------------------------------------------

SHARD, ASKS = 4096, 1024
_MOST = (1 << 63) - 1


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers where that would overflow."""
    if np.abs(x).max(initial=0) * scale < 2.0**62:
        return np.floor(x * scale).astype(np.int64)
    exact = [math.floor(Fraction(c) * scale) for c in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def threshold_top(x: np.ndarray, ids: np.ndarray, lists: np.ndarray, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest inner products of q with rows of x but those with id own, all exact in the
    type of x. lists: row numbers by falling value, a column per dimension. Lists are read from the
    end that helps, ever deeper; rows that turn up are scored whole, once; the products at the depth
    reached bound every row not seen yet, and once the kth score is above that bound nothing can
    change. Products beyond a long's range count as its ends."""
    dims = np.flatnonzero(q)
    seen = np.zeros(len(x), bool)
    seen[ids == own] = True
    rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step, n = 0, 16, len(x)
    up = q[dims] > 0
    while depth < n:
        to = min(n, depth + step)
        at = np.arange(depth, to)
        block = np.where(up[None, :], lists[at][:, dims], lists[n - 1 - at][:, dims]) if len(dims) else np.arange(n)[:, None]
        fresh = np.unique(block)
        fresh = fresh[~seen[fresh]]
        seen[fresh] = True
        made = x[fresh] @ q
        made = np.array([max(-_MOST - 1, min(_MOST, c)) for c in made], np.int64) if x.dtype == object else made.astype(np.int64)
        rows, scores = np.concatenate([rows, fresh]), np.concatenate([scores, made])
        top = np.lexsort((ids[rows], ~scores))[:k]
        rows, scores = rows[top], scores[top]
        if not len(dims) or to == n or seen.all():
            break
        bound = int((x[block[-1], dims] * q[dims]).sum())
        if len(rows) == k and scores[-1] > bound:
            break
        depth, step = to, step * 2
    return rows, scores


def top_products(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id and the integer inner product of the k best of every query, exact.
    Scores beyond a long's range are its ends."""
    every = usable(df, id_col, vec_col, zero=True)
    queries = every.where(is_query(F.col("id")))
    n, n_q = every.count(), queries.count()
    shards, batches = max(1, -(-n // SHARD)), max(1, -(-n_q // ASKS))
    shard, batch = F.pmod(F.xxhash64("id"), F.lit(shards)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(batches))
    rows = every.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long"))).alias("batch"), F.lit(False).alias("asks"), "id", "v")
    asks = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), batch.alias("batch"), F.lit(True).alias("asks"), "id", "v")

    def run(t: pa.Table) -> pa.Table:
        out = []
        col = t.column("v").combine_chunks()
        sizes = np.diff(col.offsets.to_numpy())
        is_q_all, ids_all = t.column("asks").to_numpy(), t.column("id").to_numpy()
        for dim in np.unique(sizes):
            part = np.flatnonzero(sizes == dim)
            x = scaled(matrix(col.take(pa.array(part))), scale)
            is_q, ids = is_q_all[part], ids_all[part]
            if not is_q.any() or is_q.all():
                continue
            v, vi = x[~is_q], ids[~is_q]
            lists = np.argsort(-v, axis=0, kind="stable")
            most = float(np.abs(v).max()) * float(np.abs(x[is_q]).max()) * int(dim)
            # Doubles hold the sums exactly up to 2^53 and multiply fastest; beyond 2^62 Python's integers do.
            kind = np.float64 if most < 2.0**52 else np.int64 if most < 2.0**62 else object
            v = v.astype(kind)
            for own, q in zip(ids[is_q].tolist(), x[is_q].astype(kind), strict=True):
                r, s = threshold_top(v, vi, lists, q, own, k)
                out.append((np.full(len(r), own), vi[r], s))
        join = lambda c: pa.array(np.concatenate([o[c] for o in out]) if out else np.zeros(0), pa.int64())
        return pa.table({"query_id": join(0), "vec_id": join(1), "score": join(2)})

    return _ranked(rows.unionByName(asks).groupBy("shard", "batch").applyInArrow(run, "query_id long, vec_id long, score long"), k, F.desc("score"))
