"""Hard-negative mining by one-dimensional distance keys.

Every vector x gets one component more, sqrt(M^2 - |x|^2), M the largest length, and an anchor q a zero: then
|q - x|^2 = |q|^2 + M^2 - 2 q.x, and the best inner products are the nearest neighbours. A row belongs to its nearest
pivot, and its key is (pivot, distance from it). Rows are stored sorted by key, in segments; a segment is
an annulus around its pivot. An anchor at distance d from a pivot is at least max(0, low - d, d - high) and at
most d + high from everything in an annulus (low, high), so each segment has a greatest and a least
possible score. Anchors scan the segments in order of the greatest, the intervals around their own keys growing
from round to round, until no segment left could hold a row that they still lack. Scores come from whole integer
vectors, so the keys only decide what is looked at.

Two searches use the index: the positives of an anchor (best scores of its label), then its negatives, for
each positive the best scores of other labels within a band below the positive's.

Defined results: rows without id or label, and with vectors that are null, empty or hold null or non-finite
components take no part; of rows that repeat an id the one with the smallest label, then vector, does; vectors of
another length than the anchor's are no candidates; equal scores go to the smaller id; anchors without positives,
and positives without negatives, give no row; scores beyond a long are its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, durable
from .vectors import _MOST, matrix, scaled, usable

#: Pivots, drawn from a sample of SAMPLE rows. Segments have ROWS rows at least and number SEGMENTS and some at
#: most, so that their keys (three numbers each) fit every task.
PIVOTS, SAMPLE, ROWS, SEGMENTS = 16, 2_000, 2_048, 50_000
#: Anchors that meet a segment in one task, and at once; the share of all segments that each round may look at.
ASKS, AT_ONCE = 4_096, 256
SHARES = (0.0625, 0.25, 1.0)


def augmented(x: np.ndarray, dims: int, top: float) -> np.ndarray:
    """Rows of x padded to dims, and the component that gives all the length sqrt(top)."""
    rest = np.sqrt(np.maximum(0.0, top - (x * x).sum(1)))
    return np.concatenate([np.pad(x, ((0, 0), (0, dims - x.shape[1]))), rest[:, None]], 1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        d = np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], 1)
    return np.where(np.isfinite(d), d, 0.0)


def by_size(col: pa.Array):
    """Places and vectors of each length in a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    sizes = np.diff(col.offsets.to_numpy())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, matrix(col.take(pa.array(at)))


class Keys:
    """What every task needs to know of the index: pivots, and the pivot, least and greatest distance of each seg
    and pivot that occur together (found: rows in the order of seg)."""

    def __init__(self, n: int, top: float | None, dims: int | None, scale: int):
        self.n, self.top, self.dims, self.scale = n, top or 0.0, dims or 1, scale
        self.blunt = not self.top < 1e290  # lengths beyond doubles: keys tell nothing apart, and everything is scanned

    def draw(self, some: list) -> None:
        self.pivots = np.concatenate([self.keyed(self.floats(np.array([v], np.float64))) for v in some] or [np.zeros((1, self.dims + 1))])

    def describe(self, found: list) -> None:
        self.seg, self.pivot = np.array([r["seg"] for r in found], np.int32), np.array([r["pivot"] for r in found], np.int32)
        self.low, self.high = np.array([r["low"] for r in found], float), np.array([r["high"] for r in found], float)
        self.names, self.first = np.unique(self.seg, return_index=True)

    def floats(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.zeros_like(x) if self.blunt else np.floor(x * self.scale)

    def keyed(self, x: np.ndarray) -> np.ndarray:
        return augmented(x, self.dims, 0.0 if self.blunt else self.top)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of anchors x with the rows of each seg (in the order of names), a
        little wider than need be."""
        x = self.floats(x)
        own = (x * x).sum(1)
        q = np.concatenate([np.pad(x, ((0, 0), (0, self.dims - x.shape[1]))), np.zeros((len(x), 1))], 1)
        d = distances(q, self.pivots)[:, self.pivot]
        if self.blunt or not len(self.seg):
            return np.full((len(x), len(self.names)), -np.inf), np.full((len(x), len(self.names)), np.inf)
        near, far = np.maximum(0.0, np.maximum(self.low - d, d - self.high)), d + self.high
        near, far = np.minimum.reduceat(near, self.first, axis=1), np.maximum.reduceat(far, self.first, axis=1)
        base = (own + self.top)[:, None]
        slack = 1e-6 * base + 1.0
        return (base - far * far) / 2 - slack, (base - near * near) / 2 + slack


def build(rows: DataFrame, scale: int) -> tuple[Keys, DataFrame]:
    """The keys, and seg, id, label, v in key order as a durable table, of rows with an id each."""
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + F.pow(F.abs(c.cast("double")) * scale + 1, F.lit(2.0)))
    keys = Keys(*rows.agg(F.count("*"), F.max(square), F.max(F.size("v"))).first(), scale)
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(max(1, keys.n // SAMPLE))) == 0).orderBy(F.xxhash64("id", F.lit(1)), "id").limit(PIVOTS)
    keys.draw([r["v"] for r in some.select("v").collect()])

    def place(batches):
        for b in batches:
            pivot, dist = np.zeros(len(b), np.int32), np.zeros(len(b))
            for at, x in by_size(b.column("v")):
                d = distances(keys.keyed(keys.floats(x)), keys.pivots)
                pivot[at], dist[at] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pivot), pa.array(dist)], names=["id", "label", "v", "pivot", "dist"])

    parts = max(1, -(-keys.n // max(ROWS, keys.n // SEGMENTS)))
    placed = rows.select("id", "label", "v").mapInArrow(place, f"id long, label long, v {rows.schema['v'].dataType.simpleString()}, pivot int, dist double")
    order = ("pivot", "dist", "id")
    stored = durable(placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("seg", F.spark_partition_id()), "keys")
    keys.describe(stored.groupBy("seg", "pivot").agg(F.min("dist").alias("low"), F.max("dist").alias("high")).orderBy("seg", "pivot").collect())
    return keys, stored.select("seg", "id", "label", "v")


def best_in(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best scores of each row; ids rise with the columns, so that ties
    go to the smaller one. Places at the type's floor are none. Changes scores."""
    floor = -np.inf if scores.dtype.kind == "f" else -(1 << 200) if scores.dtype == object else np.iinfo(np.int64).min
    every = np.arange(len(scores))
    rows, cols = [], []
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(1)
        some = np.flatnonzero(scores[every, at] > floor)
        if not len(some):
            break
        rows.append(some)
        cols.append(at[some])
        scores[some, at[some]] = floor
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, np.int64),) * 2


def _scan(keys: Keys, rows: DataFrame, asks: DataFrame, n_asks: int, k: int, same: bool) -> DataFrame:
    """ask, band, id, score: the k best rows of every segment for each band (low, high) of the asks sent to it
    (seg, ask, label, v, low, high)."""
    batches = max(1, -(-n_asks // ASKS))
    batch = F.pmod(F.xxhash64("ask"), F.lit(batches)).cast("int")
    asks = asks.withColumn("batch", batch)
    wanted = asks.select("seg", "batch").distinct()
    none = F.lit(None).cast("array<long>")
    given = rows.join(wanted, "seg").select("seg", "batch", F.lit(False).alias("asks"), "id", "label", "v", none.alias("low"), none.alias("high"))
    both = given.unionByName(asks.select("seg", "batch", F.lit(True).alias("asks"), F.col("ask").alias("id"), "label", "v", "low", "high"))
    scale = keys.scale

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        is_q, ids, labels = t.column("asks").to_numpy(), t.column("id").to_numpy(), t.column("label").to_numpy()
        out = []
        for at, x in by_size(t.column("v")):
            x = scaled(x, scale)
            q_at, v_at = at[is_q[at]], at[~is_q[at]]
            if not len(q_at) or not len(v_at):
                continue
            q, v = x[is_q[at]], x[~is_q[at]]
            most = float(np.abs(v).max()) * float(np.abs(q).max()) * x.shape[1]
            # Doubles hold the sums exactly up to 2^53 and multiply fastest; beyond 2^62 Python's integers do.
            kind = np.float64 if most < 2.0**52 else np.int64 if most < 2.0**62 else object
            q, v = q.astype(kind), v.astype(kind).T
            floor = -np.inf if kind is np.float64 else -(1 << 200) if kind is object else np.iinfo(np.int64).min
            vi, vl = ids[v_at], labels[v_at]
            for from_ in range(0, len(q), AT_ONCE):
                mine = q_at[from_ : from_ + AT_ONCE]
                scores = q[from_ : from_ + AT_ONCE] @ v
                if kind is object:
                    scores = np.array([[max(-_MOST - 1, min(_MOST, c)) for c in r] for r in scores], object)
                ok = (labels[mine][:, None] == vl[None]) == same
                ok &= ids[mine][:, None] != vi[None]
                low, high = t.column("low").take(pa.array(mine)).to_pylist(), t.column("high").take(pa.array(mine)).to_pylist()
                for band in range(max(map(len, low))):
                    has = np.flatnonzero([len(x) > band for x in low])
                    lo, hi = (np.array([side[i][band] for i in has], kind)[:, None] for side in (low, high))
                    some = scores[has]
                    some = np.where(ok[has] & (some >= lo) & (some <= hi), some, floor)
                    kept = some.copy() if k > 1 else some
                    r, c = best_in(some, k)
                    out.append((ids[mine[has[r]]], np.full(len(r), band), vi[c], kept[r, c].astype(np.int64)))
        join = lambda c, kind: pa.array(np.concatenate([o[c] for o in out]) if out else np.zeros(0), kind)
        return pa.table({"ask": join(0, pa.int64()), "band": join(1, pa.int32()), "id": join(2, pa.int64()), "score": join(3, pa.int64())})

    return both.groupBy("seg", "batch").applyInArrow(run, "ask long, band int, id long, score long")


def search(keys: Keys, rows: DataFrame, asks: DataFrame, k: int, same: bool) -> DataFrame:
    """ask, band, rank, id, score: the k best rows within each band low[i] <= score <= high[i] of every ask (ask,
    label, v, low, high), of its own label or of others. A durable table."""
    kind = asks.schema["v"].dataType.simpleString()
    n_asks = asks.count()
    limits = sorted({max(1, round(s * len(keys.names))) for s in SHARES})
    found, before = None, 0
    for limit in limits:
        state = asks.select("ask", "label", "v", "low", "high")
        if found is None:
            state = state.withColumn("kth", F.lit(None).cast("array<struct<band: int, score: long>>"))
        else:  # the kth score of each band that has k
            kth = found.where(F.col("rank") == k).groupBy("ask").agg(F.collect_list(F.struct("band", "score")).alias("kth"))
            state = state.join(kth, "ask", "left")

        def route(batches, before=before, limit=limit):
            for b in batches:
                low, high, kth = (b.column(c).to_pylist() for c in ("low", "high", "kth"))
                for at, x in by_size(b.column("v")):
                    least, most = keys.bounds(x)
                    order = np.argsort(-most, axis=1, kind="stable")[:, before:limit]
                    fits = np.zeros(order.shape, bool)
                    for i, place in enumerate(at):
                        need = list(low[place])
                        for e in kth[place] or ():
                            need[e["band"]] = max(need[e["band"]], e["score"])
                        for lo, hi in zip(need, high[place], strict=True):
                            fits[i] |= (most[i, order[i]] >= lo) & (least[i, order[i]] <= hi)
                    who, cols = np.nonzero(fits)
                    sent = b.select(["ask", "label", "v", "low", "high"]).take(pa.array(at[who]))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.names[order[who, cols]]), *sent.columns], names=["seg", "ask", "label", "v", "low", "high"])

        sent = durable(state.mapInArrow(route, f"seg int, ask long, label long, v {kind}, low array<long>, high array<long>"), "sent")
        made = _scan(keys, rows, sent, n_asks, k, same)
        made = made if found is None else made.unionByName(found.select(*made.columns))
        rank = F.row_number().over(Window.partitionBy("ask", "band").orderBy(F.desc("score"), "id"))
        old, found = found, durable(made.withColumn("rank", rank).where(F.col("rank") <= k), "found")
        discard(sent, *([old] if old is not None else []))
        before = limit
    return found


def mine(df: DataFrame, is_anchor, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: of every row for which
    is_anchor(id column) holds, and each of its best `positives` rows of the same label, the best
    `negatives` rows of other labels with low to high percent of the positive's score. Exact."""
    named = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), F.col(label_col).cast("long").alias("label"))
    fit = usable(named.where("label is not null"), "id", "v", zero=True, keep=("label",))
    rows = fit.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    keys, rows = build(durable(rows, "vectors"), scale)
    anchors = rows.where(is_anchor(F.col("id"))).select(F.col("id").alias("ask"), "label", "v")
    whole = lambda n: F.array(F.lit(n).cast("long"))
    best = search(keys, rows, anchors.withColumns({"low": whole(-_MOST - 1), "high": whole(_MOST)}), positives, True).where("score >= 0")  # below 0 no band holds anything
    # 100 s <= high p and low p <= 100 s without products beyond a long: p = 100 a + b.
    b = F.pmod(F.col("score"), F.lit(100).cast("long"))
    a = F.expr("(score - pmod(score, 100L)) div 100")
    bands = best.select("ask", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), (a * low + F.ceil(b * low / 100.0)).alias("low"), (a * high + F.floor(b * high / 100.0)).alias("high"))
    bands = bands.where("low <= high")
    place = F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("positive_score"), "positive_id")) - 1  # `positives` rows at most
    bands = durable(bands.withColumn("band", place), "bands")
    listed = bands.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("band", "low", "high"))).alias("b"))
    asks = anchors.join(listed, "ask").select("ask", "label", "v", F.col("b.low").alias("low"), F.col("b.high").alias("high"))
    got = search(keys, rows, asks, negatives, False)
    out = bands.join(got, ["ask", "band"])
    return out.select(F.col("ask").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
ORACLE = f"""
WITH e AS (SELECT vec_id, {_LABEL} AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3
"""
