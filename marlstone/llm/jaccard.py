"""Exact Jaccard self-join of texts on word n-grams, and its connected classes.

The join is a blocked sparse product of the document by n-gram incidence matrix. Documents with
equal n-gram sets are one row of the matrix. Its columns, the n-grams, fall into column groups by
hash, more groups than the n-grams in which two sets of a linked pair can differ: with similarity
of at least NUM / DEN, sets whose smaller has n members differ in at most (DEN - NUM) * n / NUM of
them, so a linked pair agrees on whole groups. Rows that agree on a whole group meet in a block
(or, where that is less to send, with all rows that hang together by such agreements);
pairs whose sizes lie beyond the bound never meet, because groups are drawn up per size class.
Groups are drawn up over the rarer n-grams alone, in which linked sets differ no more: else all
documents with one passage would agree on the groups that hold nothing but its n-grams. A set too
few of whose n-grams are rare files groups of all its n-grams besides; of two linked sets either one
has enough rare ones, and then they agree on a group of those, or neither has, and then they agree
on a group of all. Which n-grams count as frequent, by a sample of sets, changes who meets, not
what is found.
In a block the overlap counts of all its pairs are accumulated column block by column block as
products of incidence matrices, and pairs below ceil(NUM * (|x| + |y|) / (NUM + DEN)) are dropped.
A block gives a spanning forest of its links, not all of them; contraction of the forests over
all blocks yields the classes.

Rows that meet in numbers beyond a block are dealt in parts. First every part is multiplied with
itself and with a few pivot rows of all parts; where that leaves one class, as among copies of one
text, nothing more is to be found. Then only the rows outside the largest class found are
multiplied with all others. Blocks are worked off in passes, so that the sets under way at once
are about half of those of the table.

Defined results: null, empty or blank text has an empty set, no link, and is its own class;
a text of fewer than WIDTH words is one n-gram, its whole word sequence; equal sets always link;
a repeated id is one node with the links of all its texts; rows without an id link nothing and take
the class of the documents with the same set (null, where there are none); an empty table gives no
row. Words, n-grams and sets are known by 64-bit hashes (sets by two and their size); 56 bits of an
n-gram's hash are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blocks, deltas, discard, durable, lists, mix, release, tidy, undelta

WIDTH, NUM, DEN = 3, 90, 100
#: Group agreements that a linked pair has at least beyond the one it needs; a set with more empty
#: groups than its class allows for also files its empty groups.
SPARE = 2
#: Rows and set members of a block that are multiplied at once; larger ones are dealt in parts of half that.
BLOCK, MEMBERS = 1024, 2 << 20
#: Rows, about, of a block dealt in parts that meet all its parts; and a part's share in members at most.
PIVOTS, PIVOT_SHARE = 96, 0.1
#: Bytes of a block after which its memory is given back.
RELEASE = 4 << 20
#: n-grams of the sets that tell frequent ones, occurrences among them that make one frequent, and how
#: many are called so at most (8 bytes each in every task). RARE: the part of a set's n-grams which,
#: if rare, are enough for groups of their own.
SAMPLE, FREQUENT, LIST, RARE = 4_000_000, 8, 1 << 20, 0.7
#: Rows of exact copies are joined to what was found of their set in this many shares.
SALTS = 1024
#: Hash values of documents that tell which texts may meet others, 4 bytes each.
SLOTS = 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_sets(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of each row, flat, and the n + 1 bounds."""
    w = Words(data, offs)
    n = np.diff(w.first)
    rows = len(n)
    h = np.full(len(w.hash), 7, np.uint64)
    padded = np.concatenate([w.hash, np.zeros(width, np.uint64)])
    for i in range(width):
        h = mix(h * _A + padded[i : i + len(h)] * _B + np.uint64(i))
    pos = np.arange(len(h)) - w.first[w.row] if len(h) else np.zeros(0, np.int64)
    full = pos <= n[w.row] - width
    gram, row = [h[full]], [w.row[full]]
    for i in np.flatnonzero((n > 0) & (n < width)):
        own = np.array([n[i]], np.uint64)
        for x in range(w.first[i], w.first[i + 1]):
            own = mix(own * _A + w.hash[x : x + 1] * _B)
        gram.append(own)
        row.append(np.array([i]))
    gram, row = np.concatenate(gram), np.concatenate(row)
    order = np.lexsort((gram, row))
    gram, row = gram[order], row[order]
    fresh = np.ones(len(gram), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
    gram, row = gram[fresh], row[fresh]
    return gram, np.searchsorted(row, np.arange(rows + 1))


def size_classes(largest: int, num: int, den: int) -> np.ndarray:
    """Upper ends of the size classes: a linked pair lies in one class or in two neighbours."""
    out = [1]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, (out[-1] + 1) * den // num))
    return np.array(out, np.int64)


def column_groups(end: int, num: int, den: int, part: float = 1.0) -> tuple[int, int]:
    """Number of column groups of the size class that ends with end, and how many of them a set may
    leave empty and still agree on a filled one with every set it links to: about as many as sets of
    the class leave empty by chance with this part of their n-grams."""
    least = (den - num) * end // num + 1
    empty = least * float(np.exp(-part * end * num / den / least))
    spare = SPARE + int(np.ceil(empty + 2 * np.sqrt(empty)))
    return least + spare, spare


def group_keys(gram: np.ndarray, rare: np.ndarray, num: int, den: int) -> np.ndarray:
    """Block keys of one set: for its own size class and the one below, a key per filled column group of
    its rare n-grams, and where these leave too many empty, a key per column group of all its n-grams."""
    n = len(gram)
    ends = size_classes(n, num, den)
    own = int(np.searchsorted(ends, n))

    def cells(of_set: np.ndarray, level: int, part: float, salt: int) -> tuple[np.ndarray, np.ndarray, bool]:
        groups, spare = column_groups(int(ends[level]), num, den, part)
        of = ((of_set >> np.uint64(17)) % np.uint64(groups)).astype(np.int64)
        cell = np.zeros(groups, np.uint64)
        np.add.at(cell, of, mix(of_set + _B))
        filled = np.bincount(of, minlength=groups) > 0
        return mix(cell + mix(np.arange(groups, dtype=np.uint64) * _A + np.uint64(2 * level + salt))), filled, groups - filled.sum() <= spare

    out = []
    for level in {own, max(0, own - 1)}:
        key, filled, enough = cells(gram[rare], level, RARE, 0)
        out.append(key[filled])
        if not enough:
            key, filled, enough = cells(gram, level, 1.0, 1)
            out.append(key[filled] if enough else key)
    return np.concatenate(out)


def _slot(of: str):
    """One of SLOTS hash values of a document."""
    return F.pmod(F.xxhash64(of, F.lit(9)), F.lit(SLOTS)).cast("int").alias("slot")


def frequent(docs: DataFrame, sets: DataFrame, members: int, width: int) -> np.ndarray:
    """The n-grams found FREQUENT times in a sample of sets with about SAMPLE members, the LIST most
    frequent at most; sorted."""
    some = sets.where(F.pmod(F.xxhash64("a", F.lit(5)), F.lit(max(1, -(-members // SAMPLE)))) == 0).select(F.col("rep").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in blocks(batch.column("text"), 1 << 20):
                yield pa.RecordBatch.from_arrays([pa.array(gram_sets(data, offs, width)[0].view(np.int64))], names=["gram"])

    # Texts that surely are no part of the sample stay where they are.
    near = docs.withColumn("slot", _slot("doc_id")).join(F.broadcast(some.select(_slot("doc_id")).distinct()), "slot", "left_semi")
    found = near.join(some, "doc_id", "left_semi").select("text").mapInArrow(tidy(run), "gram long")
    many = found.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "gram").limit(LIST).select("gram").toArrow()
    return np.sort(many.column("gram").to_numpy().view(np.uint64))


def signatures(gram: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for the set of each row."""
    sums = lambda v: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)])[bound])
    return mix(sums(mix(gram ^ _A))).view(np.int64), mix(sums(mix(gram + _B))).view(np.int64)


def _source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _named(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _source(df, id_col, text_col).where("doc_id is not null")


def describe(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, set size n, and the set's signature (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column("text"), 1 << 20):
                gram, bound = gram_sets(data, offs, width)
                a, b = signatures(gram, bound)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo:hi], pa.array(np.diff(bound)), pa.array(a), pa.array(b)], names=["doc_id", "n", "a", "b"])

    return _source(df, id_col, text_col).mapInArrow(tidy(run), "doc_id long, n long, a long, b long")


def filings(df: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int, common: np.ndarray) -> DataFrame:
    """a, n and the block keys of every set that can link to a different one; a task files a set
    once. common: frequent n-grams, sorted."""
    common = np.append(common, ~np.uint64(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for _, _, data, offs in blocks(batch.column("text"), 1 << 20):
                gram, bound = gram_sets(data, offs, width)
                n = np.diff(bound)
                rare = common[np.searchsorted(common, gram)] != gram
                a, _ = signatures(gram, bound)
                some, keys = [], []
                for i in np.flatnonzero((den - num) * n >= num):
                    if (mark := int(a[i])) not in met:
                        met.add(mark)
                        some.append(i)
                        keys.append(group_keys(gram[bound[i] : bound[i + 1]], rare[bound[i] : bound[i + 1]], num, den))
                if some:
                    flat = np.concatenate(keys)
                    yield pa.RecordBatch.from_arrays([pa.array(a[some]), pa.array(n[some]), lists(flat.view(np.int64), np.cumsum([0, *map(len, keys)]))], names=["a", "n", "keys"])

    return _named(df, id_col, text_col).mapInArrow(tidy(run), "a long, n long, keys array<long>")


def sets_in_blocks(texts: DataFrame, width: int) -> DataFrame:
    """block, a, rep, grams for every block of every row (rep, a, text, blocks) whose text has the
    set a; other texts of a repeated id don't count here, and a task sends equal rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent_before: set[int] = set()
        for b in batches:
            for lo, hi, data, offs in blocks(b.column("text"), 1 << 20):
                gram, bound = gram_sets(data, offs, width)
                own, _ = signatures(gram, bound)
                part = b.slice(lo, hi - lo)
                wanted = part.column("a").to_numpy()
                some = [i for i in np.flatnonzero(own == wanted).tolist() if not (wanted[i] in sent_before or sent_before.add(wanted[i]))]
                if not some:
                    continue
                part = part.take(pa.array(some))
                span = [(int(bound[i]), int(bound[i + 1])) for i in some]
                of = part.column("blocks")
                row = np.repeat(np.arange(len(some)), np.diff(of.offsets.to_numpy()))
                names = of.flatten()
                # 56 bits of each member, sorted, as differences: what the shuffle carries most of.
                grams = pa.array([deltas(gram[x:y] >> np.uint64(8)) for x, y in span], pa.binary())
                sent = np.cumsum(np.array([y - x for x, y in span])[row])
                at = 0
                while at < len(row):  # about 1 << 20 set members a batch
                    to = max(at + 1, int(np.searchsorted(sent, (sent[at - 1] if at else 0) + (1 << 20), "right")))
                    pick = pa.array(row[at:to])
                    yield pa.RecordBatch.from_arrays([names[at:to], part.column("a").take(pick), part.column("rep").take(pick), grams.take(pick)], names=["block", "a", "rep", "grams"])
                    at = to

    return texts.select("rep", "a", "text", "blocks").mapInArrow(tidy(run), "block struct<id: long, i: long, j: long>, a long, rep long, grams binary")


def forest(ids: np.ndarray, flat: np.ndarray, bound: np.ndarray, num: int, den: int) -> np.ndarray:
    """The smallest id of each row's links within a block, by accumulating overlaps."""
    n = np.diff(bound)
    rows = np.repeat(np.arange(len(n)), n)
    uniq, inv, times = np.unique(flat, return_inverse=True, return_counts=True)
    # Columns of one row add to no overlap; the rest are multiplied block by block.
    shared = times > 1
    col = np.cumsum(shared) - 1
    keep = shared[inv]
    rows, inv = rows[keep], col[inv[keep]]
    order = np.argsort(inv, kind="stable")
    rows, inv = rows[order], inv[order]
    overlap = np.zeros((len(n), len(n)), np.float32)
    for c in range(0, int(shared.sum()), 2048):
        m = slice(*np.searchsorted(inv, [c, c + 2048]))
        x = np.zeros((len(n), 2048), np.float32)
        x[rows[m], inv[m] - c] = 1
        overlap += x @ x.T
    need = num * (n[:, None] + n[None, :])
    linked = (num + den) * overlap.astype(np.int64) >= need
    root = np.arange(len(n))
    while True:  # every row takes the smallest root among its links until nothing changes
        best = np.where(linked, root[None, :], len(n)).min(1)
        best = np.minimum(root, best)
        if (best == root).all():
            break
        root = best
    return ids[root]


def contract(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over undirected edges (u, v), by alternating large
    and small stars; each round is written to the shared folder. The smallest neighbours are a table
    of their own, so that the edges of a star's centre, which may be most of all, can be split."""
    both = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = durable(both, "edges")
    mark = None
    while True:
        around = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = durable(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = around.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_low.select("u", F.col("m").alias("v"))).where("u <> v")
        after = durable(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        discard(now, low)
        now = after
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if got == mark or not got[0]:
            return now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        mark = got


def parts(size="size", total="total"):
    """Parts that the rows of a block are dealt in: one, where they fit."""
    size, total = F.col(size), F.col(total)
    return F.when((size > BLOCK) | (total > MEMBERS), F.greatest(F.ceil(size / (BLOCK // 2)), F.ceil(total / (MEMBERS // 2)))).otherwise(1).cast("long")


def copies(size, total):
    """Set members that go to blocks if no class shows among the rows."""
    return F.col(total) * F.greatest(F.lit(1), parts(size, total) - 1)


def meetings(filed: DataFrame) -> DataFrame:
    """id, root, size, total, a, n: who meets whom. Rows that agree on a column group meet; where
    that sends fewer set members about, all rows that hang together by such agreements (their root)
    meet at once instead. size and total: rows and set members that meet under the id."""
    filed = filed.select("a", "n", F.explode("keys").alias("key")).repartition("key").distinct()
    sizes = filed.groupBy("key").agg(F.count("*").alias("size"), F.min("a").alias("low")).where("size > 1")
    met = durable(filed.join(sizes, "key"), "met")
    hang = durable(contract(met.select(F.col("a").alias("u"), F.col("low").alias("v"))), "hang")
    rows = met.select("a", "n").distinct().join(hang.withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    rows = durable(rows, "rows")
    whole = rows.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    # Column groups with the same rows are one block; two 64-bit sums stand for a block's rows.
    alike = met.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("total"), F.min("a").alias("a"), F.bit_xor(F.xxhash64("a")).alias("x"), F.bit_xor(F.xxhash64("a", F.lit(1))).alias("y"))
    alike = alike.groupBy("a", "x", "y", "size", "total").agg(F.min("key").alias("key")).join(rows.select("a", "root"), "a").select("root", "key", "size", "total")
    alike = durable(alike, "alike")
    cost = alike.groupBy("root").agg(F.sum(copies("size", "total")).alias("cost"))
    whole = durable(whole.join(cost, "root").withColumn("as_one", copies("size", "total") <= F.col("cost")), "whole")
    one = rows.join(whole.where("as_one").select("root", "size", "total"), "root").select(F.col("root").alias("id"), "root", "size", "total", "a", "n")
    apart = alike.join(whole.where("not as_one").select("root"), "root", "left_semi")
    out = durable(one.unionByName(met.select("key", "a", "n").join(apart, "key").select(F.col("key").alias("id"), "root", "size", "total", "a", "n")), "meet")
    discard(met, hang, rows, alike, whole)
    return out


def _block(i, j):
    return F.struct(F.col("id"), i.cast("long").alias("i"), j.cast("long").alias("j"))


def first_blocks(meet: DataFrame) -> DataFrame:
    """block, root, a, n: every row in its part, pivots in all parts of their id."""
    draw = F.xxhash64("a", F.lit(3)).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    pivot = (F.col("parts") > 1) & (draw < F.least(PIVOTS / F.col("size"), PIVOT_SHARE * MEMBERS / F.col("total")))
    dealt = meet.withColumn("parts", parts()).withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")))
    dealt = dealt.withColumn("part", F.explode(F.when(pivot, F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("part"))))
    return dealt.select(_block(F.col("part"), F.col("part")).alias("block"), "root", "a", "n")


def second_blocks(meet: DataFrame, same: DataFrame, found: DataFrame) -> DataFrame | None:
    """Of ids dealt in parts: rows outside their largest class against all others. None where
    there are none."""
    classed = meet.withColumn("parts", parts()).where("parts > 1").join(same, "a").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    classed = durable(classed.select("id", "root", "a", "n", "parts", F.coalesce("found", "rep").alias("found")), "classed")
    main = classed.groupBy("id", "found").agg(F.count("*").alias("k")).groupBy("id").agg(F.max_by("found", F.struct("k", "found")).alias("main"))
    main = durable(main, "main")
    marked = classed.join(main, "id").withColumn("rest", F.col("found") != F.col("main"))
    count = lambda of: F.greatest(F.ceil(F.count_if(of) / (BLOCK // 2)), F.ceil(F.sum(F.when(of, F.col("n")).otherwise(0)) / (MEMBERS // 2))).cast("long")
    left = durable(marked.groupBy("id").agg(count(F.col("rest")).alias("rests"), count(~F.col("rest")).alias("mains")).where("rests > 0"), "left")
    if left.isEmpty():
        discard(classed, main, left)
        return None
    dealt = marked.join(left, "id").withColumn("part", F.pmod(F.xxhash64("a"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    others = F.filter(upto("rests"), lambda x: (x != F.col("part")) | (F.col("rests") == 1))
    outside = F.concat(F.transform(upto("mains"), lambda p: _block(F.col("part"), p)), F.transform(others, lambda x: _block(-1 - F.least("part", x), -1 - F.greatest("part", x))))
    inside = F.transform(upto("rests"), lambda r: _block(r, F.col("part")))
    out = durable(dealt.select(F.explode(F.when(F.col("rest"), outside).otherwise(inside)).alias("block"), "root", "a", "n"), "second")
    discard(classed, main, left)
    return out


def links(docs: DataFrame, placed: DataFrame, same: DataFrame, members: int, width: int, num: int, den: int) -> list[DataFrame]:
    """Spanning forests (u, v) of the links within all blocks, a table per pass. Blocks of one root
    go in one pass, but for roots that would fill a quarter of it: these are dealt out by block."""
    room = max(1, members // 2)
    passes = -(-int(placed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // room)
    large = placed.groupBy("root").agg(F.sum("n").alias("sent")).where(F.col("sent") > room // 4).select("root", F.lit(True).alias("large"))
    # At most four of them for each pass there is.
    turned = placed.join(large, "root", "left").withColumn("pass", F.pmod(F.when(F.col("large"), F.xxhash64("block")).otherwise(F.xxhash64("root")), F.lit(max(1, passes))).cast("int"))
    chosen = turned.groupBy("a", "pass").agg(F.collect_list("block").alias("blocks")).join(same, "a")
    chosen = durable(chosen, "chosen")
    # Texts that surely meet nothing stay where they are: at most SLOTS hash values say which.
    near = docs.withColumnRenamed("doc_id", "rep").withColumn("slot", _slot("rep")).join(F.broadcast(chosen.select(_slot("rep")).distinct()), "slot", "left_semi")
    texts = durable(near.join(chosen, "rep").select("rep", "a", "text", "blocks", "pass"), "texts", by="pass")

    def multiply(t: pa.Table) -> pa.Table:
        t = t.sort_by([("rep", "ascending"), ("a", "ascending")])
        a = t.column("a").to_numpy()
        t = t.take(pa.array(np.sort(np.unique(a, return_index=True)[1])))
        ids = t.column("rep").to_numpy()
        sets = [undelta(x) for x in t.column("grams").to_pylist()]
        root = forest(ids, np.concatenate(sets), np.cumsum([0, *map(len, sets)]), num, den)
        link = root != ids
        if t.nbytes > RELEASE:
            release()
        return pa.table({"u": ids[link], "v": root[link]})

    out = [durable(sets_in_blocks(texts.where(F.col("pass") == p), width).groupBy("block").applyInArrow(multiply, "u long, v long"), "links") for p in range(passes)]
    discard(texts, chosen)
    return out


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    told = durable(describe(df, id_col, text_col, width), "sets").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    # At most SALTS rows stand for a set, however many copies it has; rep is its smallest document.
    shares = durable(told.where("n > 0").groupBy("a", "b", "n", "salt").agg(F.min("doc_id").alias("least")), "shares")
    reps = durable(shares.groupBy("a", "b", "n").agg(F.min("least").alias("rep")), "reps")
    sets = reps.where("rep is not null")
    same, members = sets.select("a", "rep"), int(sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    docs = _named(df, id_col, text_col)
    meet = meetings(filings(df, id_col, text_col, width, num, den, frequent(docs, sets, members, width)))
    # An id with several texts ties their sets together.
    several = told.where("n > 0").groupBy("doc_id").agg(F.min("a").alias("x"), F.max("a").alias("y")).where("doc_id is not null and x <> y").select("doc_id")
    tied = told.where("n > 0").join(several, "doc_id", "left_semi").select("doc_id", "a").distinct().join(same, "a").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    placed = durable(first_blocks(meet), "first")
    first = links(docs, placed, same, members, width, num, den)
    found = durable(contract(reduce(DataFrame.unionByName, first, tied)).select("node", F.col("root").alias("found")), "found")
    discard(placed, *first)
    if (more := second_blocks(meet, same, found)) is not None:
        second = links(docs, more, same, members, width, num, den)
        all_links = reduce(DataFrame.unionByName, second, found.select(F.col("node").alias("u"), F.col("found").alias("v")))
        wider = durable(contract(all_links).select("node", F.col("root").alias("found")), "found")
        discard(more, found, *second)
        found = wider
    rooted = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("a", "b", "n", F.coalesce("found", "rep").alias("root"))
    rooted = durable(rooted, "rooted")
    discard(meet, reps, found)
    named = durable(shares.select("a", "b", "n", "salt").join(rooted, ["a", "b", "n"]), "named")
    discard(shares, rooted)
    out = told.join(named, ["a", "b", "n", "salt"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))
