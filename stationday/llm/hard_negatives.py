"""Hard negatives by an inverted multi-index with certified score windows.

A vector is cut into two halves, and each half goes to the nearest entry of a
codebook of its own (k-means on at most about ``SAMPLE_ROWS`` rows; every row is
indexed). The pair of entries is the vector's cell. For an anchor a, the score of
any row of the cell (i, j) is at most

    a1.c1[i] + |a1| r1[i] + a2.c2[j] + |a2| r2[j]

with r the largest distance of a half from its entry. Sorting the entries of both
halves by their share of that bound, a heap gives the cells in falling order of
the sum (multi-sequence), without looking at all of them. A search wants the k
best rows of each of some score windows; it ends when the next cell's bound is
below what every window could still take: below its lower edge, or below its
k-th best row once it has k. The answer is then certified, not approximate.

Cells are dealt to shards of bounded size; large cells, such as the copies of one
vector, get several. Anchors first go to the shard with the best bound, which
gives each window a score to beat, then to every other shard whose bound reaches
it. A shard's rows stay in the memory of its task while anchors pass by in packs.
First the positives are searched (one window without edges, same label), which
set the windows of the negatives (other labels).

Scores are exact: components are floor(256 * x), whole numbers, multiplied in
doubles where no sum can pass 2**53, else in 64-bit integers; a table whose scores
could leave 64 bits is refused with ValueError.

Rows with a NULL label, a NULL vector or a NULL or non-finite component take no
part. Shorter vectors end in zeros; empty ones score 0 with everything. Rows with
a NULL vec_id are found, after rows of the same score, but are no anchors.
Repeated rows are rows of their own: each anchor row gets its own answer, and an
anchor's copies are other rows of its label. A positive score below 0 leaves an
empty window. An empty table, or one without anchors, gives an empty result.
Columns other than vec_id, embedding and label are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationday.llm.common import on_workers, saved, table

SCALE = 256
ANCHORS, SHIFTED, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
SAMPLE_ROWS = 4096
ROUNDS = 8
CELL_ROWS = 800  # rows of an average cell, while the codebooks are small enough
MOST_CODES = 64
BLOCK_ROWS = 1024
SHARD_ROWS, SHARD_BYTES = 4096, 64 << 20  # least rows, most bytes
PACK = 256  # anchors of a pack
FAR = 1 << 62

BLOCK = "cell int, n int, ids array<bigint>, labels binary, rows binary, vectors binary, r1 double, r2 double"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vector, label) of the rows that take part, components scaled."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % SHIFTED == 0, (label + 1) % LABELS).otherwise(label)
    vector = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("double"))
    return rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"), shifted.alias("label"))


class Index:
    """The codebooks, and how vectors are stored and multiplied."""

    def __init__(self, dim: int, most: float, books: list[np.ndarray]):
        self.dim, self.cut, self.books = dim, dim // 2, books
        self.kind = np.dtype(next(k for k, top in (("<i2", 2**15), ("<i4", 2**31), ("<i8", 2**63)) if most < top))
        self.exact = np.float64 if dim * most * most < 2**53 else np.int64
        self.codes = len(books[0])

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def matrix(self, raw: bytes) -> np.ndarray:
        size = self.dim * self.kind.itemsize
        return np.frombuffer(raw, self.kind).reshape(len(raw) // size if size else 0, self.dim)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance of the first half, of the second) of each row."""
        found, far = [], []
        for half, book in zip(self.halves(x.astype(np.float64)), self.books):
            at = nearest(half, book)
            found.append(at)
            far.append(np.sqrt(((half - book[at]) ** 2).sum(axis=1)))
        return found[0] * self.codes + found[1], far[0], far[1]


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book * book).sum(axis=1) - 2 * (x @ book.T), axis=1)


def codebook(x: np.ndarray, codes: int) -> np.ndarray:
    """k-means from evenly spaced rows of the sample."""
    book = x[np.linspace(0, len(x) - 1, codes).astype(np.int64)].copy()
    for _ in range(ROUNDS):
        at = nearest(x, book)
        size = np.bincount(at, minlength=codes)
        total = np.zeros_like(book)
        np.add.at(total, at, x)
        book[size > 0] = total[size > 0] / size[size > 0, None]
    return book


def dense(vectors: pa.Array, dim: int) -> np.ndarray:
    """A list column as one matrix; short rows end in zeros."""
    offs = vectors.offsets.to_numpy()
    size = np.diff(offs)
    out = np.zeros((len(size), dim))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(offs[:-1] - offs[0], size)] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def fit(rows: DataFrame) -> tuple[Index, int] | None:
    """The index's codebooks and the number of rows; None for no rows."""
    most = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))
    n, dim, most = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), most).first()
    if not n:
        return None
    dim, most = max(dim, 1), most or 0.0
    if dim * most * most >= 2**63:
        raise ValueError("scores of these vectors do not fit 64 bits")
    sample = rows.select("vector").filter(F.rand(11) < min(1.0, SAMPLE_ROWS / n)).toArrow()
    x = dense(sample.column(0).combine_chunks(), dim) if sample.num_rows else np.zeros((1, dim))
    codes = max(1, min(MOST_CODES, round(math.sqrt(n / CELL_ROWS)), len(x)))
    return Index(dim, most, [codebook(h, codes) for h in (x[:, : dim // 2], x[:, dim // 2 :])]), n


def blocks_of(rows: DataFrame, index) -> DataFrame:
    """The inverted lists: rows of one cell packed together, each row with a
    number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ix: Index = index.value
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            x = dense(batch.column(1), ix.dim)
            cell, r1, r2 = ix.encode(x)
            order = np.argsort(cell, kind="stable")
            ids, labels = batch.column(0).take(pa.array(order)), batch.column(2).to_numpy()[order]
            x, cell, r1, r2 = x[order].astype(ix.kind), cell[order], r1[order], r2[order]
            rows_ = number + np.arange(len(order))
            number += len(order)
            cuts = set((np.flatnonzero(np.diff(cell)) + 1).tolist())
            out, lo = [], 0
            for hi in range(1, len(order) + 1):
                if hi == len(order) or hi in cuts or hi - lo == BLOCK_ROWS:
                    out.append((int(cell[lo]), hi - lo, ids[lo:hi].to_pylist(), labels[lo:hi].tobytes(), rows_[lo:hi].tobytes(), x[lo:hi].tobytes(), float(r1[lo:hi].max()), float(r2[lo:hi].max())))
                    lo = hi
            if out:
                yield _table(out, BLOCK)

    return rows.mapInArrow(run, BLOCK)


_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split(" ") for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, _TYPES[t]) for x, (_, t) in zip(zip(*rows), fields)], names=[c for c, _ in fields])


class Shards:
    """Which shards a cell's rows are in, and the bounds of every shard."""

    def __init__(self, cells: list[tuple[int, int, float, float]], most: int):
        """cells: (cell, rows, r1, r2), in order of cells."""
        self.of: dict[int, tuple[int, int]] = {}
        used, room, entries = -1, 0, []
        for cell, n, r1, r2 in cells:
            parts = -(-n // most)
            if parts > 1 or n > room:
                first, used = used + 1, used + parts
                room = 0 if parts > 1 else most - n
            else:
                first, room = used, room - n
            self.of[cell] = first, parts
            entries += [(first + p, cell, r1, r2) for p in range(parts)]
        self.count = used + 1
        entries.sort()
        self.cell = np.array([e[1] for e in entries], np.int64)
        self.r1, self.r2 = (np.array([e[k] for e in entries]) for k in (2, 3))
        self.start = np.searchsorted(np.array([e[0] for e in entries]), np.arange(self.count))

    def bounds(self, ix: Index, x: np.ndarray) -> np.ndarray:
        """The best score each row of x can have in each shard."""
        first, second = ix.halves(x.astype(np.float64))
        best = (first @ ix.books[0].T)[:, self.cell // ix.codes] + (second @ ix.books[1].T)[:, self.cell % ix.codes]
        best += np.linalg.norm(first, axis=1)[:, None] * self.r1 + np.linalg.norm(second, axis=1)[:, None] * self.r2
        return slack(np.maximum.reduceat(best, self.start, axis=1))


def slack(bound):
    """A bound that rounding cannot have made too small."""
    return bound + 1e-9 * abs(bound) + 1e-6


class Shard:
    """The cells of one shard in memory."""

    def __init__(self, ix: Index, blocks: list[dict]):
        self.ix = ix
        parts: dict[int, list[dict]] = {}
        for b in blocks:
            parts.setdefault(b["cell"], []).append(b)
        self.cells: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
        r1, r2 = {}, {}
        for cell, own in parts.items():
            ids = [i for b in own for i in b["ids"]]
            known = np.array([i is not None for i in ids])
            x = ix.matrix(b"".join(b["vectors"] for b in own)).astype(ix.exact)
            i, j = divmod(cell, ix.codes)
            self.cells[i, j] = x, np.array([i_ or 0 for i_ in ids], np.int64), ~known, *(np.frombuffer(b"".join(b[c] for b in own), np.int64) for c in ("labels", "rows"))
            r1[i] = max(r1.get(i, 0.0), *(b["r1"] for b in own))
            r2[j] = max(r2.get(j, 0.0), *(b["r2"] for b in own))
        self.sides = [(np.array(list(r)), np.array(list(r.values()))) for r in (r1, r2)]

    def visits(self, a: np.ndarray) -> Iterator[tuple[float, tuple[int, int]]]:
        """(bound, cell) in falling order of the bounds. One of a large cell's
        shards may have got none of its blocks."""
        if not self.cells:
            return
        halves = []
        for h, (at, r), book in zip(self.ix.halves(a[None].astype(np.float64)), self.sides, self.ix.books):
            bound = h[0] @ book[at].T + np.linalg.norm(h[0]) * r
            order = np.argsort(-bound, kind="stable")
            halves.append((bound[order].tolist(), at[order].tolist()))
        (u1, i1), (u2, i2) = halves
        heap = [(-(u1[0] + u2[0]), 0, 0)]
        while heap:
            bound, x, y = heapq.heappop(heap)
            if x + 1 < len(u1):
                heapq.heappush(heap, (-(u1[x + 1] + u2[y]), x + 1, y))
            if x == 0 and y + 1 < len(u2):
                heapq.heappush(heap, (-(u1[0] + u2[y + 1]), 0, y + 1))
            yield slack(-bound), (i1[x], i2[y])

    def search(self, a: np.ndarray, label: int, row: int, same: bool, windows: list[tuple[int, int, int]], k: int) -> list[list[tuple]]:
        """For each window (least, most, to beat) the k best (score, id, row) of
        this shard, those below the score to beat left out."""
        found: list[list[tuple]] = [[] for _ in windows]
        least = [max(lo, beat) for lo, _, beat in windows]
        top = max(hi for _, hi, _ in windows)
        a = a.astype(self.ix.exact)
        for bound, cell in self.visits(a):
            if bound < min(least):
                break
            if cell not in self.cells:
                continue
            x, ids, unknown, labels, rows = self.cells[cell]
            score = x @ a
            fits = (score >= min(least)) & (score <= top)
            fits &= ((labels == label) & (rows != row)) if same else (labels != label)
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            at = at[np.lexsort((ids[at], unknown[at], -score[at]))]
            falling = -score[at]
            for w, (_, hi, _) in enumerate(windows):
                start = np.searchsorted(falling, -hi, side="left")
                own = [(int(-falling[p]), None if unknown[at[p]] else int(ids[at[p]]), int(rows[at[p]])) for p in range(start, min(start + k, len(at))) if -falling[p] >= least[w]]
                if own:
                    found[w] = sorted(found[w] + own, key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
                    if len(found[w]) == k:
                        least[w] = max(least[w], found[w][-1][0])
        return found


PACKED = "shard int, kind int, cell int, n int, ids array<bigint>, labels binary, rows binary, vectors binary, r1 double, r2 double, windows binary"
FOUND = "anchor bigint, slot int, score bigint, vec_id bigint, row bigint"


def packs(anchors: DataFrame, index, shards, first: bool) -> DataFrame:
    """Anchors(row, label, vector, windows) as packs for the shards to search:
    the one with the best bound, or all others whose bound reaches a score that a
    window still takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, sh = index.value, shards.value
        for batch in batches:
            for lo in range(0, batch.num_rows, PACK):
                part = batch.slice(lo, PACK)
                x = ix.matrix(b"".join(part.column(2).to_pylist()))
                rows, labels = part.column(0).to_numpy(), part.column(1).to_numpy()
                windows = [np.frombuffer(w, np.int64).reshape(-1, 3) for w in part.column(3).to_pylist()]
                bounds = sh.bounds(ix, x)
                best = np.arange(sh.count) == bounds.argmax(axis=1)[:, None]
                least = np.array([w[:, [0, 2]].max(axis=1).min() for w in windows])
                go = best if first else ~best & (bounds >= least[:, None])
                out = []
                for s in np.flatnonzero(go.any(axis=0)):
                    at = np.flatnonzero(go[:, s])
                    sizes = np.array([len(windows[p]) for p in at], np.int64)
                    out.append((int(s), 1, 0, len(at), None, labels[at].tobytes(), rows[at].tobytes(), x[at].tobytes(), None, None, sizes.tobytes() + b"".join(windows[p].tobytes() for p in at)))
                if out:
                    yield _table(out, PACKED)

    return anchors.select("row", "label", "vector", "windows").mapInArrow(run, PACKED)


def searched(blocks: DataFrame, packed: DataFrame, index, same: bool, k: int) -> DataFrame:
    """(anchor, slot, score, vec_id, row): each shard's best rows for each window
    of the anchors that come to it."""
    rows = blocks.select("shard", F.lit(0).alias("kind"), "cell", "n", "ids", "labels", "rows", "vectors", "r1", "r2", F.lit(None).cast("binary").alias("windows"))
    rows = rows.join(packed.select("shard").distinct(), "shard", "left_semi")
    both = rows.unionByName(packed).repartition("shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = index.value
        at, held, shard = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != at:
                    at, held, shard = row["shard"], [], None
                if row["kind"] == 0:
                    held.append(row)
                    continue
                if shard is None:
                    shard, held = Shard(ix, held), []
                labels, keys = (np.frombuffer(row[c], np.int64) for c in ("labels", "rows"))
                x, w = ix.matrix(row["vectors"]), np.frombuffer(row["windows"], np.int64)
                ends = row["n"] + 3 * np.cumsum(w[: row["n"]])
                out = []
                for p in range(row["n"]):
                    windows = [tuple(v) for v in w[ends[p] - 3 * w[p] : ends[p]].reshape(-1, 3).tolist()]
                    for slot, best in enumerate(shard.search(x[p], labels[p], keys[p], same, windows, k)):
                        out += [(int(keys[p]), slot, *s) for s in best]
                if out:
                    yield _table(out, FOUND)

    return both.mapInArrow(run, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """found with rank: the k best of every (anchor, slot)."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _binary(values: Column) -> Column:
    """Longs as little-endian bytes."""
    hexed = F.transform(values, lambda v: F.regexp_replace(F.lpad(F.hex(v), 16, "0"), "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1"))
    return F.unhex(F.array_join(hexed, ""))


def in_two_rounds(blocks: DataFrame, anchors: DataFrame, index, shards, same: bool, k: int, name: str) -> DataFrame:
    """The k best rows for all windows of anchors(row, label, vector, edges), where
    edges has (least, most) for each slot."""
    start = F.flatten(F.transform("edges", lambda e: F.array(e["lo"], e["hi"], F.lit(-FAR))))
    first = anchors.select("row", "label", "vector", _binary(start).alias("windows"))
    near = saved(best(searched(blocks, packs(first, index, shards, True), index, same, k), k).drop("rank"), f"{name}-first")
    beat = near.groupBy("anchor", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).filter(F.col("n") == k)
    beat = beat.groupBy(F.col("anchor").alias("row")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("beat"))
    beats = F.flatten(F.transform("edges", lambda e, s: F.array(e["lo"], e["hi"], F.coalesce(F.try_element_at("beat", s), F.lit(-FAR)))))
    second = anchors.join(beat, "row", "left").select("row", "label", "vector", _binary(beats).alias("windows"))
    rest = searched(blocks, packs(second, index, shards, False), index, same, k)
    return saved(best(near.unionByName(rest), k), name)


def hard_negatives(rows: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) over rows(vec_id, embedding, label)."""
    spark = rows.sparkSession
    on_workers(spark)
    rows = usable(rows)
    fitted = fit(rows)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if fitted is None:
        return spark.createDataFrame([], schema)
    index, n = spark.sparkContext.broadcast(fitted[0]), fitted[1]
    stored = saved(blocks_of(rows, index), "negatives-blocks")
    cells = stored.groupBy("cell").agg(F.sum("n").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).orderBy("cell").collect()
    most = SHARD_BYTES // (fitted[0].dim * fitted[0].kind.itemsize) or 1
    plan = Shards([tuple(c) for c in cells], max(1, min(most, max(SHARD_ROWS, n // (2 * spark.sparkContext.defaultParallelism)))))
    shards = spark.sparkContext.broadcast(plan)
    dealt = spark.createDataFrame([(c, *x) for c, x in plan.of.items()], "cell int, first int, parts int")
    blocks = saved(stored.join(dealt, "cell").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("rows"), F.col("parts"))).cast("int")).drop("first", "parts"), "negatives-shards")
    anchors = saved(anchors_of(blocks, index), "negatives-anchors")
    whole = F.array(F.struct(F.lit(-FAR).alias("lo"), F.lit(FAR).alias("hi")))
    positives = in_two_rounds(blocks, anchors.withColumn("edges", whole), index, shards, True, POSITIVES, "negatives-positives")
    # the least and the greatest whole score of a window; none below 0
    lo, hi = F.expr(f"(CAST(score AS decimal(20,0)) * {LOW} + 99) div 100"), F.expr(f"CAST(score AS decimal(20,0)) * {HIGH} div 100")
    positives = positives.filter("score >= 0").select("anchor", (F.row_number().over(Window.partitionBy("anchor").orderBy("rank")) - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), lo.alias("lo"), hi.alias("hi"))
    positives = saved(positives, "negatives-windows")
    edges = positives.groupBy(F.col("anchor").alias("row")).agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", "lo", "hi"))), lambda e: F.struct(e["lo"].alias("lo"), e["hi"].alias("hi"))).alias("edges"))
    wanted = saved(anchors.join(edges, "row"), "negatives-wanted")
    found = in_two_rounds(blocks, wanted, index, shards, False, NEGATIVES, "negatives-found")
    out = found.join(positives, ["anchor", "slot"]).join(anchors.select(F.col("row").alias("anchor"), "anchor_id"), "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ANCHOR = "row bigint, anchor_id bigint, label bigint, vector binary"


def anchors_of(blocks: DataFrame, index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = index.value
        for batch in batches:
            out = []
            for ids, labels, rows, vectors in zip(*(c.to_pylist() for c in batch.columns)):
                x, (labels, rows) = ix.matrix(vectors), (np.frombuffer(b, np.int64) for b in (labels, rows))
                out += [(int(rows[p]), i, int(labels[p]), x[p].tobytes()) for p, i in enumerate(ids) if i is not None and i % ANCHORS == 0]
            if out:
                yield _table(out, ANCHOR)

    return blocks.select("ids", "labels", "rows", "vectors").mapInArrow(run, ANCHOR)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
