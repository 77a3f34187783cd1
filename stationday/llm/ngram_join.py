"""Near duplicates: a size-aware heavy-light join on word n-gram sets.

A document's set holds its distinct shingles of ``k`` words (A-Z folded); one
with fewer words has its whole sequence, one without words an empty set that
links with nothing. Two documents link when
``100 * |A & B| >= percent * |A | B|``.

Documents with equal sets form a class; classes are joined, copies are never
paired. Both sides of the join meet under keys:

* heavy sets (more than ``x`` shingles) scan inverted lists: a set is listed
  under its first ``s - ceil(t*s) + SHARED`` shingles in a global order, and any
  two sets that link share ``SHARED`` of them (all of the overlap, if that is
  smaller). A set with fewer keys in common with others links with none. The order puts shingles with a rare word
  first, so that lists stay short;
* light sets enumerate fixed-size subsets: all that leave out at most
  ``s - ceil(t*s)`` shingles. Two light sets that link share the subset that is
  their intersection. Light sets that may link with a heavy one are listed too.

The boundary ``x`` minimises the cost over the sizes there are: subsets to
enumerate against list entries, each of which costs ``SCAN_COST`` subsets.

Entries are (key, class), 16 bytes. Every list is named by its smallest class:
near copies share most of their lists, and most of these have the same name, so
a class is sent once for each name, with its keys under it, and not once for each
list. In the lists of a name two classes that share a key and whose sizes and
bitmaps allow a link become a candidate: a set's bitmap has a bit toggled by each
shingle, so two bitmaps differ in at most as many bits as the sets differ in
shingles, and no link is lost. Candidates are one packed row per class and name; a
pair that meets under several names stays with the first (``once``), and a set
is sent to the names where it has candidates. Each group gives, for every class, the number of documents it links with and a root;
the roots are merged by large-star/small-star rounds on tables in the shared
folder.

Lists of one name that are large are cut into blocks, and each pair of blocks is
a group of its own, so no group grows with a list or with a group of copies.
Tables of a step are deleted when the next one is written.

What the driver gets is of fixed size: word counts in ``2**WORD_BITS`` buckets and
a bitmap of ``2**BITS`` bits of the classes whose sets are needed, which only
save work and never decide a link, a histogram of small set sizes and single
numbers.

Rows that share a doc_id are separate documents of the same name. NULL ids
order first and take part; NULL and empty texts are their own component with no
shingles and no links; an empty table gives an empty result. Columns other than
doc_id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationday.llm import words as W
from stationday.llm.common import drop_saved, free_name, map_texts, on_workers, saved, table

K, PERCENT = 3, 90
BITS = 24  # log2 of the bits of a bitmap
WORD_BITS = 20  # log2 of the buckets of word counts
SCAN_COST = 4.0
MOST_LIGHT = 40  # sets above are never light, so that subsets stay few
BLOCK_COST = 1_000_000  # shingles (2,000 at least for each set) in a block
MIN_COST = 2_000
SHARED = 5  # first shingles that sets which link have in common, at least
TOGGLED = 512  # bits of a set's bitmap

_SUBSET = np.uint64(0x5851F42D4C957F2D)


def least_common(size, percent: int):
    """ceil(t * size): the fewest shingles a set shares with one it links to."""
    return -(-(size * percent) // 100)


def subsets(size: int, percent: int) -> int:
    """How many subsets a light set of that size enumerates."""
    return sum(math.comb(size, d) for d in range(size - least_common(size, percent) + 1))


def _sets(texts: pa.Array, k: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct shingles of every text, sorted, and the offsets of the texts;
    with the words' weights also that of the rarest word of each shingle."""
    w = W.words(texts)
    h, doc, pos = W.shingles(w, k)
    place = None
    if weight is not None:
        of_word = weight[(w.hash >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
        place = of_word[pos]
        last = w.ptr[1:][doc] - 1
        for j in range(1, k):
            place = np.minimum(place, of_word[np.minimum(pos + j, last)])
    order = W.order_per_text(h, doc)
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    ptr = np.searchsorted(doc[keep], np.arange(len(texts) + 1))
    return (h[keep], ptr) if place is None else (h[keep], ptr, place[order][keep])


def word_weights(docs: DataFrame) -> np.ndarray:
    """For each bucket of words a whole number that grows with the log of their
    count in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << WORD_BITS, np.int64)
        for batch in batches:
            for lo, hi in W.row_slices(batch.column(0)):
                h = W.words(batch.column(0).slice(lo, hi - lo)).hash
                total += np.bincount((h >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "c"])

    found = docs.select("text").mapInArrow(run, "b int, c bigint").groupBy("b").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(1 << WORD_BITS)
    out[found.column("b").to_numpy()] = found.column("c").to_numpy()
    return np.round(8 * np.log2(1 + out)).astype(np.int64)


def _sums(h: np.ndarray, ptr: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit fingerprint of each set."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(W.mix(h + W.constants(1, seed)[0]), out=total[1:])
    return W.mix(total[ptr[1:]] - total[ptr[:-1]])


def _toggled(h: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """The bitmap of each set, one row of 64-bit words each: every shingle
    toggles one bit, so the distance of two bitmaps bounds that of the sets."""
    bits = np.zeros((len(ptr) - 1, TOGGLED), np.uint8)
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    np.bitwise_xor.at(bits, (doc, (h & np.uint64(TOGGLED - 1)).astype(np.int64)), 1)
    return np.packbits(bits, axis=1).view(np.uint64)


def _first(h: np.ndarray, ptr: np.ndarray, percent: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set in the global order (``place``, then the
    hash), and their offsets."""
    n = np.diff(ptr)
    take = np.minimum(n, n - least_common(n, percent) + SHARED)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, place, doc))
    rank = np.arange(len(h)) - ptr[:-1][doc]
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(take, out=out[1:])
    return h[order][rank < take[doc]], out


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _flagged(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    b = _bit(h)
    return (bitmap[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1


def _bitmap(rows: DataFrame, bit: Column) -> np.ndarray:
    """A bitmap with the bit numbers of all rows set: at most 2**BITS / 64 rows
    come to the driver."""
    b = rows.select(bit.alias("b"))
    words = b.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(b & 63 AS INT))")).alias("v")).collect()
    out = np.zeros(1 << (BITS - 6), np.int64)
    for r in words:
        out[r["w"]] = r["v"]
    return out.view(np.uint64)


def _lists(h: np.ndarray, ptr: np.ndarray, type_: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(h, type_))


def fingerprints(docs: DataFrame, k: int, seed: int) -> DataFrame:
    """(doc_id, n, cid, f2, bits): size, two fingerprints and the bitmap of the
    set of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, ptr = _sets(batch.column(1), k)
        cols = [batch.column(0), pa.array(np.diff(ptr), pa.int64()), *(pa.array(_sums(h, ptr, x).view(np.int64)) for x in (seed, seed + 7919))]
        cols.append(pa.array([x.tobytes() if n else None for x, n in zip(_toggled(h, ptr), np.diff(ptr))], pa.binary()))
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "cid", "f2", "bits"])

    return map_texts(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, n bigint, cid bigint, f2 bigint, bits binary")


def _keys(h: np.ndarray, ptr: np.ndarray, percent: int, light: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of every set, with offsets."""
    n = np.diff(ptr)
    first, at = _first(h, ptr, percent, place)
    listed = (n > light) | (n >= least_common(light + 1, percent))
    keep = np.repeat(listed, np.diff(at))
    counts = np.where(listed, np.diff(at), 0)
    small = np.flatnonzero((n > 0) & (n <= light))
    if not len(small):
        return first[keep], np.concatenate([[0], np.cumsum(counts)])
    parts, first = [], first[keep]
    ends = np.cumsum(counts)
    done = 0
    for i in small:
        own = W.mix(h[ptr[i] : ptr[i + 1]])
        size = len(own)
        total = own.sum(dtype=np.uint64)
        made = [W.mix(np.array([total], np.uint64) * _SUBSET + np.uint64(size))]
        for d in range(1, size - int(least_common(size, percent)) + 1):
            gone = own[np.array(list(combinations(range(size), d)))].sum(axis=1, dtype=np.uint64)
            made.append(W.mix((total - gone) * _SUBSET + np.uint64(size - d)))
        made = np.concatenate(made)
        parts += [first[done : ends[i]], made]
        done = ends[i]
        counts[i] += len(made)
    parts.append(first[done:])
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])


def entries(docs: DataFrame, k: int, percent: int, seed: int, light: int, weight: np.ndarray) -> DataFrame:
    """(key, cid): all keys of all classes. A task sends a class once, however
    many copies it has."""
    shared = docs.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for lo, hi in W.row_slices(batch.column(0)):
                h, ptr, place = _sets(batch.column(0).slice(lo, hi - lo), k, shared.value)
                cid = _sums(h, ptr, seed).view(np.int64)
                keys, at = _keys(h, ptr, percent, light, place)
                new = np.array([c not in sent and not sent.add(c) for c in cid.tolist()], bool)
                keep = np.repeat(new, np.diff(at))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)[keep]), pa.array(np.repeat(cid, np.diff(at))[keep])], names=["key", "cid"])

    return docs.select("text").mapInArrow(run, "key bigint, cid bigint")


def shared_entries(sent: DataFrame) -> DataFrame:
    """(cid, name, key): classes under the keys that more than one class has;
    a list's name is its smallest class. Lists are read as a sorted stream, so
    none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the entry before: key, class, its list's name, whether it is the list's first and not yet given out
        before: tuple[int, int, int, bool] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, cid = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if before:
                key, cid = np.concatenate([[before[0]], key]), np.concatenate([[before[1]], cid])
            keep = np.ones(len(key), bool)
            keep[1:] = (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])
            key, cid = key[keep], cid[keep]
            follows = np.zeros(len(key), bool)
            follows[1:] = key[1:] == key[:-1]
            first = ~follows
            first[0] = before[3] if before else True
            begin = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
            name = cid[begin]
            if before and not before[3]:
                name[begin == 0] = before[2]
            give = ~first
            give[:-1] |= follows[1:]
            if before and not before[3]:
                give[0] = False
            before = int(key[-1]), int(cid[-1]), int(name[-1]), bool(first[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[give]) for x in (cid, name, key)], names=["cid", "name", "key"])

    return sent.repartition("key").sortWithinPartitions("key", "cid").mapInArrow(run, "cid bigint, name bigint, key bigint")


def named_keys(shared: DataFrame, classes: DataFrame, percent: int, light: int) -> DataFrame:
    """(name, cid, n, bits, keys): each class under the names of its lists, with
    its keys there; classes with too few shared keys to link with any are left
    out. One exchange by class serves all of it."""
    own = shared.repartition("cid").groupBy("cid", "name").agg(F.collect_list("key").alias("keys"))
    own = own.withColumn("total", F.sum(F.size("keys")).over(Window.partitionBy("cid")))
    need = F.when(F.col("n") <= light, 1).otherwise(F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100)))
    rows = own.join(classes.select("cid", "n", "bits"), "cid").filter(F.col("total") >= need)
    return rows.select("name", "cid", "n", "bits", "keys")


def with_blocks(rows: DataFrame) -> DataFrame:
    """named_keys with what each name's lists are cut into; names of one class
    are left out."""
    cost = rows.groupBy("name").agg(F.count(F.lit(1)).alias("members"), F.sum(F.greatest("n", F.lit(MIN_COST))).alias("cost")).filter("members > 1")
    return rows.join(cost.select("name", F.ceil(F.col("cost") / BLOCK_COST).cast("int").alias("blocks")), "name")


def in_blocks(rows: DataFrame, group: str, *more: str) -> DataFrame:
    """Every row in each group (group, i, j) of two blocks that it belongs to."""
    own = F.pmod(F.xxhash64("cid"), F.col("blocks").cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    out = rows.withColumn("b", own).withColumn("o", other)
    return out.select(F.col(group).alias("key"), F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "cid", "n", *more)


def _meeting(keys: list[np.ndarray]) -> np.ndarray:
    """Which members have a key in common."""
    m = len(keys)
    out = np.zeros((m, m), bool)
    flat, member = np.concatenate(keys), np.repeat(np.arange(m), [len(x) for x in keys])
    order = np.argsort(flat, kind="stable")
    flat, member = flat[order], member[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    size = np.diff(np.append(starts, len(flat)))
    two = starts[size == 2]
    out[member[two], member[two + 1]] = True
    for at, n in zip(starts[size > 2].tolist(), size[size > 2].tolist()):
        own = member[at : at + n]
        out[np.ix_(own, own)] = True
    return out


def _pairs(cross: bool, block: np.ndarray, n: np.ndarray, meeting: np.ndarray, bits: np.ndarray, percent: int) -> list[np.ndarray]:
    """For each member, smallest sets first, the later members it may link with:
    they meet, and their sizes, bitmaps and the group's two blocks allow it."""
    out = []
    for a in range(len(n)):
        last = np.searchsorted(n, 100 * n[a] // percent, side="right")
        later = a + 1 + np.flatnonzero(meeting[a, a + 1 : max(last, a + 1)])
        if cross:
            later = later[block[later] != block[a]]
        if len(later):
            both = n[a] + n[later]
            # J >= t needs an overlap of t / (1 + t) of both sizes
            most = both - 2 * (-(-percent * both // (100 + percent)))
            later = later[np.bitwise_count(bits[later] ^ bits[a]).sum(axis=1) <= most]
        out.append(later)
    return out


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Rows sorted by (key, i, j) as tables of whole groups, with the range of
    rows of each group. One group and one batch are held at a time."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = (t if held is None else pa.concat_tables([held, t])).combine_chunks()
        change = np.zeros(t.num_rows, bool)
        change[0] = True
        for c in ("key", "i", "j"):
            x = t.column(c).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        starts = np.flatnonzero(change).tolist()
        if len(starts) > 1:
            yield t.slice(0, starts[-1]), list(zip(starts[:-1], starts[1:]))
        held = t.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held, [(0, held.num_rows)]


def _by_group(groups: DataFrame) -> DataFrame:
    return groups.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def candidates(groups: DataFrame, percent: int) -> DataFrame:
    """(key, i, j, cid, partners): for each class that may link with others in a
    group, those that come after it, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, ranges in _grouped(batches):
            name, i, j, b, cid, n = (t.column(c).to_numpy() for c in ("key", "i", "j", "b", "cid", "n"))
            bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(-1, TOGGLED // 64)
            lists = t.column("keys").combine_chunks()
            flat, offs = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            offs = offs - offs[0]
            out: list[tuple] = []
            for lo, hi in ranges:
                if hi - lo == 1:
                    continue
                rows = lo + np.lexsort((cid[lo:hi], n[lo:hi]))
                meeting = _meeting([flat[offs[r] : offs[r + 1]] for r in rows])
                pairs = _pairs(i[lo] != j[lo], b[rows], n[rows], meeting, bits[rows], percent)
                own, later = cid[rows], np.zeros(len(rows), bool)
                for partners in pairs:
                    later[partners] = True
                for a, partners in enumerate(pairs):
                    if len(partners) or later[a]:
                        out.append((int(name[lo]), int(i[lo]), int(j[lo]), int(own[a]), own[partners].tobytes()))
            if out:
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), types)], names=["key", "i", "j", "cid", "partners"])

    return _by_group(groups).mapInArrow(run, "key bigint, i int, j int, cid bigint, partners binary")


def once(found: DataFrame) -> DataFrame:
    """The candidates with each pair in one group only. The smaller set of a pair
    lists it in every group where they meet, so what a class has listed before
    is known from its own rows."""
    own = found.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("key", "i", "j", "partners"))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for cid, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = np.zeros(0, np.int64)
                for r in rows:
                    partners = np.frombuffer(r["partners"], np.int64)
                    if len(seen):
                        partners = partners[~np.isin(partners, seen)]
                    if len(rows) > 1:
                        seen = np.concatenate([seen, partners])
                    out.append((r["key"], r["i"], r["j"], cid, partners.tobytes()))
            if out:
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), types)], names=["key", "i", "j", "cid", "partners"])

    return own.mapInArrow(run, "key bigint, i int, j int, cid bigint, partners binary")


def _roots(m: int, pairs: list[np.ndarray]) -> np.ndarray:
    """The first member of each member's component."""
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, partners in enumerate(pairs):
        for p in partners.tolist():
            x, y = find(a), find(p)
            if x != y:
                root[max(x, y)] = min(x, y)
    return np.array([find(x) for x in range(m)], dtype=np.int64)


def needed_sets(docs: DataFrame, wanted: DataFrame, k: int, seed: int) -> DataFrame:
    """(cid, shingles): the whole sets of the wanted classes. A task sends a
    class once, however many copies it has; what the bitmap lets through
    besides is dropped by the join that follows."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted, F.shiftrightunsigned("cid", 64 - BITS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for lo, hi in W.row_slices(batch.column(0)):
                h, ptr = _sets(batch.column(0).slice(lo, hi - lo), k)
                cid = _sums(h, ptr, seed)
                rows = [r for r in np.flatnonzero(_flagged(bitmap.value, cid) & (np.diff(ptr) > 0)) if cid[r] not in sent and not sent.add(cid[r])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(cid[rows].view(np.int64)), pa.array([h[ptr[r] : ptr[r + 1]].tobytes() for r in rows], pa.binary())], names=["cid", "shingles"])

    found = docs.select("text").mapInArrow(run, "cid bigint, shingles binary").join(wanted.select("cid").distinct(), "cid", "left_semi")
    return found.dropDuplicates(["cid"])


def verified(groups: DataFrame, percent: int) -> DataFrame:
    """(cid, links, root): for each class of a group that links in it, the
    documents of the classes it links with, and the first class it is linked to
    there. A pair is in one group only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, ranges in _grouped(batches):
            cid, n, copies = (t.column(c).to_numpy() for c in ("cid", "n", "copies"))
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for lo, hi in ranges:
                part = t.slice(lo, hi - lo)
                at = {int(c): x for x, c in enumerate(cid[lo:hi])}
                pairs = [np.array([at[p] for p in np.frombuffer(raw, np.int64).tolist()], np.int64) for raw in part.column("partners").to_pylist()]
                sets = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
                links, pairs = _linked(sets, n[lo:hi], copies[lo:hi], pairs, percent)
                root, use = _roots(hi - lo, pairs), np.flatnonzero(links > 0)
                found.append((cid[lo:hi][use], links[use], cid[lo:hi][root[use]]))
            if found:
                cols = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays(cols, names=["cid", "links", "root"])

    return _by_group(groups).mapInArrow(run, "cid bigint, links bigint, root bigint")


def _linked(sets: list[np.ndarray], n: np.ndarray, copies: np.ndarray, pairs: list[np.ndarray], percent: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Exact overlaps of the candidate pairs: for each member the documents it
    links with, and the pairs that link."""
    links, out = np.zeros(len(n), np.int64), []
    for a, partners in enumerate(pairs):
        if len(partners):
            theirs = np.concatenate([sets[p] for p in partners])
            at = np.minimum(np.searchsorted(sets[a], theirs), n[a] - 1)
            ends = np.cumsum(n[partners])
            hits = np.concatenate([[0], np.cumsum(sets[a][at] == theirs)])
            common = hits[ends] - hits[ends - n[partners]]
            partners = partners[100 * common >= percent * (n[a] + n[partners] - common)]
            links[a] += copies[partners].sum()
            links[partners] += copies[a]
        out.append(partners)
    return links, out


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges(a, b): its component's smallest
    node, by large-star and small-star rounds."""
    edges = saved(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = saved(large, "cc-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = saved(small.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-small")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            # stars: every edge leads to the component's smallest node
            nodes = edges.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label")
            return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = state


def join_classes(docs: DataFrame, k: int = K, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, int]:
    """(documents, classes, seed of the fingerprints): documents(doc_id, n, cid) with cid NULL for empty
    sets, and classes(cid, n, copies, first_id, links, root); links counts the
    documents of other classes, root names the component."""
    spark = docs.sparkSession
    on_workers(spark)
    seed = 1
    while True:
        prints = saved(fingerprints(docs, k, seed), "join-prints")
        ids = prints.filter("n > 0").select("doc_id", "n", "cid", "f2", "bits")
        classes = saved(ids.groupBy("cid", "f2").agg(F.max("n").alias("n"), F.min("bits").alias("bits"), F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), F.col("doc_id").alias("id"))).alias("first_id")), "join-classes")
        if classes.groupBy("cid").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty():
            break
        seed += 1  # two sets share a fingerprint: take another one
    few = classes.filter(F.col("n") <= 2 * MOST_LIGHT).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()
    light = boundary({r["n"]: r["c"] for r in few}, percent)
    shared = saved(shared_entries(entries(docs, k, percent, seed, light, word_weights(docs))), "join-shared")
    named = saved(named_keys(shared, classes, percent, light), "join-names")
    drop_saved(shared)
    found = saved(candidates(in_blocks(with_blocks(named), "name", "bits", "keys"), percent), "join-candidates")
    drop_saved(named)
    rows = once(found).join(classes.select("cid", "n", "copies"), "cid").join(needed_sets(docs, found, k, seed), "cid")
    linked = saved(verified(rows.select("key", "i", "j", "cid", "n", "copies", "partners", "shingles"), percent), "join-links")
    drop_saved(found)
    links = linked.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    out = classes.drop("f2", "bits").join(links, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    out = saved(out.select("cid", "n", "copies", "first_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "cid").alias("root")), "join-result")
    drop_saved(linked, classes)
    return prints.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cid")).alias("cid")), out, seed


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The largest light size, by cost."""

    def cost(x: int) -> float:
        enumerate_ = sum(c * subsets(s, percent) for s, c in sizes.items() if s <= x)
        listed = sum(c * (s - least_common(s, percent) + SHARED) * SCAN_COST for s, c in sizes.items() if s > x or s >= least_common(x + 1, percent))
        return enumerate_ + listed

    return min(range(MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def near_duplicates(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per row of docs."""
    ids, classes, _ = join_classes(docs, k, percent)
    first = classes.groupBy("root").agg(F.min("first_id").alias("f"))
    named = classes.join(first, "root").select("cid", (F.col("copies") - 1 + F.col("links")).alias("l"), F.col("f.id").alias("component"), F.lit(True).alias("found"))
    out = ids.join(named, "cid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("found"), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("l", F.lit(0)).cast("long").alias("n_links"))


def one_per_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without near duplicates: of each component one document stays, the
    one with the smallest id (of several with that id, the smallest set
    fingerprint, then any one of the equal rows). Documents without words stay.

    The rows to drop are known by (id, set): only rows of components with more
    than one member are looked up, and only those that share both with the one
    that stays are told apart by a row number.
    """
    spark = docs.sparkSession
    _, classes, seed = join_classes(docs, k, percent)
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("first_id"), F.col("cid"))).alias("f"), F.sum("copies").alias("members")).filter("members > 1")
    names = docs.columns
    cid_, id_, keep_, in_ = (free_name(names, f"near_{x}") for x in ("cid", "id", "keep", "in"))
    grouped = saved(classes.join(first, "root").select(F.col("cid").alias(cid_), F.col("f.first_id.id").alias(id_), F.col("f.cid").alias(keep_), F.lit(True).alias(in_)), "join-groups")
    bitmap = spark.sparkContext.broadcast(_bitmap(grouped, F.shiftrightunsigned(cid_, 64 - BITS)))
    at = names.index("text")

    def looked_up(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in W.row_slices(batch.column(at)):
                    part = batch.slice(lo, hi - lo)
                    h, ptr = _sets(part.column(at), k)
                    cid = _sums(h, ptr, seed)
                    maybe = (np.diff(ptr) > 0) & _flagged(bitmap.value, cid)
                    out = pa.RecordBatch.from_arrays([*part.columns, pa.array(cid.view(np.int64))], names=[*names, cid_]) if wanted else part
                    yield out.filter(pa.array(maybe == wanted))

        return run

    # two passes over the texts: most rows go straight to the result, none is stored
    alone = docs.mapInArrow(looked_up(False), docs.schema)
    maybe = docs.mapInArrow(looked_up(True), docs.select("*", F.lit(0).cast("long").alias(cid_)).schema)
    maybe = saved(maybe.join(grouped, cid_, "left"), "join-marked")
    rest = maybe.filter(F.col(in_).isNull())
    stays = maybe.filter(F.col(in_) & (F.col(cid_) == F.col(keep_)) & F.col("doc_id").eqNullSafe(F.col(id_)))
    stays = stays.dropDuplicates([cid_])
    return alone.select(*names).unionByName(rest.select(*names)).unionByName(stays.select(*names))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
