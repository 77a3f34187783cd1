"""Language model scores: Katz backoff of any order with Good-Turing discounts.

Tokens are the words of a text (A-Z folded) and one end; before its first token
a text has start marks. With c a training count, h the tokens before w (order - 1
of them) and h' all of them but the first:

* a seen n-gram has P(w|h) = d(c) c(hw) / (c(h) + 1), d Katz's Good-Turing
  discount for counts up to ``K``; the reserved count keeps some mass for what
  was not seen even where no count is discounted;
* others back off: P(w|h) = alpha(h) P(w|h'), alpha(h) the free mass of h over
  the free mass of P(.|h'), so that the probabilities of all words and of the
  unknown word sum to 1 exactly; a history never seen has alpha 1;
* P(w) = d(c) c(w) / (N + 1), and the unknown word has what is left.

**Tables.** Texts become chunks of about ``CHUNK_BYTES``, stored once as numbers of
the chunk's own words. For each order in turn a chunk sends its *distinct* n-grams
(not its tokens) to buckets: words by their hash, longer ones by their history, so
that a bucket has all there is of a history. A bucket adds the counts up, stores
its part of the order's table, and answers each chunk: counts of its n-grams and,
for each history, the counts of counts and the lower-order mass that alpha needs.
Words get numbers in the first round, so an n-gram is exact numbers, not a hash.
Discounts depend on counts of counts over all buckets, so answers keep them
symbolic, and a chunk evaluates the recursion for its tokens at the end.

**Hot histories.** A history with ``HOT`` of all training tokens or more (so there
are 1 / HOT of them at most) is split over the buckets by word. What its alpha
needs is summed over the buckets and broadcast.

NULL and empty texts have one token, the end. Without training rows all counts
are 0. Rows are scored one by one; an empty table gives an empty result. Only
the id and the text are looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.llm import words as W
from stationday.llm.common import crc_mod, on_workers, saved, table

ORDER = 2
K = 5
HOT = 2.0**-16
CHUNK_BYTES = 6 << 20
CHUNK_ROWS = 60_000
BUCKET_TOKENS = 1_000_000

END = np.uint64(2)  # the hash of a text's end; as a history, 0 is the start


# --- packing ------------------------------------------------------------------


_zstd: list = []  # a compressor and a decompressor, made where they are used


def _coders() -> list:
    if not _zstd:
        _zstd[:] = [zstandard.ZstdCompressor(level=3, write_checksum=False), zstandard.ZstdDecompressor()]
    return _zstd


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers (in the smallest width that holds them) or of
    doubles as one compressed value; bytes of equal weight stand together."""
    out = [np.array([len(arrays)], "<i8").tobytes()]
    for a in arrays:
        if a.dtype.kind == "f":
            a, code, width = a.astype("<f8"), 0, 8
        else:
            most = int(a.max()) if len(a) else 0
            code = width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
            a = a.astype(f"<u{code}")
        out += [np.array([code, len(a)], "<i8").tobytes(), np.ascontiguousarray(a.view(np.uint8).reshape(len(a), width).T).tobytes()]
    return _coders()[0].compress(b"".join(out))


def unpack(raw: bytes) -> list[np.ndarray]:
    raw = _coders()[1].decompress(raw)
    out, at = [], 8
    for _ in range(int(np.frombuffer(raw, "<i8", 1)[0])):
        code, n = np.frombuffer(raw, "<i8", 2, at).tolist()
        width = code or 8
        planes = np.frombuffer(raw, np.uint8, n * width, at + 16).reshape(width, n)
        a = np.ascontiguousarray(planes.T).reshape(-1).view(np.dtype("<f8" if code == 0 else f"<u{code}"))
        out.append(a if code == 0 else a.astype(np.int64))
        at += 16 + n * width
    return out


def joined(raws: list[bytes], n: int) -> list[np.ndarray]:
    """The n arrays of several packed values, each joined."""
    parts = [unpack(r) for r in raws]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(n)]


#: kind 0: a chunk; 1: what a chunk sends to a bucket, or the answer; 2: a part of
#: an order's table; 3: counts of counts (1 to K + 1), distinct n-grams and tokens;
#: 4: a bucket's share in a hot history ``key``: counts of counts 1 to K, lower mass.
ROWS = "kind int, ord int, chunk bigint, bucket bigint, ids array<{id}>, data binary, key binary, s array<bigint>, lower double"
NAMES = ["kind", "ord", "chunk", "bucket", "ids", "data", "key", "s", "lower"]


def _rows(rows: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), ids, pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.float64()]
    cols = zip(*rows) if rows else [()] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=NAMES)


def _per_bucket(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """(bucket, places) of each bucket of sorted buckets."""
    if not len(bucket):
        return []
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


# --- chunks ---------------------------------------------------------------------


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens, in order, and how many each text has."""
    w = W.words(texts)
    n = len(w.ptr) - 1
    out = np.full(len(w.hash) + n, END, np.uint64)
    is_end = np.zeros(len(out), bool)
    is_end[w.ptr[1:] + np.arange(n)] = True
    out[~is_end] = w.hash
    return out, w.counts + 1


def chunks(rows: DataFrame, buckets: int) -> DataFrame:
    """The texts of rows(id, train, text) as chunks, training rows first, and the
    words that each chunk sends to the buckets with their training counts."""
    id_type = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in W.row_slices(batch.column(2), CHUNK_BYTES):
                for at in range(lo, hi, CHUNK_ROWS):
                    part = batch.slice(at, min(CHUNK_ROWS, hi - at))
                    train = part.column(1).to_numpy(zero_copy_only=False)
                    order = np.argsort(~train, kind="stable")
                    part = part.take(pa.array(order))
                    word, counts = tokens(part.column(2))
                    vocabulary, local, often = np.unique(word, return_inverse=True, return_counts=True)
                    place = np.empty(len(vocabulary), np.int64)  # frequent words get small numbers
                    place[np.argsort(-often, kind="stable")] = np.arange(len(place))
                    local = place[local]
                    own = np.empty_like(vocabulary)
                    own[place] = vocabulary
                    bucket = (own % np.uint64(buckets)).astype(np.int64)
                    n_train = int(np.count_nonzero(train))
                    c = np.bincount(local[: counts[:n_train].sum()], minlength=len(own))
                    out = [(0, 1, chunk, -1, part.column(0).to_pylist(), pack(np.array([n_train]), counts, local, bucket), None, None, None)]
                    by = np.argsort(bucket, kind="stable")
                    out += [(1, 1, chunk, b, None, pack(own[by[s]], c[by[s]]), None, None, None) for b, s in _per_bucket(bucket[by])]
                    chunk += 1
                    yield _rows(out, pa.list_(batch.column(0).type))

    return rows.mapInArrow(run, ROWS.format(id=id_type))


class Model:
    """What is known of the whole corpus: for each order the discounts, the
    counts of hot histories' n-grams and their lower mass."""

    def __init__(self, texts: int):
        self.texts, self.n, self.v, self.unknown = texts, 0, 0, 1.0
        self.d: dict[int, np.ndarray] = {}  # discounted counts 0 to K
        self.hot: dict[int, dict[bytes, tuple]] = {}

    def learn(self, order: int, s: list[int], hot: list) -> None:
        """s: counts of counts 1 to K + 1, distinct n-grams, tokens."""
        d = discounts(s[: K + 1])
        self.d[order] = np.array([0.0, *(r * x for r, x in enumerate(d, 1))])
        self.hot[order] = {bytes(r["key"]): (r["s"], r["lower"]) for r in hot}
        if order == 1:
            self.v, self.n = s[K + 1], s[K + 2]
            low = sum(r * x for r, x in enumerate(s[:K], 1))
            mass = self.n - low + sum(self.d[1][r] * s[r - 1] for r in range(1, K + 1))
            self.unknown = 1.0 - mass / (self.n + 1)

    def discounted(self, order: int, c: np.ndarray) -> np.ndarray:
        return np.where(c > K, c, self.d[order][np.minimum(c, K)])

    def word(self, c: np.ndarray) -> np.ndarray:
        """The probability of words with the counts c."""
        return np.where(c > 0, self.discounted(1, c) / (self.n + 1), self.unknown)

    def least_hot(self, share: float) -> float:
        return max(2.0, share * self.n)


class Chunk:
    """A chunk's tokens and, order by order, the answers of the buckets."""

    def __init__(self, rows: list[dict], model: Model, share: float, buckets: int):
        own = next(r for r in rows if r["kind"] == 0)
        self.number, self.ids = own["chunk"], own["ids"]
        (train,), self.counts, self.word, bucket = unpack(own["data"])
        self.train = int(train)
        self.model, self.share, self.buckets = model, share, buckets
        self.begins = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64)
        self.n_train = int(self.counts[: self.train].sum())
        answers: dict[int, list[dict]] = {}
        for r in sorted((r for r in rows if r["kind"] == 1), key=lambda r: (r["ord"], r["bucket"])):
            answers.setdefault(r["ord"], []).append(r)
        self.id, count = (np.empty(len(bucket), np.int64) for _ in range(2))
        by = np.argsort(bucket, kind="stable")  # the order in which the words were sent
        self.id[by], count[by] = joined([r["data"] for r in answers[1]], 2)
        self.id += 1  # 0 is the start
        self.c = count[self.word]  # of the tokens' n-grams, of the order reached so far
        self.known = self.c
        self.p = model.word(self.c)
        self.histories = [np.zeros(len(self.word), np.int64)]
        for order in range(2, max(answers) + 1):
            self.step(order)
            self.answer([r["data"] for r in answers[order]])

    def shifted(self, x: np.ndarray, start) -> np.ndarray:
        """x of the token before, in the same text."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.begins] = start
        return out

    def step(self, order: int) -> None:
        """The distinct n-grams of an order as they go to the buckets."""
        self.order = order
        last = self.shifted(self.word + 1, 0)
        before = self.shifted(self.histories[-1], 0)
        # the start's number is the smallest, so texts begin with history 0
        history = np.unique(before * (len(self.id) + 2) + last, return_inverse=True)[1]
        self.histories.append(history)
        self.c_history = self.shifted(self.c, self.model.texts)
        pair, first, self.gram = np.unique(history * (len(self.id) + 1) + self.word, return_index=True, return_inverse=True)
        del pair
        self.first = first
        c = np.bincount(self.gram[: self.n_train], minlength=len(first))
        ids = np.concatenate([[0], self.id])
        self.tuples, back = [], last
        for _ in range(order - 1):  # the history's words, the last one first
            self.tuples.append(ids[back][first])
            back = self.shifted(back, 0)
        key = np.zeros(len(first), np.uint64)
        for x in self.tuples:
            key = W.mix(key + x.astype(np.uint64) + np.uint64(17))
        self.is_hot = self.c_history[first] >= self.model.least_hot(self.share)
        self.w = self.id[self.word[first]]
        key = np.where(self.is_hot, W.mix(key + self.w.astype(np.uint64)), key)
        bucket = (key % np.uint64(self.buckets)).astype(np.int64)
        self.by = np.lexsort((*self.tuples[::-1], bucket))
        self.bucket, self.grams_c, self.gram_history = bucket[self.by], c[self.by], history[first][self.by]

    def requests(self) -> Iterator[tuple]:
        """For each bucket: histories in order, the sizes of their runs, whether
        they are hot; the distinct words, which one each n-gram has, training
        counts; and what the lower order gives: for pairs the words' counts."""
        p, count = self.p[self.first], self.known[self.first]
        for b, s in _per_bucket(self.bucket):
            own = self.by[s]
            runs = self.runs(s)
            heads = own[runs]
            words_, at, which = np.unique(self.w[own], return_index=True, return_inverse=True)
            if self.order == 2:
                lower = (count[own][at],)
            else:
                values, code = np.unique(p[own], return_inverse=True)
                lower = (code, values)
            first, *others = (x[heads] for x in self.tuples)
            data = pack(np.diff(first, prepend=0), *others, np.diff(np.append(runs, len(own))), self.is_hot[heads], np.diff(words_, prepend=0), which, self.grams_c[s], *lower)
            yield (1, self.order, self.number, b, None, data, None, None, None)

    def runs(self, s: slice) -> np.ndarray:
        """Where each history begins within the places s."""
        h = self.gram_history[s]
        return np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))

    def answer(self, raws: list[bytes]) -> None:
        """Take the buckets' answers: probabilities of this order."""
        m, order = self.model, self.order
        c, t, lower = joined(raws, 3)
        t = t.reshape(-1, K)
        heads = np.concatenate([s.start + self.runs(s) for _, s in _per_bucket(self.bucket)]) if len(self.bucket) else np.zeros(0, np.int64)
        own = self.by[heads]
        for i in np.flatnonzero(self.is_hot[own]).tolist():
            key = np.array([x[own[i]] for x in self.tuples], "<i8").tobytes()
            t[i], lower[i] = m.hot[order].get(key, ([0] * K, 0.0))
        c_history = self.c_history[self.first[own]]
        r = np.arange(1, K + 1)
        mass = c_history - t @ r + t @ m.d[order][1:]
        alpha = np.where(c_history > 0, (1 - mass / (c_history + 1)) / (1 - lower), 1.0)
        run = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(self.by))))
        of_gram_c, of_gram_alpha = np.empty(len(self.by), np.int64), np.empty(len(self.by))
        of_gram_c[self.by], of_gram_alpha[self.by] = c, alpha[run]
        self.c = of_gram_c[self.gram]
        seen = m.discounted(order, self.c) / (self.c_history + 1)
        self.p = np.where(self.c > 0, seen, of_gram_alpha[self.gram] * self.p)


# --- buckets --------------------------------------------------------------------


def _counts_of_counts(c: np.ndarray, tokens_: int = 0) -> list[int]:
    of = np.bincount(np.minimum(c, K + 2), minlength=K + 3)[1 : K + 2]
    return [*of.tolist(), int((c > 0).sum()), tokens_]


def counted_words(sent: DataFrame, buckets: int) -> DataFrame:
    """The first round: exact counts and numbers of all words of a bucket."""
    id_type = sent.schema["ids"].dataType.elementType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        bucket, ids = t.column("bucket")[0].as_py(), t.schema.field("ids").type
        parts = [unpack(raw) for raw in t.column("data").to_pylist()]
        sizes = [len(p[0]) for p in parts]
        word, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        c = np.bincount(inverse, np.concatenate([p[1] for p in parts]), minlength=len(word)).astype(np.int64)
        place = np.empty(len(word), np.int64)  # frequent words get small numbers
        place[np.argsort(-c, kind="stable")] = np.arange(len(word))
        number = place * buckets + bucket
        ends = np.cumsum(sizes)
        out = [(1, 1, k, bucket, None, pack(number[inverse[e - n : e]], c[inverse[e - n : e]]), None, None, None) for k, n, e in zip(t.column("chunk").to_pylist(), sizes, ends.tolist())]
        out.append((2, 1, -1, bucket, None, pack(word.view(np.uint64), number, c), None, None, None))
        out.append((3, 1, -1, bucket, None, None, None, _counts_of_counts(c, int(c.sum())), None))
        return pa.Table.from_batches([_rows(out, ids)])

    return sent.groupBy("bucket").applyInArrow(run, ROWS.format(id=id_type))


def counted_grams(sent: DataFrame, order: int, shared) -> DataFrame:
    """Later rounds: exact counts of a bucket's n-grams, and for each history
    what its backoff weight needs."""
    id_type = sent.schema["ids"].dataType.elementType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        m: Model = shared.value
        bucket, ids = t.column("bucket")[0].as_py(), t.schema.field("ids").type
        raws, chunk = t.column("data").to_pylist(), t.column("chunk").to_pylist()
        h = order - 1
        heads, grams, lower, sizes, run_sizes = [[] for _ in range(h + 1)], [[] for _ in range(3)], [], [], []
        for raw in raws:
            parts = unpack(raw)
            for x, y in zip(heads, [np.cumsum(parts[0]), *parts[1:h], parts[h + 1]]):
                x.append(y)
            which = parts[h + 3]
            grams[0].append(np.cumsum(parts[h + 2])[which])
            grams[1].append(parts[h + 4])
            grams[2].append(parts[h])  # sizes of runs
            lower.append(m.word(parts[h + 5])[which] if order == 2 else parts[h + 6][parts[h + 5]])
            sizes.append(len(which))
            run_sizes.append(len(parts[h]))
        heads = [np.concatenate(x) for x in heads]
        w, c, size = (np.concatenate(x) for x in grams)
        lower = np.concatenate(lower)
        # number the histories, then the n-grams
        by = np.lexsort(heads[:h])
        new = np.zeros(len(by), bool)
        new[:1] = True
        for x in heads[:h]:
            new[1:] |= x[by][1:] != x[by][:-1]
        number = np.empty(len(by), np.int64)
        number[by] = np.cumsum(new) - 1
        one = by[new]  # a run of each history
        history = np.repeat(number, size)
        by = np.lexsort((w, history))
        new = np.ones(len(by), bool)
        new[1:] = (w[by][1:] != w[by][:-1]) | (history[by][1:] != history[by][:-1])
        gram = np.empty(len(by), np.int64)
        gram[by] = np.cumsum(new) - 1
        first = by[new]
        total = np.bincount(gram, c, minlength=len(first)).astype(np.int64)
        seen = np.flatnonzero(total)
        of = history[first[seen]]
        counts = np.zeros((len(one), K), np.int64)
        for r in range(1, K + 1):
            counts[:, r - 1] = np.bincount(of[total[seen] == r], minlength=len(one))
        mass = np.bincount(of, lower[first[seen]], minlength=len(one))
        out, at, run_at = [], 0, 0
        for k, n, runs in zip(chunk, sizes, run_sizes):
            own, c_own = number[run_at : run_at + runs], total[gram[at : at + n]]
            # only a history with an n-gram that was not seen backs off
            run = np.repeat(np.arange(runs), size[run_at : run_at + runs])
            back = np.bincount(run[c_own == 0], minlength=runs) > 0
            out.append((1, order, k, bucket, None, pack(c_own, (counts[own] * back[:, None]).ravel(), mass[own] * back), None, None, None))
            at, run_at = at + n, run_at + runs
        for i in np.flatnonzero(heads[h][one]).tolist():
            key = np.array([x[one[i]] for x in heads[:h]], "<i8").tobytes()
            out.append((4, order, -1, bucket, None, None, key, counts[i].tolist(), float(mass[i])))
        out.append((2, order, -1, bucket, None, pack(*(x[one] for x in heads[:h]), np.diff(of, prepend=0), w[first[seen]], total[seen]), None, None, None))
        out.append((3, order, -1, bucket, None, None, None, _counts_of_counts(total), None))
        return pa.Table.from_batches([_rows(out, ids)])

    return sent.groupBy("bucket").applyInArrow(run, ROWS.format(id=id_type))


def discounts(n: list[int]) -> list[float]:
    """Katz's d(1) .. d(K) from the counts of counts n(1) .. n(K + 1); where they
    do not give numbers in (0, 1], d(r) = 1 - 1 / 2r."""
    plain = [1 - 0.5 / r for r in range(1, K + 1)]
    if min(n[: K + 1]) <= 0:
        return plain
    rest = (K + 1) * n[K] / n[0]
    if rest >= 1:
        return plain
    d = [((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest) for r in range(1, K + 1)]
    return [x if 0 < x <= 1 else y for x, y in zip(d, plain)]


# --- the whole -------------------------------------------------------------------


def _learned(model: Model, order: int, answers: DataFrame) -> None:
    stats = answers.filter("kind = 3").agg(*(F.sum(F.col("s")[i]) for i in range(K + 3))).first()
    hot = answers.filter("kind = 4").groupBy("key").agg(F.array(*(F.sum(F.col("s")[i]) for i in range(K))).alias("s"), F.sum("lower").alias("lower"))
    model.learn(order, [x or 0 for x in stats], hot.collect() if order > 1 else [])


def _sender(shared, share: float, buckets: int, order: int):
    def send(t: pa.Table) -> pa.Table:
        c = Chunk(t.to_pylist(), shared.value, share, buckets)
        c.step(order)
        return pa.Table.from_batches([_rows(list(c.requests()), t.schema.field("ids").type)])

    return send


def katz_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", order: int = ORDER) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one
    row per row of docs; ``train`` names the rows to learn from."""
    spark: SparkSession = docs.sparkSession
    on_workers(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), "text")
    size, texts = rows.agg(F.sum(F.octet_length("text").cast("long")), F.sum(F.col("train").cast("long"))).first()
    buckets = max(1, math.ceil((size or 0) / 6 / BUCKET_TOKENS))
    stored = saved(chunks(rows, buckets), "katz-chunks")
    model = Model(texts or 0)
    answers = saved(counted_words(stored.filter("kind = 1"), buckets), "katz-words")
    _learned(model, 1, answers)
    id_type = dict(rows.dtypes)["id"]
    whole = stored.filter("kind = 0").unionByName(answers.filter("kind = 1"))
    share = HOT
    for k in range(2, order + 1):
        shared = spark.sparkContext.broadcast(model)
        sent = whole.groupBy("chunk").applyInArrow(_sender(shared, share, buckets, k), ROWS.format(id=id_type))
        answers = saved(counted_grams(sent, k, shared), f"katz-grams-{k}")
        _learned(model, k, answers)
        whole = whole.unionByName(answers.filter("kind = 1"))
    shared = spark.sparkContext.broadcast(model)

    def score(t: pa.Table) -> pa.Table:
        m = shared.value
        c = Chunk(t.to_pylist(), m, share, buckets)
        text = np.repeat(np.arange(len(c.counts)), c.counts)
        add = lambda x: np.bincount(text, x, minlength=len(c.counts))
        base = add(np.log10(c.known + 0.1)) - c.counts * math.log10(m.n + 0.1 * (m.v + 1))
        held_out = np.arange(len(c.counts)) >= c.train
        cols = [pa.array(c.ids, t.schema.field("ids").type.value_type), pa.array(held_out), pa.array(c.counts), pa.array(add(c.known > 0).astype(np.int64)), pa.array(base), pa.array(add(np.log10(c.p)))]
        return pa.table(cols, names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    schema = f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    out = whole.groupBy("chunk").applyInArrow(score, schema)
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def training_rows(doc_id: Column) -> Column:
    return crc_mod(doc_id, 10) != 0


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), training_rows(F.col("doc_id")))
