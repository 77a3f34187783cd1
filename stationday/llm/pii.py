"""Personal data: candidate spans by high-recall patterns, chosen by boosted trees.

Each generator finds the leftmost non-overlapping matches of its pattern. The
patterns are written so that Java's matcher neither recurses nor starts again
inside a run it has refused: possessive groups, and a start only at the
beginning of a run or where the last match ended. Positions are code points:
the text is split at the matches and the lengths of the pieces are summed, in
chunks, so a text with very many matches stays linear.

Email, IP address, card and phone matches that pass their check (parts up to
255; 14 to 19 digits and Luhn; 10 to 15 digits) are always spans, and so are the
matches of the other generators (national phone numbers, identity numbers, bank
accounts, secrets, spelled-out addresses) that pass theirs. Gradient-boosted trees
over format and context features decide on candidates that fail a check that is
only a rule of thumb (``WEAK``: a mistyped identity number after "ssn" is still
private). They learn what private data looks like from other kinds: candidates of
``PROVEN`` kinds (of a card's length), whose checks (Luhn, mod 97) a number rarely passes by chance, are
counted per combination of binned features, which is at most ``CELLS`` rows
whatever the corpus. The kind is no feature, so no candidate is judged by a model
of its own check. The threshold is calibrated on the other half of the documents
to ``PRECISION``; where nothing reaches it, checked spans remain.

DataFrame functions only: detection and redaction are projections without a
shuffle, the trees become one Column expression, and only the table of feature
combinations reaches the driver.

NULL and empty texts have no spans (the digest of the empty string). Rows are
judged one by one, repeated rows agree, an empty table gives an empty result
and trains no trees (then only checked spans are selected). Columns other than
doc_id and text are not looked at; ``redact`` replaces text (and n_chars).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import free_name, saved, table

BASE = ("email", "ip", "card", "phone")

# Starting only where a run begins or the last match ended changes no match: if
# a start fails, so do all later starts in its run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "national": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)\x20{0,3}[=:]\x20{0,3}[\"']?[A-Za-z0-9_/+-]{12,}+",
    "spelled": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[\[(](?i:at)[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(](?i:dot)[\])]|\.)\x20?[A-Za-z0-9-]++)++",
}
KINDS = tuple(PATTERNS)
#: What a text must hold for a generator to run on it at all.
NEEDS = {
    "email": r"@",
    "phone": r"\+[0-9]",
    "secret": r"[=:]",
    "spelled": r"(?i)[\[(]at[\])]",
}
NEEDS_DIGIT = r"[0-9]"

CUES = r"(?i)(?:tel|phone|fax|call|mobile|mail|contact|card|visa|account|iban|ssn|social|token|key|secret|password|address|host)"
CONTEXT = 24

PROVEN = ("card", "account")
CARD_DIGITS = 4  # the bin of 14 to 19 digits
WEAK = ("national", "identity", "secret", "spelled")
FEATURES = ("digits", "length", "separators", "before", "after", "cue", "distinct")
DOMAIN = {"digits": 6, "length": 5, "separators": 4, "before": 3, "after": 3, "cue": 2, "distinct": 4}
CELLS = math.prod(DOMAIN.values())
ROUNDS = 24
RATE = 0.3
PRECISION = 0.95

CANDIDATE = "array<struct<kind:int,start:bigint,end:bigint,ok:boolean,digits:int,length:int,separators:int,before:int,after:int,cue:int,distinct:int>>"

CHUNK = 256


def running(lengths: Column) -> Column:
    """Sums of all earlier lengths, for each place of the array; in chunks, so
    that the cost of appending to an array stays linear in its length."""

    def chunk(k: Column) -> Column:
        return F.slice(lengths, k * CHUNK + 1, CHUNK)

    zero = F.lit(0).cast("long")
    n = F.ceil(F.size(lengths) / CHUNK).cast("int")
    totals = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: F.aggregate(chunk(k), zero, lambda a, x: a + x))

    def sums(values: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(values, start, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    starts = sums(totals, zero)
    return F.flatten(F.transform(starts, lambda first, k: sums(chunk(k), first)))


def _bin(value: Column, edges: tuple[int, ...]) -> Column:
    out = F.lit(0)
    for e in edges:
        out = out + (value > e).cast("int")
    return out


def _side(c: Column) -> Column:
    """0: nothing or white space, 1: other sign, 2: letter or digit."""
    return F.when((F.length(c) == 0) | c.rlike(r"^\s$"), 0).when(c.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(1)


def _check(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    if kind == "email" or kind == "spelled":
        return F.lit(True) if kind == "email" else hit.rlike(r"[A-Za-z]{2,}$")
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: p.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"))
    if kind == "card":
        return (n >= 14) & (n <= 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return (n >= 10) & (n <= 15)
    if kind == "national":
        return hit.rlike(r"^\(?[2-9][0-9]{2}\)?[^0-9]+[2-9]")
    if kind == "identity":
        return ~hit.rlike(r"^(?:000|666|9)|-00-|-0000$")
    if kind == "account":  # ISO 7064 mod 97: the first four signs go to the end, letters count from 10
        plain = F.regexp_replace(hit, r"\x20", "")
        turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
        value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(F.length(c) == 0, a).otherwise(F.pmod(a * F.when(value(c) > 9, 100).otherwise(10) + value(c), F.lit(97)).cast("int")))
        return rest == 1
    secret = F.regexp_extract(hit, r"[A-Za-z0-9_/+-]+$", 0)
    return secret.rlike("[0-9]") & secret.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(secret, ""))) >= 7)


def candidates(docs: DataFrame) -> DataFrame:
    """docs with a column ``_candidates``: all candidates of all generators."""
    out = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    out = out.withColumn("_digit", F.col("_text").rlike(NEEDS_DIGIT))
    for kind, pattern in PATTERNS.items():
        need = F.col("_text").rlike(NEEDS[kind]) if kind in NEEDS else F.lit(True)
        if kind not in ("email", "spelled"):
            need = F.col("_digit") & need
        hits = F.when(need, F.regexp_extract_all(F.col("_text"), F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
        out = out.withColumn(f"_hits_{kind}", hits)
        out = out.withColumn(f"_gaps_{kind}", F.when(F.size(f"_hits_{kind}") > 0, F.split("_text", pattern, -1)).otherwise(F.array().cast("array<string>")))
        out = out.withColumn(f"_starts_{kind}", F.when(F.size(f"_hits_{kind}") > 0, running(F.zip_with(f"_gaps_{kind}", f"_hits_{kind}", lambda g, h: (F.length(g) + F.coalesce(F.length(h), F.lit(0))).cast("long")))).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("_candidates", F.concat(*(_described(k) for k in KINDS)))
    return out.select(*docs.columns, "_candidates")


def _described(kind: str) -> Column:
    hits, gaps, starts = F.col(f"_hits_{kind}"), F.col(f"_gaps_{kind}"), F.col(f"_starts_{kind}")

    def one(hit: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        start = F.get(starts, i) + F.length(gap)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            start.alias("start"),
            (start + F.length(hit)).alias("end"),
            _check(kind, hit).alias("ok"),
            *features(hit, F.substring(gap, -CONTEXT, CONTEXT), F.substring(F.get(gaps, i + 1), 1, 1)),
        )

    return F.transform(hits, one).cast(CANDIDATE)


def features(hit: Column, before: Column, after: Column) -> list[Column]:
    seps = sum((hit.contains(s).cast("int") for s in (" ", "-", ".", "(")), F.lit(0))
    return [
        _bin(F.length(F.regexp_replace(hit, "[^0-9]", "")), (3, 6, 9, 13, 19)).alias("digits"),
        _bin(F.length(hit), (8, 16, 24, 40)).alias("length"),
        F.least(seps, F.lit(3)).alias("separators"),
        _side(F.substring(before, -1, 1)).alias("before"),
        _side(after).alias("after"),
        before.rlike(CUES).cast("int").alias("cue"),
        _bin(F.size(F.array_distinct(F.split(hit, ""))), (4, 7, 11)).alias("distinct"),
    ]


# --- boosted trees over the table of feature combinations -------------------

Split = tuple[int, int]  # feature number, edge: left is value <= edge
Node = tuple[Split, float, float] | float


def _left(x: tuple[int, ...], s: Split) -> bool:
    return x[s[0]] <= s[1]


def _grow(cells: list[tuple[tuple[int, ...], float, float]], depth: int):
    """A tree of (split, left, right) or a leaf value, by second-order gain.
    cells: (features, gradient, curvature)."""
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    if depth == 0 or len(cells) < 2:
        return g / (h + 1.0)
    best, split = 1e-9, None
    for f, name in enumerate(FEATURES):
        by: dict[int, list[float]] = {}
        for x, gx, hx in cells:
            t = by.setdefault(x[f], [0.0, 0.0])
            t[0] += gx
            t[1] += hx
        gl = hl = 0.0
        for v in sorted(by)[:-1]:
            gl, hl = gl + by[v][0], hl + by[v][1]
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            if gain > best:
                best, split = gain, (f, v)
    if split is None:
        return g / (h + 1.0)
    left = [c for c in cells if _left(c[0], split)]
    right = [c for c in cells if not _left(c[0], split)]
    if not left or not right:
        return g / (h + 1.0)
    return (split, _grow(left, depth - 1), _grow(right, depth - 1))


def _value(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[1] if _left(x, tree[0]) else tree[2]
    return tree


class Trees:
    """Base log odds, boosted trees, and the least log odds of a span."""

    def __init__(self, cells: list[tuple[tuple[int, ...], bool, int, int]]):
        """cells: (features, of the training half, rows, rows whose check passed)."""
        train = [(x, n, y) for x, t, n, y in cells if t]
        n, y = sum(c[1] for c in train), sum(c[2] for c in train)
        self.base = math.log((y + 1) / (n - y + 1))
        self.trees = []
        f = {x: self.base for x, _, _ in train}
        for _ in range(ROUNDS if train else 0):
            p = {x: 1 / (1 + math.exp(-v)) for x, v in f.items()}
            tree = _grow([(x, yx - nx * p[x], nx * p[x] * (1 - p[x])) for x, nx, yx in train], 2)
            self.trees.append(tree)
            for x in f:
                f[x] += RATE * _value(tree, x)
        self.least: float | None = None
        own = sorted(((self.log_odds(x), nx, yx) for x, t, nx, yx in cells if not t), reverse=True)
        rows = right = 0
        for i, (v, nx, yx) in enumerate(own):
            rows, right = rows + nx, right + yx
            tie = i + 1 < len(own) and own[i + 1][0] == v
            if not tie and right >= PRECISION * rows:
                self.least = v

    def log_odds(self, x: tuple[int, ...]) -> float:
        return self.base + RATE * sum(_value(t, x) for t in self.trees)

    def column(self, c: Column) -> Column:
        """The log odds of a candidate struct, as one expression."""

        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f = c[FEATURES[tree[0][0]]]
            return F.when(f <= tree[0][1], of(tree[1])).otherwise(of(tree[2]))

        out = F.lit(self.base)
        for t in self.trees:
            out = out + F.lit(RATE) * of(t)
        return out

    def chosen(self, c: Column) -> Column:
        """Whether a candidate is a span: a checked one, or one of a weak check
        that the trees choose."""
        if self.least is None:
            return c["ok"]
        weak = c["kind"].isin(*(KINDS.index(k) for k in WEAK))
        return c["ok"] | (weak & (self.column(c) >= F.lit(self.least - 1e-9)))


def train(found: DataFrame) -> Trees:
    """Trees from a frame with doc_id and ``_candidates``. Candidates of proven
    kinds are counted per feature combination and half before anything moves."""
    half = F.pmod(F.xxhash64(F.lit("pii"), F.col("doc_id")), F.lit(2)) == 0
    # a run of digits too short or too long for a card says nothing about cards
    fair = lambda c: (c["kind"] != KINDS.index("card")) | (c["digits"] == CARD_DIGITS)
    proven = F.filter("_candidates", lambda c: c["kind"].isin(*(KINDS.index(k) for k in PROVEN)) & fair(c))
    c = found.select(half.alias("t"), F.explode(proven).alias("c"))
    c = c.groupBy("t", *(F.col(f"c.{f}").alias(f) for f in FEATURES)).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c.ok").cast("long")).alias("y"))
    return Trees([(tuple(r[f] for f in FEATURES), r["t"], r["n"], r["y"] or 0) for r in c.orderBy("t", *FEATURES).collect()])


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, _candidates) of every row, written once: training and selection
    read it."""
    return saved(candidates(docs.select("doc_id", "text")).select("doc_id", "_candidates"), "pii-candidates")


def spans(found: DataFrame, trees: Trees) -> DataFrame:
    """One row per row: counts of checked spans by kind, their digest, all spans."""
    base = F.filter("_candidates", lambda c: (c["kind"] < len(BASE)) & c["ok"])
    out = found.withColumn("_base", base).withColumn("_all", F.filter("_candidates", trees.chosen))
    count = lambda k: F.size(F.filter("_base", lambda c: c["kind"] == k)).cast("long")
    return out.select("doc_id", *(count(k).alias(f"n_{BASE[k]}") for k in range(len(BASE))), F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"), _listed(F.col("_all")).alias("spans"))


#: A phone number covers any card or address inside it, an email all of them.
REDACTION_ORDER = ("email", "spelled", "phone", "card", "ip", "account", "national", "identity", "secret")


def redact(docs: DataFrame, trees: Trees) -> DataFrame:
    """docs with every selected span replaced by its kind in brackets, one kind
    after the other; n_chars, where there is one, follows the new text."""
    text, digit, hits, gaps = (free_name(docs.columns, x) for x in ("text", "digit", "hits", "gaps"))
    out = docs.withColumn(text, F.col("text")).withColumn(digit, F.col(text).rlike(NEEDS_DIGIT))
    for kind in REDACTION_ORDER:
        need = F.col(text).rlike(NEEDS[kind]) if kind in NEEDS else F.lit(True)
        if kind not in ("email", "spelled"):
            need = F.col(digit) & need
        out = out.withColumn(hits, F.when(need, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(F.array().cast("array<string>")))
        out = out.withColumn(gaps, F.when(F.size(hits) > 0, F.split(text, PATTERNS[kind], -1)).otherwise(F.array().cast("array<string>")))
        out = out.withColumn(text, F.when(F.size(hits) > 0, F.array_join(F.transform(gaps, _piece(kind, trees, hits, gaps)), "")).otherwise(F.col(text)))
    replaced: dict[str, Callable | Column] = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.when(F.col(text) == F.col("text"), F.col("n_chars")).otherwise(F.length(text).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*(replaced[c].alias(c) if c in replaced else F.col(f"`{c}`") for c in docs.columns))


def _piece(kind: str, trees: Trees, hits: str, gaps: str):
    number, mark = KINDS.index(kind), F.lit(f"[{kind.upper()}]")

    def piece(gap: Column, i: Column) -> Column:
        hit = F.get(F.col(hits), i)
        c = F.struct(F.lit(number).alias("kind"), _check(kind, hit).alias("ok"), *features(hit, F.substring(gap, -CONTEXT, CONTEXT), F.coalesce(F.substring(F.get(F.col(gaps), i + 1), 1, 1), F.lit(""))))
        return F.when(hit.isNull(), gap).when(F.exists(F.array(c), trees.chosen), F.concat(gap, mark)).otherwise(F.concat(gap, hit))

    return piece


def op1_pii(spark, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents"))
    return spans(found, train(found))
