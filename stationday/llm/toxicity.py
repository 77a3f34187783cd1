"""Toxicity by a weighted finite-state grammar over clauses.

Words are mapped to classes (insult, threat verb, target, modal, copula,
intensifier, determiner, negation, report verb, quote, other). Small weighted
transducers over these classes say what counts:

* insults: an insult weighs what was learned for it; a target beside it
  ("you idiot", "he is a moron") or an intensifier adds to it;
* threats: target or speaker, modal, threat verb, target ("we will hurt you",
  "we are going to hurt you"), the target also before the verb ("ich werde dich
  töten", "te voy a matar");
* negation: "not an idiot" keeps a part of the weight of the insult it governs;
* reported speech: a report verb or an opening quote before the match keeps a
  part ("she said: you idiot"). A colon after a report verb does not end the
  clause, and a quote stays open over clauses up to its end or the line's.

They are composed into one machine, of which the best path through a clause is
the clause's score (max-plus, one left-to-right pass). A clause without an
insult or a threat verb scores 0 and is never run, so words that only look
hostile elsewhere cost nothing. A text's evidence is the sum of its clauses'
scores; a logistic calibration on labelled rows makes it a probability.

Insults are learned: among the words of a bounded sample of labelled texts
(``SAMPLE_DOCS`` of each label, about ``SAMPLE_BYTES`` at most) those that
cover toxic texts and nearly no other ones, chosen greedily so that words which
only come along with a chosen one are not taken. A stem with any ending is learned
like a word (``lostr*``). A few seeds stand for what the sample may lack. Scoring is one pass over all whole texts without a shuffle.

NULL and empty texts have evidence 0. Without labels the seeds and a fixed
calibration are used. Rows are judged one by one; an empty table gives an empty
result. Of docs only doc_id and text are looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import crc_mod, table
from stationday.llm.quality import SAMPLE_BYTES, labelled_sample, platt

SAMPLE_DOCS = 1500
SHORTEST, LONGEST = 4, 8  # letters of a stem
COST = 20.0
THRESHOLD = 0.3

CLASSES = {
    "target": "you your yours yourself u ur he she they them him her it this that these those people "
    "du dich dir ihn ihr euch sie er tu toi te vous il elle ils usted ustedes ellos ella tú ti vosotros",
    "speaker": "i we ich wir je nous yo nosotros",
    "modal": "will shall going gonna should must can would ll werde werden soll vais allons",
    "vow": "voy vamos",
    "particle": "to zu",
    "copula": "is are was were be am m re s look looks seem seems sound sounds bist ist seid sind es est êtes eres es son",
    "intensifier": "so such really very total totally complete utter utterly absolute fucking damn bloody pure",
    "determiner": "a an the some another ein eine der die das un une le la un una el",
    "negation": "not no never isn aren wasn weren don doesn didn ain neither nor without nicht kein keine nie pas jamais non no nunca ni",
    "report": "said says say called calls wrote writes claimed claims quoted quote quotes reported reports word term sagte dit dijo",
    "threat": "kill hurt destroy beat stab shoot burn murder punish crush strangle töten tuer matar",
}
SEEDS = {"idiot": 3.0, "moron": 3.0, "stupid": 2.5, "scum": 3.0, "loser": 2.5, "pathetic": 2.5, "worthless": 2.5, "disgusting": 2.0, "imbecile": 3.0, "dumbass": 3.0}

#: Added for a target or an intensifier beside an insult, weight of a whole
#: threat, and what negation and report leave of a match.
NEAR, STRONG, THREAT, NEGATED, REPORTED = 1.0, 0.5, 4.0, 0.5, 0.7

_TOKEN = re.compile(r"[^\W\d_]+|[\"„“”«»]")
_CUT = re.compile(r"[.!?;:\n|]+")
_QUOTE = re.compile(r"[\"„“”«»\n]")
_LAST = re.compile(r"[^\W\d_]+\s*\Z")


@dataclass
class Machine:
    """A weighted transducer over classes. arcs[state][class] lists
    (next state, factor, gain): the weight of the word, if it has one, counts
    ``factor`` times and ``gain`` is added. ``*`` stands for any other class."""

    start: str
    arcs: dict[str, dict[str, list[tuple[str, float, float]]]]
    final: set[str] = field(default_factory=set)

    def step(self, state: str, cls: str) -> list[tuple[str, float, float]]:
        out = self.arcs[state]
        return out[cls] if cls in out else out.get("*", [])


def compose(inner: Machine, outer: Machine) -> Machine:
    """Both machines read the same classes; the outer one's factor scales what
    the inner one adds on the same word."""
    arcs: dict[str, dict[str, list[tuple[str, float, float]]]] = {}
    start = f"{inner.start}+{outer.start}"
    todo, final = [(inner.start, outer.start)], set()
    while todo:
        a, b = todo.pop()
        name = f"{a}+{b}"
        if name in arcs:
            continue
        arcs[name] = {}
        if a in inner.final and b in outer.final:
            final.add(name)
        for cls in sorted({*inner.arcs[a], *outer.arcs[b], "*"}):
            made = []
            for x, f, g in inner.step(a, cls):
                for y, f2, g2 in outer.step(b, cls):
                    made.append((f"{x}+{y}", f * f2, g * f2 + g2))
                    todo.append((x, y))
            arcs[name][cls] = made
    return Machine(start, arcs, final)


def insults() -> Machine:
    idle = ("idle", 0.0, 0.0)
    to = lambda s: (s, 0.0, 0.0)
    common = {"insult": [("after", 1.0, 0.0)], "target": [to("who")], "intensifier": [to("strong")], "*": [idle]}
    return Machine(
        "idle",
        {
            "idle": common,
            # a target, then copula, determiners and intensifiers, then the insult
            "who": {**common, "copula": [to("who")], "determiner": [to("who")], "negation": [to("who")], "intensifier": [to("who strong")], "insult": [("after", 1.0, NEAR)]},
            "who strong": {**common, "determiner": [to("who strong")], "insult": [("after", 1.0, NEAR + STRONG)]},
            "strong": {**common, "determiner": [to("strong")], "insult": [("after", 1.0, STRONG)]},
            "after": {**common, "target": [("who", 0.0, 0.0)]},
        },
        {"idle", "who", "who strong", "strong", "after"},
    )


def threats() -> Machine:
    idle, to = ("idle", 0.0, 0.0), lambda s: (s, 0.0, 0.0)
    base = {"speaker": [to("who")], "target": [to("whom")], "vow": [to("will")], "*": [idle]}
    who = {**base, "modal": [to("will")], "copula": [to("who")], "negation": [to("who")]}
    filler = ("modal", "copula", "intensifier", "particle", "determiner")
    return Machine(
        "idle",
        {
            "idle": base,
            "who": who,
            # "voy" has its subject in it, a target before it is the object
            "whom": {**who, "vow": [to("will"), to("object")]},
            "will": {**base, **{c: [to("will")] for c in filler}, "target": [to("whom"), to("object")], "threat": [to("verb")]},
            "object": {**base, **{c: [to("object")] for c in filler}, "target": [to("whom"), to("object")], "threat": [("idle", 0.0, THREAT)]},
            "verb": {**base, "determiner": [to("verb")], "target": [("whom", 0.0, THREAT)]},
        },
        {"idle", "who", "whom", "will", "object", "verb"},
    )


def negation() -> Machine:
    one, less = (1.0, 0.0), (NEGATED, 0.0)
    return Machine(
        "plain",
        {
            "plain": {"negation": [("negated", *one)], "*": [("plain", *one)]},
            "negated": {c: [("negated", *less)] for c in ("determiner", "intensifier", "copula", "negation", "threat", "modal", "vow", "particle")} | {"*": [("plain", *less)]},
        },
        {"plain", "negated"},
    )


def reported() -> Machine:
    one, less = (1.0, 0.0), (REPORTED, 0.0)
    return Machine(
        "own",
        {
            "own": {"report": [("report", *one)], "quote": [("quoted", *one)], "*": [("own", *one)]},
            # a report verb governs what follows directly, a quote all up to its end
            "report": {c: [("report", *less)] for c in ("target", "determiner", "copula", "intensifier", "negation", "modal", "vow", "speaker")} | {"quote": [("quoted", *less)], "*": [("own", *less)]},
            "quoted": {"quote": [("own", *less)], "*": [("quoted", *less)]},
        },
        {"own", "report", "quoted"},
    )


def grammar() -> list[Machine]:
    frame = compose(negation(), reported())
    return [compose(m, frame) for m in (insults(), threats())]


def best_path(machine: Machine, classes: list[str], weights: list[float]) -> float:
    """The largest total over all paths that end in a final state, at least 0."""
    at = {machine.start: 0.0}
    for cls, w in zip(classes, weights):
        nxt: dict[str, float] = {}
        for state, total in at.items():
            for to, factor, gain in machine.step(state, cls):
                value = total + factor * w + gain
                if value > nxt.get(to, -math.inf):
                    nxt[to] = value
        at = nxt
        if not at:
            return 0.0
    return max([0.0, *(v for s, v in at.items() if s in machine.final)])


@dataclass
class Model:
    """Insult weights and the calibration of a text's evidence."""

    insults: dict[str, float]
    slope: float = 1.5
    intercept: float = -4.0

    def reader(self) -> Reader:
        return Reader(self)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.intercept, -35, 35)))


class Reader:
    """Finds the clauses that hold a trigger word and runs the machines on them."""

    def __init__(self, model: Model):
        self.cls = {w: c for c, ws in CLASSES.items() for w in ws.split()}
        self.cls |= {q: "quote" for q in '"„“”«»'}
        self.weight = {w: x for w, x in model.insults.items() if w[-1] != "*"}
        self.stems = {w[:-1]: x for w, x in model.insults.items() if w[-1] == "*"}
        self.lengths = sorted({len(w) for w in self.stems}, reverse=True)
        self.machines = grammar()
        self.triggers = ahocorasick.Automaton()
        whole = {*self.weight, *CLASSES["threat"].split()}
        for w in {*whole, *self.stems}:
            self.triggers.add_word(w, (len(w), w not in self.stems))
        self.triggers.make_automaton()

    def insult(self, word: str) -> float:
        """What a word weighs: as itself or by its longest stem."""
        if (x := self.weight.get(word)) is not None:
            return x
        return next((x for n in self.lengths if (x := self.stems.get(word[:n])) is not None and len(word) >= n), 0.0)

    def clause(self, words: list[str]) -> float:
        weights = [self.insult(w) for w in words]
        classes = ["insult" if x else self.cls.get(w, "*") for w, x in zip(words, weights)]
        if "insult" not in classes and "threat" not in classes:
            return 0.0
        return max(best_path(m, classes, weights) for m in self.machines)

    def cuts(self, low: str, start: int, end: int) -> Iterator[re.Match]:
        """The ends of clauses; a colon after a report verb is none."""
        for cut in _CUT.finditer(low, start, end):
            if cut[0] == ":":
                word = _LAST.search(low[max(0, cut.start() - 20) : cut.start()])
                if word and self.cls.get(word[0].rstrip()) == "report":
                    continue
            yield cut

    def matches(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, score) of the clauses that score above 0; places are
        those of the lower-cased text."""
        if not text or not len(self.triggers):
            return []
        low = text.lower()
        found, done = [], 0
        read, quoted = 0, False
        for last, (n, whole) in self.triggers.iter(low):
            first = last - n + 1
            if first < done or (first and low[first - 1].isalpha()) or (whole and last + 1 < len(low) and low[last + 1].isalpha()):
                continue
            start = done
            for cut in self.cuts(low, done, first):
                start = cut.end()
            end = cut.start() if (cut := next(self.cuts(low, last + 1, len(low)), None)) else len(low)
            for mark in _QUOTE.finditer(low, read, start):
                quoted = not quoted and mark[0] != "\n"
            read = max(read, start)
            score = self.clause(['"'] * quoted + _TOKEN.findall(low, start, end))
            if score > 0:
                found.append((start, end, score))
            done = end
        return found

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        return np.array([sum(s for _, _, s in self.matches(t)) for t in texts])


def forms(text: str) -> set[str]:
    """The words of a text and their stems, written with a ``*``."""
    out = set(_TOKEN.findall(text.lower()))
    out |= {w[:n] + "*" for w in out for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}
    return out


def learn_insults(rows: list[tuple[int, str]]) -> dict[str, float]:
    """Words and stems that cover toxic texts and next to no other ones: greedily
    the form in most of the toxic texts not yet covered, less ``COST`` times what
    is expected of it by its share of clean texts."""
    of = {y: [t for l, t in rows if l == y] for y in (0, 1)}
    least = max(3, len(of[1]) // 500)
    hits: Counter = Counter()
    for t in of[1]:
        hits.update(forms(t))
    useful = {w for w, c in hits.items() if c >= least and len(w) > 2}
    del hits
    toxic = [forms(t) & useful for t in of[1]]
    clean: Counter = Counter()
    for t in of[0]:
        clean.update(forms(t) & useful)
    n_clean = len(of[0])
    chosen: dict[str, float] = {}
    hits = Counter(w for s in toxic for w in s)
    total = dict(hits)
    open_ = toxic
    while open_:
        share = COST * len(open_) / max(n_clean, 1)
        # of equal ones the longest form, and a word rather than its stem
        best, gain = None, (least - 0.5, 0, "")
        for w, c in hits.items():
            if c >= least and (g := (c - share * clean.get(w, 0), len(w) - 1.5 * (w[-1] == "*"), w)) > gain:
                best, gain = w, g
        if best is None:
            break
        odds = math.log((total[best] + 0.5) / (len(toxic) + 1)) - math.log((clean.get(best, 0) + 0.5) / (n_clean + 1))
        chosen[best] = min(6.0, max(1.0, odds))
        for s in open_:
            if best in s:
                hits.subtract(s)
        open_ = [s for s in open_ if best not in s]
    return chosen


def fit(rows: list[tuple[int, str]], share: float | None) -> Model:
    """Insults and the calibration, which has two numbers, from all rows.
    share: of all labels, how many are 1 (the sample is balanced)."""
    model = Model({**SEEDS, **learn_insults(rows)})
    y = np.array([l for l, _ in rows])
    if len(y) and 0 < y.sum() < len(y):
        model.slope, model.intercept = platt(np.log1p(model.reader().evidence([t for _, t in rows])), y)
        if share and 0 < share < 1:
            model.intercept += math.log(share / (1 - share)) - math.log(y.sum() / (len(y) - y.sum()))
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> Model:
    rows = labelled_sample(docs, labels, "toxic", learn, sample_docs, SAMPLE_BYTES, "toxicity")
    share = labels.filter(learn & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    return fit(rows, float(share) if share is not None else None)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_clauses), one row per row of docs; n_clauses counts
    the clauses that score above 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = m.reader()
        for batch in batches:
            found = [reader.matches(t) for t in batch.column(1).to_pylist()]
            scores = m.probability(np.array([sum(s for _, _, s in f) for f in found], dtype=float))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([len(f) for f in found], pa.int64())], names=["doc_id", "score", "n_clauses"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, n_clauses bigint")


def training_rows(doc_id: Column) -> Column:
    return crc_mod(doc_id, 4) != 2


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score_toxicity(docs, train(docs, labels, training_rows(F.col("doc_id"))))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_clauses")
