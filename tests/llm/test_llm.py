"""Operators of stationday.llm against plain versions and held-out labels."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from stationday.llm import decontaminate, katz, language, mixing, ngram_join, pii, quality, repetition, token_counts, toxicity
from stationday.llm import words as W

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, n string, cid string, copies string"

RNG = random.Random(5)
VOCAB = ["the", "of", "Äpfel", "on", "tion", "er", "Lorem", "x1", "ü", "and", "in", "que", "é"]


def sentence(n: int) -> str:
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def edited(text: str, n: int) -> str:
    w = text.split()
    for _ in range(n):
        w[RNG.randrange(len(w))] = RNG.choice(VOCAB) + "z"
    return " ".join(w)


def odd_rows() -> list[tuple]:
    """NULLs, empty and white texts, short and long ones, copies, near copies,
    repeated ids and rows, a hot source."""
    long = sentence(60) + " " + " ".join(f"w{i}" for i in range(120))
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, " \t\n\x0b\x0c\r ", None, "a"), (4, "one", "de", "b"), (5, "one", "de", "b"), (6, "one two", None, "c")]
    rows += [(None, sentence(30), "en", "a"), (None, None, None, None), (7, "ONE Two", "en", "c"), (7, "one two", "en", "c"), (7, "one two", "en", "c")]
    rows += [(10 + i, long, "en", "hot") for i in range(6)]
    rows += [(20 + i, edited(long, 1), "en", "hot") for i in range(12)]
    rows += [(40 + i, edited(long, 3 + i), "de", "hot") for i in range(8)]
    small = " ".join(f"s{i}" for i in range(14))
    rows += [(60, small, "en", "b"), (61, small + " t", "en", "b"), (62, small + " t u", "en", "b"), (63, small.replace("s13", "q"), "en", "b"), (64, small.lower().upper(), "en", "b")]
    mid = " ".join(f"m{i}" for i in range(25))
    rows += [(70 + i, " ".join((mid + f" e{i}").split()[i % 3 :]), "en", "b") for i in range(6)]
    rows += [(100 + i, sentence(RNG.randrange(1, 200)), RNG.choice(["en", "de", None]), RNG.choice(["a", "b", "c", None, "hot"])) for i in range(60)]
    rows += [(200, "z " * 3000, "en", "a"), (201, "q" * 20000, "en", "a"), (202, "mail a@b.co_x@y.com.. 1.2.3.4.5 +1 (437) 555-0689 " * 40, "en", "a")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, lang, s, len(t or ""), 0.5, "x", "y", "z", "c") for i, t, lang, s in rows], SCHEMA).repartition(5)
    return rows, df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def same(a: list[tuple], b: list[tuple]) -> None:
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(a, key=key) == sorted(b, key=key)


# --- words ----------------------------------------------------------------------


def test_words_and_shingles_match_plain_ones():
    texts = [t for _, t, *_ in odd_rows()]
    w = W.words(pa.array(texts, pa.string()))
    plain = [brute.words(t) for t in texts]
    assert w.counts.tolist() == [len(x) for x in plain]
    flat = [x for p in plain for x in p]
    assert (w.hash == W.hash_words(flat)).all()
    assert len(set(w.hash.tolist())) == len(set(flat))
    for k in (1, 2, 3, 5):
        h, doc, _ = W.shingles(w, k)
        h, doc = W.distinct_per_text(h, doc)
        assert np.bincount(doc, minlength=len(texts)).tolist() == [len(brute.shingle_set(t, k)) for t in texts]


def test_row_slices_cover_all_rows_once():
    texts = pa.array(["a" * n for n in (0, 5, 100, 3, 3, 0, 50)])
    parts = list(W.row_slices(texts, 10))
    assert [r for lo, hi in parts for r in range(lo, hi)] == list(range(7))


# --- 1: personal data -----------------------------------------------------------


def expected_spans(text):
    found = brute.spans(text)
    digest = ",".join(f"{pii.BASE[k]}:{s}:{e}" for s, k, e in found)
    return (*(sum(k == x for _, k, _ in found) for x in range(4)), hashlib.sha256(digest.encode()).hexdigest()), found


def pii_rows():
    tricky = [
        "a@b.c", "a@b", "x a@b.co_x@y.com", "@a.b a..b@c-d.e.f.", "a@b..c", "ü@b.c é1.2.3.4ö", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.1.1", "1.2.3", "+1.192.168.1.10",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "4111 1111  1111 1111", "+4111111111111111", "12345678901234567890123", "+1 (437) 555-0689", "+1 (437) 555-0689)", "++1 234 567 8901", "+1", "+ 1", "+12 ",
        "😀 a@b.cd 😀 +12345678901 4111111111111111", "7" * 5000, "a" * 30000 + "@b.c", "%" * 30000, "1.1.1." * 3000, "+" * 3000, "+1" * 3000, "4 " * 5000, "a@b.cd " * 1500,
    ]
    return [(i, t) for i, t in enumerate(tricky)]


def test_pii_matches_plain_spans(spark, odd):
    rows, df = odd
    extra = pii_rows()
    df = df.select("doc_id", "text").union(spark.createDataFrame([(1000 + i, t) for i, t in extra], "doc_id bigint, text string"))
    found = pii.detect(df)
    got = [tuple(r)[:6] for r in pii.spans(found, pii.train(found)).collect()]
    want = [(i, *expected_spans(t)[0]) for i, t, *_ in rows] + [(1000 + i, *expected_spans(t)[0]) for i, t in extra]
    same(got, want)


def test_pii_on_documents_and_redaction(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    found = pii.detect(docs)
    trees = pii.train(found)
    assert trees.trees
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    all_spans = {}
    for r in pii.spans(found, trees).collect():
        assert tuple(r)[1:6] == expected_spans(texts[r["doc_id"]])[0]
        base = {f"{pii.BASE[k]}:{s}:{e}" for s, k, e in brute.spans(texts[r["doc_id"]])}
        all_spans[r["doc_id"]] = set(r["spans"].split(",")) if r["spans"] else set()
        assert base <= all_spans[r["doc_id"]]
    assert any(x.startswith("secret") for s in all_spans.values() for x in s)
    for r in pii.redact(docs, trees).collect():
        assert not brute.spans(r["text"])
        assert (r["text"] == texts[r["doc_id"]]) == (not all_spans[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])


MORE = [
    "call 212-555-0187 or (415) 555.2671, not 112-555-0187 or 212-055-0187 or 1212-555-0187 or 212-555-01871", "ssn 123-45-6789; 000-12-3456 666-12-3456 923-45-6789 123-00-6789 123-45-0000 123-45-6789-1",
    "iban GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, wrong GB82 WEST 1234 5698 7654 33 xDE89370400440532013000", "password: hunter2hunter2aB token=abcabcabcabc api_key = 'A1b2C3d4E5f6G7' xtoken=A1b2C3d4E5f6G7",
    "write to jo.doe [at] example [dot] org or jo(at)example.org, not jo [at] example", "", "nothing here 12 34",
]


@pytest.mark.parametrize("n", [1, 40])
def test_pii_checked_spans_of_all_kinds_are_always_chosen(spark, n):
    """Also where there is nothing to learn from, and in the redacted text."""
    rows = [(i, t) for i, t in enumerate(MORE * n)]
    df = spark.createDataFrame([(i, t, "t", 1, ["h"]) for i, t in rows], "doc_id bigint, text string, _text string, _digit int, _hits array<string>").repartition(3)
    found = pii.detect(df)
    trees = pii.train(found)
    for r in pii.spans(found, trees).collect():
        text = rows[r["doc_id"]][1]
        want = {f"{k}:{s}:{e}" for k, s, e in brute.more_spans(text)} | {f"{pii.BASE[k]}:{s}:{e}" for s, k, e in brute.spans(text)}
        got = set(r["spans"].split(",")) - {""}
        assert want <= got
        if n == 1 or trees.least is None:
            assert got == want
        else:  # more only where a check is a rule of thumb
            assert all(x.split(":")[0] in pii.WEAK for x in got - want)
    clean = {r["doc_id"]: r for r in pii.redact(df, trees).collect()}
    for i, text in rows:
        assert not brute.spans(clean[i]["text"]) and not [x for x in brute.more_spans(clean[i]["text"]) if x[0] == "account"]
        assert (clean[i]["_text"], clean[i]["_digit"], clean[i]["_hits"]) == ("t", 1, ["h"])


def test_pii_trees_learn_from_proven_kinds_only(spark):
    """Numbers after a cue pass Luhn, others do not: the trees find the cue, and
    with it identity numbers that fail their rule."""
    card = lambda i: f"{4000000000000000 + i * 10}"
    luhn = lambda d: d[:-1] + str(-sum(sum(divmod(int(c) * (1 + j % 2), 10)) for j, c in enumerate(reversed(d))) % 10)
    rows = [(i, f"my card {luhn(card(i))} is" if i % 2 else f"row {luhn(card(i))[:-1]}{(int(luhn(card(i))[-1]) + 3) % 10} is") for i in range(400)]
    rows += [(1000, "social 900-12-3456 x"), (1001, "part 900-12-3456 x")]
    found = pii.detect(spark.createDataFrame(rows, "doc_id bigint, text string"))
    trees = pii.train(found)
    assert trees.trees and trees.least is not None
    spans = {r["doc_id"]: r["spans"] for r in pii.spans(found, trees).filter("doc_id >= 1000").collect()}
    assert spans[1000] == "identity:7:18" and spans[1001] == ""


def test_pii_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    found = pii.detect(docs)
    for df in (pii.candidates(docs), pii.spans(found, pii.train(found)), mixing.mix_sources(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pii_account_check(spark):
    rows = [("GB82 WEST 1234 5698 7654 32", True), ("GB82 WEST 1234 5698 7654 33", False), ("DE89370400440532013000", True)]
    df = spark.createDataFrame([(i, f"x {t} y", ) for i, (t, _) in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["ok"] for r in pii.candidates(df).select("doc_id", F.expr("filter(_candidates, c -> c.kind = 6)[0].ok").alias("ok")).collect()}
    assert [got[i] for i in range(3)] == [ok for _, ok in rows]


# --- 2, 8, 9: classifiers -------------------------------------------------------


def accuracy(spark, query, label, m, rest, least):
    docs = f"{SF01.replace('0.01', '0.1')}"
    out = query(spark, docs).join(spark.read.parquet(f"{docs}/labels.parquet"), "doc_id")
    rows = out.filter("held_out").select("predicted", F.col(label).alias("y")).collect()
    assert all((brute.crc(r["doc_id"], m) == rest) == r["held_out"] for r in out.select("doc_id", "held_out").limit(500).collect())
    assert np.mean([r["predicted"] == r["y"] for r in rows]) >= least


def test_toxicity_held_out(spark):
    accuracy(spark, toxicity.op2_toxicity, "toxic", 4, 2, 0.975)  # some labels of rows without any insult are 1


def test_quality_held_out(spark):
    accuracy(spark, quality.op8_quality, "quality", 4, 2, 0.95)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = language.op9_language_id(spark, SF01).join(docs, "doc_id").filter("held_out").select("lang", "lang_pred").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.98


def test_toxicity_grammar():
    r = toxicity.Model(dict(toxicity.SEEDS)).reader()
    score = lambda t: sum(s for _, _, s in r.matches(t))
    plain = score("some idiot came along.")
    assert score("you are such an idiot.") > plain > score("he is not an idiot") - 1
    assert score("not an idiot") < plain
    assert score('she said "an idiot" there') < plain
    assert score("we will kill you") >= toxicity.THREAT
    assert score("this will kill the process") == 0
    assert score("the idiotic trashcan idiots1 of") == score("") == score(None) == 0
    assert score("idiot. idiot") == pytest.approx(2 * score("idiot"))
    assert [(s, e) for s, e, _ in r.matches("ok. An idiot! ok")] == [(3, 12)]
    assert score("İ idiot") == pytest.approx(score("x idiot"))


def test_toxicity_threats_and_reports():
    r = toxicity.Model(dict(toxicity.SEEDS)).reader()
    score = lambda t: sum(s for _, _, s in r.matches(t))
    for t in ("we will kill you", "we are going to kill you", "I'm gonna kill you", "ich werde dich töten", "je vais te tuer", "te voy a matar", "yo te voy a matar"):
        assert score(t) >= toxicity.THREAT, t
    for t in ("this will kill the process", "yo voy a matar el tiempo", "you are going to kill the process", "we will tell you to kill the job", "I am here. To kill you"):
        assert score(t) == 0, t
    assert 0 <= score("I am not going to kill you") < toxicity.THREAT
    own = score("you idiot")
    assert score("she said: you idiot") == pytest.approx(toxicity.REPORTED * own)
    assert score("she came: you idiot") == pytest.approx(own)
    assert score('"It was late. You idiot! he cried." You idiot') == pytest.approx((1 + toxicity.REPORTED) * own)
    assert score('a 5" screen\nyou idiot') == pytest.approx(own)
    assert score("„Ach. Du idiot“. Du idiot") == pytest.approx((1 + toxicity.REPORTED) * own)
    assert len(r.matches("he said: ok: you idiot. you idiot " * 3)) == 6


def test_classifiers_on_odd_rows(spark, odd, none):
    rows, df = odd
    labels = spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(300)] + [(None, 1, 1), (1, None, None)], "doc_id bigint, quality int, toxic int")
    no_labels = spark.createDataFrame([], labels.schema)
    always = F.lit(True)
    for labels_ in (labels, no_labels):
        for out in (toxicity.score_toxicity(df, toxicity.train(df, labels_, always)), quality.score_quality(df, quality.train(df, labels_, always))):
            got = out.collect()
            assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    model = language.train(df, always)
    got = language.identify(df, model).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got} <= {"en", "de", "und"}
    assert sum(r["lang_pred"] == "und" for r in got) == sum(not any(c.isalpha() for c in t or "") for _, t, *_ in rows)
    assert set(language.accepted(df, model).columns) == set(df.columns)
    empty = language.train(none, always)
    assert [r["lang_pred"] for r in language.identify(df, empty).collect()] == ["und"] * len(rows)
    assert language.identify(none, model).count() == 0
    assert quality.score_quality(none, quality.train(none, no_labels, always)).count() == 0
    assert toxicity.score_toxicity(none, toxicity.train(none, no_labels, always)).count() == 0


def test_rare_languages_are_learned(spark, none):
    common, rare = "the house of the man", "das haus und der garten"
    rows = [(i, common, "en") for i in range(30_000)] + [(40_000 + i, rare, "de") for i in range(3)] + [(50_000 + i, "la maison et le jardin", "fr") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.train(df, F.lit(True), sample_docs=100, lang_docs=20)
    assert model.langs == ["de", "en", "fr"]
    assert model.judge([common, rare, "le jardin"])[0] == ["en", "de", "fr"]
    by = {r["lang"]: r["count"] for r in language.sampled(df, 100, 20).groupBy("lang").count().collect()}
    assert by["de"] == 3 and 5 <= by["fr"] <= 35 and 50 <= by["en"] <= 150
    assert language.sampled(df, 10**6, 20).count() == len(rows)
    assert language.sampled(none, 100, 20).count() == 0


def test_language_backoff_uses_shorter_grams():
    rows = [("de", 0, "haus", 5, 5), ("en", 0, "house", 5, 5), ("de", 4, "^hau", 5, 9), ("en", 2, "ou", 5, 9), ("de", 1, "z", 9, 9), ("en", 1, "y", 9, 9)]
    m = language.Model(rows)
    assert m.judge(["haus", "house", "haube", "loud", "z", "y", "12 3", None, "²"])[0] == ["de", "en", "de", "en", "de", "en", "und", "und", "und"]


# --- 3: mixing ------------------------------------------------------------------


def water_fill(sizes: dict, share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        target |= {s: most * sizes[s] for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def check_mix(rows, got):
    size = lambda t: len(brute.words(t))
    total = {}
    for _, t, _, s in rows:
        total[s] = total.get(s, 0) + size(t)
    target = water_fill(total)
    same([(r[0], r[1], r[2]) for r in got], [(i, size(t), total[s]) for i, t, _, s in rows])
    for r in got:
        assert r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    by = {}
    for r in got:
        by.setdefault((r["source_size"], round(r["target"], 6)), [0, 0]).__setitem__(0, by.get((r["source_size"], round(r["target"], 6)), [0, 0])[0] + r["taken"])
    for s, t in target.items():
        taken = by[total[s], round(t, 6)][0]
        largest = max([size(x) for _, x, _, z in rows if z == s], default=0)
        assert abs(taken - t) <= largest + 1e-6, s


def as_query(m):
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("r")).drop("r")


def test_mixing_targets_and_bounds(spark, odd, none):
    rows, df = odd
    got = as_query(mixing.mix_sources(df)).collect()
    check_mix(rows, got)
    assert listed(as_query(mixing.mix_sources(df.repartition(3)))) == listed(as_query(mixing.mix_sources(df)))
    assert mixing.mix_sources(none).count() == 0
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == [*df.columns, "copy_no"]
    assert mixed.count() == sum(r["taken"] // r["size"] for r in got if r["size"])


def test_mixing_of_repeated_rows(spark):
    """Rows without an id, all alike, and rows whose columns clash."""
    rows = [(None, "w " * 10, None, "hot")] * 2000 + [(5, "a b c", None, "hot")] * 7 + [(i, "w " * (1 + i % 9), None, "b") for i in range(300)]
    schema = "doc_id bigint, text string, lang string, source string, _id string, _copies int, copy_no string, _at int"
    df = spark.createDataFrame([(*r, "i", 1, "c", 2) for r in rows], schema).repartition(6)
    got = as_query(mixing.mix_sources(df)).collect()
    check_mix(rows, got)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "_id", "_copies", "_at", "copy_no"]
    assert mixed.count() == sum(r["taken"] // r["size"] for r in got if r["size"])
    words = mixed.filter("source = 'hot'").agg(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
    assert words == sum(r["taken"] for r in got if r["source_size"] == 20021)
    assert mixed.groupBy("copy_no").count().filter("copy_no > 2").count() == 0


def test_mixing_keeps_expectations(spark):
    rows = [(i, "w " * (1 + i % 7), None, "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame([(i, t, s) for i, t, _, s in rows], "doc_id bigint, text string, source string").cache()
    check_mix(rows, as_query(mixing.mix_sources(df)).collect())
    copies = np.zeros(300)
    for seed in range(8):
        for r in mixing.mix_sources(df, seed=seed).collect():
            copies[r["doc_id"]] += r["copies"] / 8
    total = {s: sum(len(t.split()) for _, t, _, z in rows if z == s) for s in "ab"}
    target = water_fill(total)
    for k, s in enumerate("ab"):
        assert abs(copies[k::2].mean() - target[s] / total[s]) < 0.06


# --- 4: n-gram join -------------------------------------------------------------


@pytest.mark.parametrize("k,percent", [(3, 90), (2, 70)])
def test_ngram_join_matches_all_pairs(odd, k, percent):
    rows, df = odd
    got = [tuple(r) for r in ngram_join.near_duplicates(df, k, percent).collect()]
    same(got, brute.near_duplicates([(i, t) for i, t, *_ in rows], k, percent))


@pytest.mark.parametrize("light", [0, 30])
def test_ngram_join_any_boundary_and_blocks(odd, light, monkeypatch):
    rows, df = odd
    monkeypatch.setattr(ngram_join, "boundary", lambda *a: light)
    monkeypatch.setattr(ngram_join, "BLOCK_COST", 9000)
    got = [tuple(r) for r in ngram_join.near_duplicates(df, 3, 90).collect()]
    same(got, brute.near_duplicates([(i, t) for i, t, *_ in rows], 3, 90))


def test_ngram_join_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same([tuple(r) for r in ngram_join.near_duplicates(docs, 5, 80).collect()], brute.near_duplicates(rows, 5, 80))


def test_lists_are_found_over_any_batches(spark):
    """Shared keys and the lists' names, however the sorted stream is cut."""
    entries = sorted((RNG.randrange(40), RNG.randrange(12)) for _ in range(150)) + [(90, 5), (90, 5), (91, 7)]
    want = set()
    for key in {k for k, _ in entries}:
        own = {c for k, c in entries if k == key}
        want |= {(c, min(own), key) for c in own} if len(own) > 1 else set()
    for size in (1, 2, 7, 1000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = [tuple(r) for r in ngram_join.shared_entries(spark.createDataFrame(entries, "key bigint, cid bigint")).collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(got) == len(set(got)) and set(got) == want


def test_two_very_long_near_copies(spark, monkeypatch):
    """200,000 words each: what is stored for them stays near their own size."""
    import os

    stored = {}
    real = ngram_join.saved

    def watched(df, name):
        out = real(df, name)
        top = out.saved_path.removeprefix("file://")
        stored[name] = max(stored.get(name, 0), sum(os.path.getsize(f"{top}/{f}") for f in os.listdir(top)))
        return out

    monkeypatch.setattr(ngram_join, "saved", watched)
    words = [f"{RNG.randrange(10**6)}x" for _ in range(200_000)]
    other = [w + "y" if i % 80 == 0 else w for i, w in enumerate(words)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, "short text")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in ngram_join.near_duplicates(df, 5, 80).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert sum(stored.values()) < 8 * len(" ".join(words)), stored


def test_one_per_group(spark, odd, none):
    rows, df = odd
    plain = brute.near_duplicates([(i, t) for i, t, *_ in rows], 5, 80)
    kept = ngram_join.one_per_group(df, 5, 80)
    assert kept.columns == df.columns
    got = kept.collect()
    key = lambda d: (d is not None, d)
    with_words = [r for r in got if brute.words(r["text"])]
    assert len(got) - len(with_words) == sum(not brute.words(t) for _, t, *_ in rows)
    # one row of each component of documents, found by links and not by name
    n = len(rows)
    sets = [brute.shingle_set(t, 5) for _, t, *_ in rows]
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    names = {}
    for i in range(n):
        if sets[i]:
            names[root[i]] = min(names.get(root[i], rows[i][0]), rows[i][0], key=key)
    same([(r["doc_id"],) for r in with_words], [(x,) for x in names.values()])
    assert len(plain) == n
    assert ngram_join.one_per_group(none, 5, 80).count() == 0
    assert ngram_join.near_duplicates(none).count() == 0


def test_components_of_a_long_chain(spark):
    n = 20
    order = list(range(n))
    RNG.shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (102, 101), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in ngram_join.components(edges).collect()}
    assert got == {i: 0 for i in range(n)} | {100: 100, 101: 100, 102: 100}


# --- 5: decontamination ---------------------------------------------------------


def plain_similarity(item, text):
    a, w = brute.words(item), brute.words(text)
    n, k = len(a), min(5, len(a))
    if not n:
        return 0.0
    bag = lambda x: [tuple(x[i : i + k]) for i in range(len(x) - k + 1)]
    weigh = lambda g: sum(len(x.encode()) for x in g)
    own = bag(a)
    best = 0.0
    for s in range(len(w) - n + 1):
        left = bag(w[s : s + n])
        got = 0
        for g in own:
            if g in left:
                left.remove(g)
                got += weigh(g)
        best = max(best, got / sum(map(weigh, own)))
    return best


def test_decontamination_matches_plain_windows(spark, odd, none, monkeypatch):
    rows, df = odd
    items = [(1, sentence(12)), (2, " ".join(f"w{i}" for i in range(20, 60))), (3, "one two"), (4, ""), (5, None), (6, "w5"), (7, " ".join(f"w{i}" for i in range(20, 60))), (None, " ".join(f"m{i}" for i in range(3, 20)))]
    broken = items[1][1].split()
    texts = [(300, "a b " + " ".join(broken) + " c"), (301, "x " + " ".join([*broken[:9], "qq", *broken[10:]])), (302, " ".join([*broken[:9], "qq", *broken[10:20], "rr", *broken[21:]])), (303, " ".join(broken[:20])), (304, " ".join(broken).upper())]
    docs = df.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id bigint, text string"))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = []
    for i, t in [(i, t) for i, t, *_ in rows] + texts:
        for j, x in items:
            s = plain_similarity(x, t)
            if s >= 0.8:
                want.append((i, j, round(s, 9)))
    assert {301, 304} <= {i for i, *_ in want}
    for part in (decontaminate.PART_BYTES, 100):
        monkeypatch.setattr(decontaminate, "PART_BYTES", part)
        got = [(r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in decontaminate.contamination(docs, bench).collect()]
        same(got, want)
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns
    bad = {(i, t) for i, t, *_ in rows if any(plain_similarity(x, t) >= 0.8 for _, x in items)}
    assert kept.count() == sum((i, t) not in bad for i, t, *_ in rows)
    no_bench = spark.createDataFrame([], bench.schema)
    assert decontaminate.contamination(docs, no_bench).count() == 0 and decontaminate.clean(df, no_bench).count() == len(rows)
    assert decontaminate.contamination(none, bench).count() == 0


def test_decontamination_of_texts_shorter_than_the_item(spark, monkeypatch):
    def whole_similarity(item, text):
        """Of the item's shingles what the whole text holds."""
        a, w = brute.words(item), brute.words(text)
        k = min(5, len(a))
        bag = lambda x: [tuple(x[i : i + k]) for i in range(len(x) - k + 1)]
        weigh = lambda g: sum(len(x.encode()) for x in g)
        left, got = bag(w), 0
        for g in bag(a):
            if g in left:
                left.remove(g)
                got += weigh(g)
        return got / sum(map(weigh, bag(a)))

    items = [(j, " ".join(f"i{j}x{i}" for i in range(n))) for j, n in enumerate([40, 40, 23, 7, 5, 3, 59, 5000])]
    items += [(8, "p q r s t " * 8), (9, items[0][1])]
    docs = [(0, None), (1, ""), (2, "z")]
    for j, t in items:
        a = t.split()
        n = len(a)
        for lo, hi in ((0, n - 1), (1, n), (0, n - 2), (2, n - 1), (0, n * 9 // 10), (n // 10, n), (0, n * 17 // 20), (0, n * 3 // 4), (0, n // 2)):
            docs.append((len(docs), " ".join(a[lo:hi]).upper()))
        docs.append((len(docs), " ".join([*a[: n // 2], "new", *a[n // 2 + 1 : n - 1]])))
    want = [(i, j, round(s, 9), 0, len(t.split())) for i, x in docs for j, t in items if len(brute.words(x)) < len(t.split()) and (s := whole_similarity(t, x)) >= decontaminate.LEAST]
    assert {j for _, j, *_ in want} >= {0, 1, 2, 6, 7, 8, 9} and len({i for i, *_ in want}) > 20
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    long = {i: len(brute.words(x)) for i, x in docs}
    for part in (decontaminate.PART_BYTES, 20_000):
        monkeypatch.setattr(decontaminate, "PART_BYTES", part)
        got = [tuple(r) for r in decontaminate.contamination(frame, bench).collect()]
        same([(i, j, round(s, 9), p, n) for i, j, s, p, n in got if long[i] < n], want)
        kept = {r["doc_id"] for r in decontaminate.clean(frame, bench).collect()}
        assert kept == {i for i, _ in docs} - {i for i, *_ in got}


def found_items(sf_dir, monkeypatch, radius):
    import pyarrow.parquet as pq

    monkeypatch.setattr(decontaminate, "RADIUS", radius)
    docs, bench = pq.read_table(f"{sf_dir}/documents.parquet"), pq.read_table(f"{sf_dir}/benchmark.parquet")
    indexes = decontaminate.build(list(zip(bench.column("item_id").to_pylist(), bench.column("text").to_pylist())))
    texts = docs.column("text").combine_chunks()
    out = set()
    for lo, hi in W.row_slices(texts):
        out |= {(lo + t, i) for t, i, _, _ in decontaminate.search(texts.slice(lo, hi - lo), indexes, decontaminate._filters(indexes))}
    return out


def test_decontamination_recall_on_documents(monkeypatch):
    """Against a radius that lets every window pass, on all given documents."""
    radius = decontaminate.RADIUS
    every, found = found_items(SF01, monkeypatch, 64), found_items(SF01, monkeypatch, radius)
    assert found <= every and len(every) > 10
    assert len(found) >= 0.9 * len(every)


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(3)
    index = decontaminate.build([(i, " ".join(f"a{rng.integers(50)}" for _ in range(12))) for i in range(30)])[0]
    prints = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    for b in range(0, 400, 2):  # near ones
        prints[b] = index.prints[b % 30] ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, size=rng.integers(0, 27), replace=False)))
    got = set(zip(*(x.tolist() for x in index.candidates(prints))))
    want = {(i, j) for i in range(400) for j in range(30) if bin(int(prints[i] ^ index.prints[j])).count("1") <= decontaminate.RADIUS}
    assert got == want and want


# --- 6: token counts ------------------------------------------------------------


def test_token_counts_match_the_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    v = token_counts.load()
    vocab = [("<unk>", 0.0)] + v.pieces + [(f"<0x{i:02X}>", 0.0) for i in range(256)]
    least = min(s for _, s in vocab)
    v = token_counts.Vocabulary(v.pieces, True, least)
    t = tokenizers.Tokenizer(tokenizers.models.Unigram(vocab, unk_id=0, byte_fallback=True))
    t.normalizer = tokenizers.normalizers.Sequence([tokenizers.normalizers.Replace(" ", "▁"), tokenizers.normalizers.Prepend("▁")])
    texts = [x for _, x, *_ in odd_rows() if x is not None and len(x) < 5000]
    texts += [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect()]
    texts += ["   a  b   ", "▁x ▁▁y", "日本語 😀😀 テスト", "a\n\nb\tc\r", "", " "]
    c = token_counts.Counter(v)
    assert [c.count(x)[0] for x in texts] == [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_ties_and_unknown():
    v = token_counts.Vocabulary([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("▁ab", -3.0), ("aaa", -3.0)], False, -3.0)
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", -3.0), *v.pieces], unk_id=0, byte_fallback=False))
    t.normalizer = tokenizers.normalizers.Sequence([tokenizers.normalizers.Replace(" ", "▁"), tokenizers.normalizers.Prepend("▁")])
    texts = ["ab", "aaab abab aaaa", "xx ab xy", "x", "ba ab", "aaaaaaa b x x"]
    c = token_counts.Counter(v)
    assert [c.count(x)[0] for x in texts] == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_token_counts_rows(odd, none):
    rows, df = odd
    got = token_counts.token_counts(df, token_counts.load()).collect()
    assert len(got) == len(rows)
    assert all((r["n_tokens"] == 0) == (r["score"] == 0) for r in got)
    assert token_counts.token_counts(none, token_counts.load()).count() == 0


# --- 7: language model ----------------------------------------------------------


@pytest.mark.parametrize("order,hot,buckets", [(2, 2.0**-16, 1_000_000), (2, 0.02, 700), (2, 0.001, 2000), (3, 0.005, 3000), (4, 0.05, 10_000), (1, 0.1, 900)])
def test_katz_matches_plain_model(spark, odd, none, monkeypatch, order, hot, buckets):
    rows, df = odd
    monkeypatch.setattr(katz, "HOT", hot)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", buckets)
    monkeypatch.setattr(katz, "CHUNK_ROWS", 17)
    got = katz.katz_scores(df, katz.training_rows(F.col("doc_id")), order=order).collect()
    train = [t for i, t, *_ in rows if brute.crc(i, 10) != 0]
    m = brute.Katz(train, katz.K, katz.discounts, order)
    n, v = m.n, len(m.words)
    want = []
    for i, t, *_ in rows:
        ts = brute.tokens(t)
        base = sum(np.log10((m.uni.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in ts)
        want.append((i, brute.crc(i, 10) == 0, len(ts), sum(m.uni.get(w, 0) > 0 for w in ts), n, round(float(base), 5), round(m.score(t), 5)))
    same([(*tuple(r)[:5], round(r["base_score"], 5), round(r["score"], 5)) for r in got], want)
    histories = [("<s>", "the", "of")[: order - 1], ("the",) * (order - 1), ("nope", "the", "on")[: order - 1]]
    for h in histories:  # the model is a distribution
        assert sum(m.prob(h, w) for w in m.words) + m.prob(h, "never seen") == pytest.approx(1)


def test_katz_without_rows_or_training(spark, odd, none):
    _, df = odd
    assert katz.katz_scores(none, F.lit(True)).count() == 0
    assert all(r["score"] <= 0 for r in katz.katz_scores(df, F.lit(False)).collect())


def test_katz_packing():
    a = [np.array([0, 255]), np.array([70_000, 1]), np.array([2**64 - 1], np.uint64), np.array([0.5, -1.0]), np.zeros(0, np.int64), np.array([True, False])]
    for x, y in zip(a, katz.unpack(katz.pack(*a))):
        assert (x.view(np.int64) if x.dtype == np.uint64 else x).tolist() == y.tolist()


# --- 10: repetition -------------------------------------------------------------


def plain_repetition(t):
    w = brute.words(t, lower=False)
    n = len(w)

    def in_repeats(k):
        at = {}
        for i in range(n - k + 1):
            at.setdefault(tuple(w[i : i + k]), []).append(i)
        return len({j for ps in at.values() if len(ps) > 1 for i in ps for j in range(i, i + k)})

    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if brute.words(line):
            dup += line in seen
            seen.add(line)
    repeat = in_repeats(3)
    failed = n < 50 or 100 * repeat > 50 * n
    kept = not failed and 100 * in_repeats(repetition.MIN_REPEAT) <= repetition.MAX_COVERED * n and in_repeats(repetition.MAX_LONGEST + 1) == 0
    return n, sum(map(len, w)), sum((t or "").count(c) for c in repetition.SYMBOLS), dup, repeat, failed, kept, in_repeats(repetition.MIN_REPEAT)


def test_repetition_matches_plain_windows(spark, odd, none):
    rows, df = odd
    block = sentence(110)
    more = [(400, "a b\na b\n \n \na c\nä&&\r\nä&&\r\n" * 3), (401, block + " " + " ".join(f"k{i}" for i in range(300)) + " " + block), (402, " ".join(f"k{i}" for i in range(60)) + "\n" + " ".join(f"k{i}" for i in range(40)))]
    docs = df.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    got = [tuple(r)[:9] for r in repetition.repetition(docs).collect()]
    same(got, [(i, *plain_repetition(t)) for i, t in [(i, t) for i, t, *_ in rows] + more])
    assert repetition.repetition(none).count() == 0


def test_longest_repeat_of_long_texts():
    w = W.words(pa.array(["x " * 5000, " ".join(map(str, range(4000))) * 2]), lower=False)
    longest = repetition.longest_repeats(w)
    assert longest[:5000].tolist() == [4999, *range(4999, 0, -1)]


# --- pipeline -------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF001)
        after.write.parquet(path := f"file://{tmp_path}/{name.replace(' ', '_')}")
        after = spark.read.parquet(path)
        assert after.columns == docs.columns + ["copy_no"] * (name == "mixing")
        rows, kept = [r for r in before.collect()], after.collect()
        if name == "n-gram Jaccard join":
            plain = brute.near_duplicates([(r["doc_id"], r["text"]) for r in rows], 5, 80)
            assert sorted(r["doc_id"] for r in kept) == sorted({c for _, _, c, _ in plain})
        elif name == "benchmark decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
            gone = {r["doc_id"] for r in rows} - {r["doc_id"] for r in kept}
            exact = {r["doc_id"] for r in rows if any(" ".join(brute.words(x)) in " ".join(brute.words(r["text"])) for x in items)}
            assert exact <= gone
        elif name == "PII":
            assert len(kept) == len(rows) and not any(brute.spans(r["text"]) for r in kept)
        before = after
    assert before.count() > 0


def test_pipeline_on_odd_rows(spark, odd, none, tmp_path):
    import corpus_pipeline

    rows, df = odd
    for frame in (df, none):
        d = str(tmp_path / f"sf{frame is none}")
        frame.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, sentence(12)), (2, None)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
        out = corpus_pipeline.run(spark, d)
        assert out.columns == [*df.columns, "copy_no"]
        assert (out.count() == 0) == (frame is none)


def test_stages_get_small_batches_and_a_session_keeps_its_own(spark):
    import corpus_pipeline
    from stationday.llm.common import BATCH_BYTES, BATCH_SETTING, bounded_batches

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    spark.conf.unset(BATCH_SETTING)  # tests of stages leave it set
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.repeat(F.lit("some words "), 500).alias("text"))
    try:
        corpus_pipeline.language_id(spark, docs, "")
        most = docs.mapInArrow(sizes, "n bigint").agg(F.max("n")).first()[0]
        assert most < BATCH_BYTES + 100_000
        spark.conf.set(BATCH_SETTING, "1000000")
        bounded_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == "1000000"
    finally:
        spark.conf.unset(BATCH_SETTING)


def test_words_seen_in_earlier_batches_change_nothing(monkeypatch):
    model = language.Model([("de", 0, "haus", 5, 9), ("de", 0, "und", 4, 9), ("en", 0, "house", 5, 9), ("en", 2, "^h", 4, 9)])
    texts = ["haus und", None, "house", "hx 12 hy", "1", "und haus house", "hz"]
    want = model.judge(texts)
    monkeypatch.setattr(language, "CACHE_WORDS", 2)
    seen = language._Seen(model)
    got = [model.judge((x for x in part), seen) for part in (texts[:3], texts[3:4], texts[4:])]
    assert [sum((list(g[i]) for g in got), []) for i in (0, 1)] == [list(x) for x in want]
