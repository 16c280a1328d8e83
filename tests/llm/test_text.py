"""Secrets, benchmark windows, quality rules, languages: brute force, edge cases, held-out accuracy."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate as D
from tallyloom.llm import language_id as L
from tallyloom.llm import quality_cascade as Q
from tallyloom.llm import secrets as S
from tallyloom.llm.common import table


def has_all(out, docs, *new):
    """The new columns are there once, the others stayed, no row went."""
    names = [c.lower() for c in out.columns]
    assert all(names.count(n) == 1 for n in new)
    assert {c.lower() for c in docs.columns} <= set(names)
    return out.count() == docs.count()


# Secrets


def brute_base(t):
    found = [(m.start(), 0, m.end()) for m in S.ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [S.Span(S.KINDS[k], a, b) for a, k, b in sorted(found)]


def test_base_spans():
    draw = random.Random(1)
    parts = ["token", "TOKEN", "ſecret", "apikey", "api_key", "API_KEY", "password", "passwd", '"', "'", " ", " = ", ":", "=", "AKIA", "AKIA" + "Q7" * 8, "0a1b2c" * 4, "deadbeef" * 3, "x", "é", "abc123", "a.b-c/d+e=", "\n", "A1" * 9]
    for _ in range(4000):
        t = "".join(draw.choices(parts, k=draw.randint(0, 14)))
        assert S.base_spans(t) == brute_base(t), t


@pytest.fixture(scope="module")
def tagger(spark, sf_dir):
    return S.train(table(spark, sf_dir.replace("0.001", "0.01"), "documents"))


def test_runs_decode_as_whole_texts(tagger):
    assert tagger.cuts()
    draw = random.Random(2)
    parts = ["plain", "words", "and,", "more.", "été", "token", "=", "key:", '"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"', "x@y.example.com", "+1", "(555)", "12.7.0.1", "getUserName", "snake_case_name", "\n", "  ", "###", "a" * 30, "ghp16C7e42F292c6912E7710c838347Ae178B4a", "abcd-efgh-ijkl-mnop", "correct-horse-battery-staple", "dots.in.it", "x9Kd-82Lq-Pz0v-77Rt", "aB3xK9pQ", "नमस्ते", "第三十二", "~", "-", "api key"]
    kinds = [parts, parts[:4] * 12 + parts[-14:]]
    for k in range(600):
        t = " ".join(draw.choices(kinds[k % 2], k=draw.randint(0, 60)))
        whole, full = S.file_features(t), S.tokens(t)
        rows = {x.start: f for r in S.runs(t, whole=True) for x, f in zip(r.tokens, S.features(r, whole), strict=True)}
        found = list(S.runs(t))
        seen = [x for r in found for x in r.tokens]
        assert [x.start for x in seen] == sorted({x.start for x in seen}) and {x.start for x in full if not S.is_plain(x.text)} <= {x.start for x in seen}
        assert all(S.features(r, whole) == [rows[x.start] for x in r.tokens] for r in found), t
        want = {full[i].start for i, k in enumerate(tagger.decode(tagger.emissions(list(rows.values())).tolist())) if k} if full else set()
        got = {r.tokens[i].start for r in found for i, k in enumerate(tagger.decode(tagger.emissions(S.features(r, whole)).tolist())) if k}
        assert got == want, t


def test_viterbi_is_the_best_path(tagger):
    from itertools import product

    rows = S.features(S.Run(S.tokens("my key = 9f86d081884c7d659a2feaa0 and"), True, True), ["file marks 1"])
    scores = tagger.emissions(rows)

    def total(tags):
        start = S._NEVER if tags[0] == S.I else 0.0
        return start + sum(scores[i, k] for i, k in enumerate(tags)) + sum(tagger.transitions[a, b] for a, b in zip(tags, tags[1:], strict=False))

    paths = {tags: total(tags) for tags in product(range(3), repeat=len(rows))}
    assert total(tagger.decode(scores.tolist())) == pytest.approx(max(paths.values()))
    weight = {tags: math.exp(x) for tags, x in paths.items()}
    spans = [(3, 4), (2, 4), (0, 1), (3, 5)]
    want = [sum(x for tags, x in weight.items() if tags[a] == S.B and all(k == S.I for k in tags[a + 1 : b]) and tags[b : b + 1] != (S.I,)) for a, b in spans]
    assert tagger.chances(scores.tolist(), spans) == pytest.approx([x / sum(weight.values()) for x in want])


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    idx, tag = rng.integers(0, 6, (3, 4, 2)), rng.integers(0, 2, (3, 4))
    real = np.arange(4) < np.array([4, 2, 3])[:, None]
    w, t = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))

    def loss(w, t):
        out = 0.0
        for i in range(3):
            n = real[i].sum()
            e = w[idx[i, :n]].sum(axis=1)
            f = e[0] + np.array([0, 0, S._NEVER])
            own = f[tag[i, 0]]
            for j in range(1, n):
                own += t[tag[i, j - 1], tag[i, j]] + e[j, tag[i, j]]
                f = S._sum_exp(f[:, None] + t, 0) + e[j]
            out += S._sum_exp(f, 0) - own
        return out

    gw, gt = S._gradient(idx, tag, real, w, t)
    for g, x, at in ((gw, w, (2, 1)), (gw, w, (4, 0)), (gt, t, (0, 1)), (gt, t, (1, 1))):
        d = np.zeros_like(x)
        d[at] = 1e-5
        change = loss(w + d, t) - loss(w - d, t) if x is w else loss(w, t + d) - loss(w, t - d)
        assert g[at] == pytest.approx(change / 2e-5, abs=1e-4)


def test_tagger_finds_unannounced_secrets_and_leaves_others(tagger):
    found = S.Tagger(tagger)
    for t, want in (
        ("send 9233A8ECF7C5B09FE5949719B6B82BC439E9329B to him", ["9233A8ECF7C5B09FE5949719B6B82BC439E9329B"]),
        ("it was ghp_16C7e42F292c6912E7710c838347Ae178B4a again", ["ghp_16C7e42F292c6912E7710c838347Ae178B4a"]),
        ("then sk_live_0123456789abcdef01234567XYZ9, he said", ["sk_live_0123456789abcdef01234567XYZ9"]),
        ("we got x9Kd-82Lq-Pz0v-77Rt. And then", ["x9Kd-82Lq-Pz0v-77Rt"]),
        ("a line a1b2c3d4e5f6a7b8c9d0e1f2. And then", []),
        ("card 4068516892505468 ip 24.243.215.198 mail anna.78@mail3.example.com phone +1 (555) 555-5657", []),
        ("die Donaudampfschifffahrtsgesellschaft and some well-known-thing of 2024", []),
    ):
        base, spans = S.scan(t, found)
        assert [t[s.start : s.end] for s in spans if s.kind == S.TAGGED] == want
        assert set(base) <= set(spans)


def test_short_secrets_and_false_alarms(tagger):
    """Planted in held-out words: random letters and digits of 8 to 15 characters, and harmless things."""
    found, draw = S.Tagger(tagger), random.Random(77)
    words = "river window seven garden letter morning paper quiet stone number".split()
    around = lambda x: " ".join([*draw.choices(words, k=6), x, *draw.choices(words, k=6)])
    tagged = lambda t: [t[s.start : s.end] for s in S.scan(t, found)[1]]
    secrets = ["".join(draw.choices(S._ALPHABETS[1], k=draw.randint(8, 15))) for _ in range(500)]
    assert sum(tagged(around(x)) == [x] for x in secrets) >= 400
    w = lambda: draw.choice(words)
    harmless = [f for _ in range(60) for f in (
        f"{w()}{w().capitalize()}", f"{w()}_{w()}_{draw.randint(0, 999)}", f"{w()}-{w()}-{w()}", f"2024-0{draw.randint(1, 9)}-1{draw.randint(0, 9)}", f"v1.{draw.randint(0, 9)}.3",
        f"{w()}{draw.randint(0, 999)}@{w()}.example.com", f"10.{draw.randint(0, 99)}.0.1", f"{draw.randint(0, 10**9)}", f"https://{w()}.example.com/{w()}/{draw.randint(0, 99)}", f"{w().upper()}-{draw.randint(0, 9999)}",
    )]
    assert sum(bool(tagged(around(x))) for x in harmless) <= len(harmless) // 50


def test_few_texts_with_secrets_among_many_are_all_learned(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choices(["some", "plain", "words", "of", "no", "note"], k=8)) + f" {i}" for i in range(3000)]
    texts += [texts[0]] * 2000 + [f"a token = {draw.getrandbits(160):040x} stood here" for _ in range(2)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [bool(t) for (t,) in docs.select(S._may_match(docs["text"])).collect()] == [bool(brute_base(t)) for t in texts]
    assert S.train(docs, rows=10, windows=40) is not None


def test_secret_columns(odd_docs, no_docs, tagger):
    out = S.find_secrets(odd_docs, tagger)
    assert has_all(out, odd_docs, "base_spans", "secret_spans")
    for r in out.select("text", "base_spans", "secret_spans").collect():
        assert [S.Span(*s) for s in r["base_spans"]] == brute_base(r["text"] or "")
    assert S.find_secrets(no_docs, None).isEmpty() and S.train(no_docs) is None
    assert S.train(odd_docs.where("doc_id = 8")) is None


# Benchmark windows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_windows(text, items, window=13):
    words = WORD.findall((text or "").translate(LOW))
    hit, found = set(), set()
    for item, t in items:
        w = WORD.findall((t or "").translate(LOW))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [8 << 20, 40])
def test_windows_equal_brute_force(spark, odd_docs, block, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    draw = random.Random(5)
    pick = lambda k: " ".join(draw.choices(["a", "B", "c", "É", "é9", "d"], k=k))
    items = [(i, pick(draw.choice([0, 1, 3, 5, 12, 13, 14, 20]))) for i in range(12)] + [(3, "x y z"), (50, None), (51, "!!"), (None, "über-allem")]
    texts = [pick(draw.randint(0, 60)) for _ in range(60)]
    texts += [f"{pick(9)} -- {t}, {pick(9)}" for _, t in items if t] + [f"{t} {t}" for _, t in items if t] + [None, "", "x", "Y z x Y Z", "über allem"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = [("" if i is None else i, t) for i, t in items]
    for r in D.decontaminate(docs, bench, text="text").collect():
        n, hit, found = brute_windows(r["text"], known)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, found), r["text"]
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_windows_of_odd_rows(odd_docs, no_docs):
    items = odd_docs.select(F.col("doc_id").alias("item_id"), "text").where("doc_id IN (1, 2, 3, 5)")
    out = D.decontaminate(odd_docs, items)
    assert has_all(out, odd_docs, "n_words", "n_hit", "items", "contaminated")
    got = {r["doc_id"]: r for r in out.where("doc_id IS NOT NULL").collect()}
    assert got[2]["n_words"] == got[3]["n_words"] == got[5]["n_words"] == 0 and got[6]["n_words"] == 120_000
    assert got[1]["contaminated"] and not got[8]["contaminated"] and got[1]["items"] == ["1"]
    assert D.decontaminate(no_docs, items).isEmpty()
    assert D.decontaminate(odd_docs, items.limit(0)).where("contaminated").isEmpty()


# Quality rules


def brute_quality(t):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    w, at = word.findall(t or ""), {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    again = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if word.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again)


def test_quality_measures_equal_brute_force():
    draw = random.Random(7)
    for _ in range(600):
        t = "".join(draw.choices(["a", "b ", "é ", "\n", "\xa0", "x y z ", "# ", "a b c d e f g h ", "\t", "\x0b", "\x1f"], k=draw.randint(0, 60)))
        m = Q.Text(t)
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute_quality(t), t


def test_order_changes_no_verdict(odd_docs, no_docs):
    measured = Q.measure(odd_docs)
    order = Q.ordered(Q.RULES, measured)
    assert sorted(r.name for r in order) == sorted(r.name for r in Q.RULES)
    assert [m.gain for m in sorted(measured, key=lambda m: [r.name for r in order].index(m.name))] == sorted((m.gain for m in measured), reverse=True)
    out = Q.quality(odd_docs, metrics=True)
    assert has_all(out, odd_docs, "kept", "n_words", "n_repeat_words")
    for r in out.collect():
        assert r["kept"] == (not any(rule.rejects(Q.Text(r["text"])) for rule in Q.RULES))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_quality(r["text"])
    assert Q.quality(no_docs).isEmpty()


def test_a_rejection_ends_the_work(odd_docs):
    """The rule behind one that rejects everything never runs."""

    def explode(t):
        raise RuntimeError("ran")

    rules = [Q.Rule("all", lambda t: True), Q.Rule("never", explode)]
    got = odd_docs.select(Q.judge(F.col("text"), rules).alias("q")).collect()
    assert not any(r["q"]["passed"] for r in got)


# Languages


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir.replace("0.001", "0.01"), "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    out = L.languages(docs.where(fold == 2), L.train(docs.where(fold != 2)))
    got = out.select((F.col("lang") == F.col("lang_pred")).cast("int").alias("right"), "lang_score").agg(F.avg("right"), F.min("lang_score"), F.max("lang_score")).first()
    assert got[0] > 0.97 and 0 <= got[1] <= got[2] <= 1


@pytest.fixture(scope="module")
def model():
    texts = {
        "en": "the house and the garden with a tree which they think has this other thing that",
        "de": "das haus und der garten mit einem baum welche sie nicht durch über ich auch",
        "ru": "дом и сад с деревом который они думают что это другая вещь",
    }
    counts = []
    for lang, t in texts.items():
        grams = Counter(g for w in t.split() for g in L.grams(w))
        scripts = Counter("script " + L.script(c) for w in t.split() for c in w)
        counts += [(lang, g, 20 * n) for g, n in (grams + scripts).items()]
    return L.fit(sorted(texts), counts)


def test_spans_of_mixed_text(model):
    t = "the garden with the tree and the house which they think 12 !! das haus und der garten mit einem baum welche auch дом и сад с деревом который они думают"
    (r,) = L.identify([t], L.Scorer(model), spans=True)
    assert [x for *_, x in r.spans] == ["en", "de", "ru"]
    assert t[r.spans[1][0] : r.spans[1][1]].startswith("das haus") and r.spans[0][0] == 0 and r.spans[-1][1] == len(t)


def test_scripts_narrow_the_languages(model):
    scores, letters = L.Scorer(model).score(["этот", "that", "12", "漢字"])
    assert scores[0].tolist() == [-L.WORD_CAP, -L.WORD_CAP, 0.0] and scores[1][2] == -L.WORD_CAP
    assert letters.tolist() == [4, 4, 0, 2] and not scores[2].any()


def test_short_cut_equals_viterbi():
    rng = np.random.default_rng(0)
    for _ in range(300):
        first = np.cumsum([0, *rng.integers(0, 30, 6)])
        scores = -4 * rng.random((first[-1], 3)) * (rng.random((first[-1], 3)) < 0.5)
        labels = L.label_words(scores, first, 3.0)
        for a, b in zip(first[:-1], first[1:], strict=True):
            own = scores[a:b]
            total = lambda p, own=own: own[np.arange(len(p)), p].sum() - 3.0 * (np.diff(p) != 0).sum()
            if b > a:
                assert total(labels[a:b]) == pytest.approx(total(L.viterbi(own, 3.0)))


def test_language_columns(odd_docs, no_docs):
    model = L.train(odd_docs)
    assert model.languages == ("en", "fr")
    out = L.languages(odd_docs, model)
    assert has_all(out, odd_docs, "lang_pred", "lang_score", "lang_spans")
    for r in out.collect():
        if r["text"] is None or not any(map(str.isalpha, r["text"])):
            assert (r["lang_pred"], r["lang_score"], r["lang_spans"]) == ("und", 0.0, [])
        else:
            assert r["lang_pred"] in model.languages and 0 < r["lang_score"] <= 1
    assert L.train(no_docs) is None and L.languages(no_docs, model).isEmpty()
    assert {r["lang_pred"] for r in L.languages(odd_docs, None).collect()} == {"und"}


def test_long_arrays_are_cut_whole():
    from tallyloom.llm.common import slices

    texts = pa.array(["a" * 10, None, "b" * 90, "", "c" * 5] * 4)
    parts = list(slices(texts, 100))
    assert pa.concat_arrays(parts).equals(texts) and len(parts) > 3


def test_numerals_are_no_letters():
    text = "²½① Ⅷ ٣ 12"
    assert not any(map(str.isalpha, text)) and L._LETTERS.findall(text) == []
    assert L._LETTERS.findall("Éa ñ中x1y") == ["Éa", "ñ中x", "y"]
