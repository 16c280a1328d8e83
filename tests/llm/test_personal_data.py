"""The personal-data tagger against plain patterns, whole decoding and held-out windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyloom.llm import personal_data as p
from tallyloom.llm import queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _checksum(digits):
    twice = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[::-2]) + sum(n // 10 + n % 10 for n in twice)) % 10 == 0


def plain(text):
    """The contract's base spans, pattern by pattern."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [p.Span("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [p.Span("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [p.Span("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and _checksum(digits(m))]
    return out + [p.Span("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_pattern_spans_equal_the_plain_patterns():
    r = random.Random(4)
    parts = ["a", "b.c", "@", ".", "..", "-", "+", "1", "25", "255", "256", "001", "4111111111111111", "4111 1111 1111 1111", " ", "  ", "(", ")", "é", "x@y.z", "%_", "9" * 18, "+1 (509) 555-6973", "1.2.3.4", "\n"]
    for _ in range(4_000):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        base, failed = p.matches(text)
        assert p.ordered(base) == p.ordered(plain(text)), text
        assert not set(base) & set(failed)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 " * 150_000, "a.b-" * 80_000 + "@"):
        p.matches(text)


def test_gradient_equals_differences():
    net = p.Network(*(x.astype(np.float64) for x in p.fresh_network()))
    r = np.random.RandomState(0)
    chars = r.randint(1, p.CLASSES, (3, 9)).astype(np.uint8)
    chars[1, 6:] = 0
    tags = np.zeros((3, 9), int)
    tags[0, 2:5], tags[2, :3] = [1, 2, 2], [5, 6, 6]
    change = p.gradient(net, chars, tags)[1]
    for k, name in enumerate(net._fields):
        flat, got = net[k].reshape(-1), np.asarray(change[k]).reshape(-1)
        for j in r.choice(np.flatnonzero(got), 3):
            kept, sides = flat[j], []
            for step in (1e-3, -1e-3):
                flat[j] = kept + step
                sides.append(p.gradient(net, chars, tags)[0])
            flat[j] = kept
            assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(got[j], rel=2e-2, abs=2e-4), name


def test_viterbi_and_marginals_equal_all_paths():
    from itertools import product

    r = np.random.RandomState(1)
    emissions, transitions = r.randn(2, 4, p.TAGS), r.randn(p.TAGS, p.TAGS) + p._FORBIDDEN
    for e, tags, chance in zip(emissions, p.viterbi(emissions, transitions), p.marginals(emissions, transitions)[0], strict=True):
        paths = list(product(range(p.TAGS), repeat=4))
        weight = np.array([p._START[x[0]] + sum(e[i, t] for i, t in enumerate(x)) + sum(transitions[a, b] for a, b in zip(x, x[1:], strict=False)) for x in paths])
        assert tuple(tags) == paths[int(weight.argmax())]
        share = np.exp(weight - weight.max())
        share /= share.sum()
        want = np.zeros((4, p.TAGS))
        for x, s in zip(paths, share, strict=True):
            want[np.arange(4), x] += s
        np.testing.assert_allclose(chance, want, atol=1e-9)


def test_pieces_join_and_the_greatest_weight_stays():
    P = p.Piece
    assert p.reconciled([P(0, 90, 96, 0.9, True), P(0, 90, 130, 0.8, False)]) == [P(0, 90, 130, 0.9, False)]
    chain = [P(0, 90, 96, 0.9, True), P(0, 88, 144, 0.8, True), P(0, 96, 180, 0.7, False)]
    assert [(x.start, x.end) for x in p.reconciled(chain)] == [(88, 180)]
    over = [P(1, 0, 10, 0.9, False), P(2, 5, 25, 0.9, False), P(3, 24, 30, 0.9, False)]
    assert [(x.start, x.end) for x in p.reconciled(over)] == [(5, 25)]
    assert [(x.start, x.end) for x in p.reconciled([*over, P(3, 10, 24, 0.9, False)])] == [(0, 10), (10, 24), (24, 30)]
    assert p.reconciled([]) == []


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return p.train(docs.where("doc_id % 2 = 0"))


def test_held_out_texts(spark, model):
    """Spans of respelled data in the words of texts that training hasn't seen."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 2 = 1 AND text IS NOT NULL").collect()
    draw, found, planted, false, harmless = random.Random(2), 0, 0, 0, 0
    for row in rows[:400]:
        words = re.findall(r"[^\W\d_]{2,14}", row["text"])[:100] or ["a"]
        before, after = (" ".join(draw.choices(words, k=12)) for _ in "12")
        kind = draw.choice(p.KINDS)
        made = p._respelled(kind, words, draw)
        spans = p.scan([f"{before} {made} {after}"], model)[0][1]
        planted += 1
        found += any(s.start < len(before) + 1 + len(made) and len(before) + 1 < s.end for s in spans)
        other = p._harmless(words, draw)
        harmless += 1
        false += bool(p.scan([f"{before} {other} {after}"], model)[0][1])
    assert found >= 0.9 * planted, (found, planted)
    assert false <= 0.1 * harmless, (false, harmless)


def test_windows_with_marks_are_enough_and_long_spans_come_whole(model):
    """Decoding the windows of the grid that hold a mark finds what these windows hold, wherever a span lies on the grid."""
    filler = "the quick brown fox jumps over the lazy dog "
    for shift in range(0, 100, 7):
        text = filler * 3 + "x" * shift + " call 509-555-6973 or " + filler * 4
        starts, chars = p.windows(text)
        assert all(p._MARKS.search(text[s : s + p.WINDOW]) for s in starts)
        every = [s for s in range(0, len(text), p.STRIDE) if p._MARKS.search(text[s : s + p.WINDOW])]
        assert starts.tolist() == every and chars.shape == (len(every), p.WINDOW)
        spans = p.scan([text], model)[0][1]
        assert any(text[s.start : s.end].strip(" ") == "509-555-6973" for s in spans), spans
    text = filler * 200
    assert p.scan([text, "", None], model) == [([], [])] * 3


def test_batches_of_texts_do_not_matter(model):
    texts = [f"{'word ' * k} mail me at jane{k}@host.org or 10.0.0.{k} or 4111 1111 1111 1{k:03}" for k in range(60)]
    alone = [p.scan([t], model)[0] for t in texts]
    assert p.scan(texts, model) == alone


def test_odd_rows_and_none(spark, odd_docs, no_docs, model):
    out = p.find_personal_data(odd_docs.withColumn("Base_Spans", odd_docs["n_chars"]), model)
    assert out.columns == [*odd_docs.columns, "base_spans", "personal_spans"]
    got = out.select("text", "base_spans", "personal_spans").collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert [tuple(s) for s in r["base_spans"]] == p.ordered(plain(r["text"] or ""))
    assert p.find_personal_data(no_docs, model).collect() == []
    assert p.train(no_docs) is None and p.train(no_docs.select("text").union(spark.createDataFrame([("no marks",)], "text string"))) is None
    bare = p.find_personal_data(odd_docs, None).select("base_spans", "personal_spans").collect()
    assert all(r[0] == r[1] for r in bare)


def test_query_columns_equal_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.op11_personal_data(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        base = p.ordered(plain(r["text"] or ""))
        have, spelled = got[r["doc_id"]], [f"{s.kind}:{s.start}:{s.end}" for s in base]
        assert [have[f"n_{k}"] for k in p.KINDS] == [sum(s.kind == k for s in base) for k in p.KINDS]
        assert have["base_sha256"] == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert set(spelled) <= set(have["spans"].split(",")) | {""}


def test_masking_keeps_the_length(spark):
    docs = spark.createDataFrame([("é mail a@b.co now",), (None,), ("",)], "text string")
    out = p.find_personal_data(docs, None)
    got = [r[0] for r in out.select(p.masked(out["text"], out["personal_spans"])).collect()]
    assert got == ["é mail ****** now", None, ""]
