"""Near-duplicates: signatures, exact similarity, classes against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import near_dup as N
from tallyloom.llm.words import Words


def sets(texts, k=5):
    out = []
    for t in texts:
        w = Words(pa.array([t], pa.string()))
        w = w.run(0, len(w.starts))
        out.append({w[i : i + k] for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def brute_classes(rows, threshold=0.8):
    """Least key of each connected component of (key, text)."""
    texts = sorted({t for _, t in rows if t is not None})
    own, root = sets(texts), list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            union = len(own[i] | own[j])
            if union and len(own[i] & own[j]) / union >= threshold:
                root[find(i)] = find(j)
    least = {}
    for k, t in rows:
        if t is not None:
            c = find(texts.index(t))
            least[c] = min((x for x in (least.get(c), k) if x is not None), default=None)
    return [k if t is None else least[find(texts.index(t))] for k, t in rows]


def test_agreement_estimates_the_weighted_similarity():
    rng = np.random.default_rng(4)
    a = rng.integers(1, 9, 60).astype(float)
    b = np.maximum(0, a + rng.integers(-3, 4, 60))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    names = rng.integers(0, 2**63, 60).astype(np.uint64)
    agree = []
    for salt in range(60):
        e = names + np.uint64(salt * 7919)
        two = N.signatures(2, np.repeat([0, 1], 60), np.concatenate([e, e]), np.concatenate([a, b]))
        agree.append((two[0] == two[1]).mean())
    assert np.mean(agree) == pytest.approx(want, abs=0.03)


def test_signatures_ignore_company_and_repeats():
    rng = np.random.default_rng(5)
    e = rng.integers(0, 2**63, 300).astype(np.uint64)
    alone = N.signatures(1, np.zeros(300, np.int64), e)[0]
    owner = np.concatenate([np.zeros(300, np.int64), np.full(3, 1), np.full(600, 2)])
    three = N.signatures(4, owner, np.concatenate([e, e[:3], e, e]))
    assert (three[0] == alone).all() and (three[2] == alone).all() and (three[3] == np.uint64(2**64 - 1)).all()
    assert (three[1] != np.uint64(2**64 - 1)).all()


def test_exact_similarity():
    texts = ["a b c d e f g h i j", "a b c d e f g h i k", "A, b. c d e f g h i j", "a b", "a b c", "", "!!"]
    own = sets(texts)
    for i, x in enumerate(texts):
        got = N.jaccard([x] * len(texts), texts)
        for j in range(len(texts)):
            union = len(own[i] | own[j])
            assert got[j] == pytest.approx(len(own[i] & own[j]) / union if union else 0.0)
    assert N.jaccard(["a b c d e a b c d e"], ["a b c d e"], by_count=True)[0] == pytest.approx(1 / 6)


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("bucket", [N.BUCKET_ROWS, 12])
def test_classes_equal_brute_force(spark, bucket, monkeypatch):
    """Groups of copies near the threshold, a passage in a third of all texts, exact copies, NULLs."""
    monkeypatch.setattr(N, "BUCKET_ROWS", bucket)
    draw = random.Random(9)
    rows = []
    for _ in range(6):
        base = [f"v{draw.randrange(10**9)}" for _ in range(120)]
        rows += [edited(draw, base, draw.choice([0, 0, 1, 1, 2, 3, 4, 6])) for _ in range(25)]
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [f"{passage} " + " ".join(f"u{draw.randrange(10**9)}" for _ in range(draw.choice([2, 8, 12, 60]))) for _ in range(80)]
    rows += [None, None, "", "", "!!", "one two", "one, TWO", "one two three"]
    keyed = [(None if i % 97 == 3 else i // 2 * 2 if i % 50 == 1 else i, t) for i, t in enumerate(rows)]
    docs = spark.createDataFrame(keyed, "doc_id long, text string").repartition(5)
    got = N.near_duplicates(docs)
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"] is None, r["class_id"] or 0) for r in got.collect())
    want = brute_classes(keyed)
    assert found == sorted((k is None, k or 0, c is None, c or 0) for (k, _), c in zip(keyed, want, strict=True))


def test_texts_without_words_only(spark):
    docs = spark.createDataFrame([(1, ""), (2, "!!"), (3, "!!"), (4, None), (5, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 1}
    assert sorted(r["doc_id"] for r in N.keep_one(docs).collect()) == [1, 2, 4]


def test_one_row_of_each_class_stays(odd_docs, no_docs):
    kept = N.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r["doc_id"], (r["text"] or "")[:20]) for r in kept.collect()]
    ids = [k for k, _ in rows]
    # Text 1 once, its copy with another key (NULL) differs by a word and is a near copy; 4 is a copy of 3; NULL texts stay.
    assert sorted(x for x in ids if x is not None) == [1, 1, 2, 3, 5, 6, 7, 8, 9] and ids.count(None) == 1
    assert N.keep_one(no_docs).isEmpty() and N.near_duplicates(no_docs).isEmpty()


def test_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 400)] + [(1000, 1001), (1001, 1002)], "a long, b long")
    got = dict(N.components(edges).collect())
    assert got == {i: 0 for i in range(401)} | {i: 1000 for i in (1000, 1001, 1002)}


@pytest.mark.parametrize("all_pairs", [False, True])
def test_crowded_buckets_lose_no_pair(spark, all_pairs, monkeypatch):
    """One band in common for all texts and no other: cutting by further bands would part each similar pair."""
    monkeypatch.setattr(N, "BUCKET_ROWS", 4)
    rng = np.random.default_rng(11)
    sketch = rng.integers(0, 256, (30, N.DARTS)).astype(np.uint8)
    sketch[:, : N.ROWS] = 7
    for i in range(0, 10, 2):
        sketch[i + 1] = sketch[i]
        sketch[i + 1, N.ROWS :: N.ROWS] += 1
    rows = [(i, [0, *(1000 * i + k for k in range(1, N.BANDS))], bytearray(sketch[i].tobytes())) for i in range(30)]
    known = spark.createDataFrame(rows, "node long, bands array<long>, sketch binary")
    active = spark.createDataFrame([(0, 1, i) for i in range(30)], "bucket long, used long, node long")
    labels = spark.createDataFrame([(i, 10) for i in range(10, 22)], "node long, label long")
    finer = (lambda nodes: known.select("node", "sketch").join(nodes, "node")) if all_pairs else None
    found = N._across(active, labels, known, N.THRESHOLD, finer)
    assert sorted(map(tuple, found.collect())) == [(i, i + 1) for i in range(0, 10, 2)]
