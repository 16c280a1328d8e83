"""The source divergence audit against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found, has, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(AZ))
        groups[lang].add(source)
        found[lang, source].update(terms)
        has[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in has[lang].items() if n >= least]

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = share(sum((found[lang, s] for s in sources), Counter()))
        p = {s: share(found[lang, s]) for s in sources}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], whole[t])) for t in kept if found[lang, s][t] and p[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)]
    return sorted(out)


def _rows(seed=1):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("der", "The", "été", "x", "Ünd", "mot") for b in ("", "s", "en", "ß", "é", "a")]
    rows = []
    for i in range(300):
        lang, source = r.choice(["en", "en", "fr", None]), r.choice([None, "a", "b", "c", "d", "E", "é"])
        rows.append((r.choice([" ", "1", "-", "\n"]).join(r.choices(words[: 12 + i % 24], k=r.randint(0, 40))), lang, source))
    rows += [(None, "xx", "lone"), ("", "yy", "a"), ("one Two", "yy", "b"), (" ".join(["flood"] * 5_000), "en", "a"), *[rows[7]] * 40]
    rows += [("same words everywhere", "zz", s) for s in "abc" for _ in range(12)]
    return rows


@pytest.mark.parametrize(("bits", "block"), [(64, 256), (3, 256), (64, 2), (1, 3)])
def test_equals_brute_force_also_where_digests_collide(spark, bits, block):
    rows = _rows()
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "text string, lang string, source string, `Group` int").repartition(5)
    got = divergence.audit(docs, least=8, top=4, bits=bits, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 8, 4)


def test_terms_of_texts_end_with_them():
    texts = pa.array(["pad", "ab", "cd E", "", "éX", None and "", "9a9"]).fill_null("")
    found = divergence.Terms(texts.slice(1))
    got = {(int(t), found.terms[int(c)].as_py(), int(n)) for t, c, n in zip(found.text, found.code, found.count, strict=True)}
    assert got == {(0, "ab", 1), (1, "cd", 1), (1, "e", 1), (3, "éx", 1), (5, "a", 1)}


def test_sums_of_blocks_equal_dense_sums():
    r = np.random.RandomState(2)
    absent = r.randint(1, 900, 7)
    block, dense = divergence.Block(absent), np.zeros((7, 7), np.int64)
    sizes, at, p = [], [], []
    for _ in range(50):
        own = np.sort(r.choice(7, r.randint(1, 8), replace=False))
        row = absent.copy()
        row[own] = r.randint(1, 1_000_000_000, len(own))
        dense += divergence._f(row[:, None], row[None, :]) - divergence._f(absent[:, None], absent[None, :])
        sizes.append(len(own))
        at += own.tolist()
        p += row[own].tolist()
    block.add(np.array(sizes[:20]), np.array(at[: sum(sizes[:20])]), np.array(p[: sum(sizes[:20])]))
    block.add(np.array(sizes[20:]), np.array(at[sum(sizes[:20]) :]), np.array(p[sum(sizes[:20]) :]))
    assert (np.triu(block.sums(), 1) == np.triu(dense, 1)).all()


def test_odd_rows_and_none(spark, odd_docs, no_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, divergence.audit(odd_docs, least=1).collect())) == brute(rows, 1, 10)
    assert divergence.audit(no_docs).collect() == []
