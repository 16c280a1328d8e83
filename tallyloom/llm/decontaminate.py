"""Benchmark decontamination by a prefix-filtered set join of word windows.

A benchmark item is cut into windows of `WINDOW` consecutive words (an item of
fewer words is one window of its own size), and a window is the set of its
shingles of `SHINGLE` consecutive words with their places. To contain a window,
a document must contain every one of its shingles, so one shingle is a
sufficient prefix: the rarest, by the shingle counts of the whole corpus. The
join works on these prefix tokens only; a match fixes where the window would
begin, which is checked against the document's bounds, and only then are the
window's words compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, slices, with_columns
from tallyloom.llm.words import STEP, Words, mixed

WINDOW = 13
SHINGLE = 5
#: Text of the items that one broadcast table covers; more items make more tables.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20

_FILTER_BITS = 20


class Keys:
    """Membership of hashes in a sorted table, behind a bit filter."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `hashes`, place in the table) of those that are in it."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - _FILTER_BITS)])
        place = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        same = self.keys[place] == hashes[maybe]
        return maybe[same], place[same]


class Windows:
    """The distinct windows of a block of items with their shingles."""

    def __init__(self, items: list[tuple[str, str]], window: int, shingle: int):
        words = Words(pa.array([t for _, t in items], pa.string()))
        found: dict[tuple[bytes, ...], int] = {}
        self.items: list[set[str]] = []
        self.hash: list[np.ndarray] = []
        for i, (item, _) in enumerate(items):
            a, b = int(words.first[i]), int(words.first[i + 1])
            size = min(window, b - a)
            run = words.run(a, b - a)
            for at in range(b - a - size + 1 if size else 0):
                key = run[at : at + size]
                w = found.setdefault(key, len(found))
                if w == len(self.items):
                    self.items.append(set())
                    self.hash.append(words.hash[a + at : a + at + size])
                self.items[w].add(item)
        self.words = list(found)
        self.size = np.array([len(w) for w in self.words], np.int64)
        rows = []
        for w, h in enumerate(self.hash):
            k = min(shingle, len(h))
            total = np.zeros(len(h) - k + 1, np.uint64)
            for j in range(k):
                total = total * STEP + h[j : len(h) - k + 1 + j]
            rows += [(w, offset, k, x) for offset, x in enumerate(mixed(total + np.uint64(k)))]
        self.window = np.array([r[0] for r in rows], np.int64)
        self.offset = np.array([r[1] for r in rows], np.int64)
        self.k = np.array([r[2] for r in rows], np.int64)
        self.token = np.array([r[3] for r in rows], np.uint64)

    def tokens(self) -> dict[int, Keys]:
        """All shingles, by their length in words."""
        return {int(k): Keys(self.token[self.k == k]) for k in np.unique(self.k)}

    def prefixes(self, counts: dict[int, int]) -> Prefixes:
        """Keep the rarest shingle of each window; a window with a shingle that never occurs is out."""
        often = np.array([counts.get(int(t), 0) for t in self.token], np.int64)
        order = np.lexsort((self.offset, often, self.window))
        lead = order[np.concatenate([[True], self.window[order][1:] != self.window[order][:-1]])] if len(order) else order
        return Prefixes(self, lead[often[lead] > 0])


class Prefixes:
    """The prefix tokens with what verification needs."""

    def __init__(self, windows: Windows, rows: np.ndarray):
        self.by_length: dict[int, tuple[Keys, np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in np.unique(windows.k[rows]):
            own = rows[windows.k[rows] == k]
            own = own[np.argsort(windows.token[own], kind="stable")]
            keys = Keys(windows.token[own])
            begin = np.searchsorted(windows.token[own], keys.keys)
            end = np.searchsorted(windows.token[own], keys.keys, side="right")
            self.by_length[int(k)] = keys, begin, end - begin, own
        self.window, self.offset, self.size = windows.window, windows.offset, windows.size
        self.words, self.items = windows.words, [sorted(x) for x in windows.items]
        longest = max(map(len, windows.hash), default=1)
        self.hash = np.zeros((len(windows.hash), longest), np.uint64)
        for i, h in enumerate(windows.hash):
            self.hash[i, : len(h)] = h

    def match(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window in the texts."""
        starts, windows = [], []
        for k, (keys, begin, count, own) in self.by_length.items():
            at, tokens = words.shingles(k)
            hit, place = keys.find(tokens)
            n = count[place]
            rows = own[np.repeat(begin[place] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            window = self.window[rows]
            start = np.repeat(at[hit], n) - self.offset[rows]
            # Positional and length bounds: the window must lie inside the document of its token.
            doc = words.doc[np.repeat(at[hit], n)]
            fits = (start >= words.first[doc]) & (start + self.size[window] <= words.first[doc + 1])
            start, window = start[fits], window[fits]
            for j in range(self.hash.shape[1]):
                short = self.size[window] <= j
                same = short | (words.hash[np.minimum(start + j, len(words.hash) - 1)] == self.hash[window, j])
                start, window = start[same], window[same]
            starts.append(start)
            windows.append(window)
        start = np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.int64)
        window = np.concatenate([*windows, np.zeros(0, np.int64)]).astype(np.int64)
        exact = np.fromiter((words.run(s, len(self.words[w])) == self.words[w] for s, w in zip(start, window, strict=True)), bool, len(start))
        return start[exact], window[exact]


FOUND = "struct<n_words:bigint,spans:array<int>,items:array<string>>"
_FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])


def _found(words: Words, start: np.ndarray, end: np.ndarray, doc_items: list[tuple[int, str]], before: list[dict | None]) -> list[dict]:
    """A result for each text: word count, merged hit spans as start, end, start, ... and sorted items, with earlier ones."""
    out = [{"n_words": int(x), "spans": [], "items": []} for x in np.diff(words.first)]
    items: dict[int, set[str]] = {}
    for d, item in doc_items:
        items.setdefault(d, set()).add(item)
    spans: dict[int, list[tuple[int, int]]] = {}
    if len(start):
        doc = words.doc[start]
        for d, a, b in zip(doc.tolist(), (start - words.first[doc]).tolist(), (end - words.first[doc]).tolist(), strict=True):
            spans.setdefault(d, []).append((a, b))
    for d, old in enumerate(before):
        if old and old["spans"]:
            spans.setdefault(d, []).extend(zip(old["spans"][::2], old["spans"][1::2], strict=True))
            items.setdefault(d, set()).update(old["items"])
    for d, own in spans.items():
        merged: list[int] = []
        for a, b in sorted(own):
            if merged and a <= merged[-1]:
                merged[-1] = max(merged[-1], b)
            else:
                merged += [a, b]
        out[d]["spans"] = merged
        out[d]["items"] = sorted(items[d])
    return out


def _blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of about `BLOCK_BYTES` of text, whole items always."""
    rows = items.select(F.coalesce(col(item).cast("string"), F.lit("")).alias("item"), F.coalesce(col(text), F.lit("")).alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) if n > 1 else rows
        yield sorted((r["item"], r["text"]) for r in part.collect())


def shingle_counts(docs: DataFrame, text: str, tokens: dict[int, Keys]) -> dict[int, int]:
    """How often each of these shingles occurs in all whole texts; summed in each task first."""
    shared = docs.sparkSession.sparkContext.broadcast(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        sums = {k: np.zeros(len(keys.keys), np.int64) for k, keys in held.items()}
        for batch in batches:
            for texts in slices(batch.column(0), SLICE_BYTES):
                words = Words(texts)
                for k, keys in held.items():
                    sums[k] += np.bincount(keys.find(words.shingles(k)[1])[1], minlength=len(keys.keys))
        for k, keys in held.items():
            some = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays([pa.array(keys.keys[some].view(np.int64)), pa.array(sums[k][some])], ["token", "n"])

    partial = docs.select(col(text)).mapInArrow(count, "token long, n long")
    totals = partial.groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r["token"]).view(np.uint64)): r["n"] for r in totals}


def _probe(prefixes: Broadcast):
    """The join with one block's prefix tokens, after the results of earlier blocks."""

    @F.arrow_udf(FOUND)
    def probe(texts: pa.Array, before: pa.Array) -> pa.Array:
        held, out = prefixes.value, []
        for part in slices(texts, SLICE_BYTES):
            words = Words(part)
            start, which = held.match(words)
            end = start + held.size[which]
            pairs = [(d, x) for d, w in dict.fromkeys(zip(words.doc[start].tolist(), which.tolist(), strict=True)) for x in held.items[w]]
            out += _found(words, start, end, pairs, before.slice(len(out), len(part)).to_pylist())
        return pa.array(out, _FOUND_ARROW)

    return probe


def find_benchmark(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> Column:
    """A column for `docs`: struct(n_words, spans, items).

    `spans` holds the merged word ranges covered by windows (start, end, start,
    ...; ends exclusive), `items` the sorted ids of items with a window in the
    text. Windows repeated within or across items are one window with all its
    items; items without words match nothing; rows with the same id are one item.
    NULL and empty texts have no words. Documents are read twice for each block
    of items (counting, then joining) and never shuffled; texts of any length and
    any number of copies are work in proportion to their words.
    """
    context = docs.sparkSession.sparkContext
    found = F.lit(None).cast(FOUND)
    for block in _blocks(items, item, item_text):
        windows = Windows(block, window, shingle)
        prefixes = context.broadcast(windows.prefixes(shingle_counts(docs, text, windows.tokens())))

        found = _probe(prefixes)(col(text), found)
    return found


def n_hit(found: Column) -> Column:
    """Document words inside any occurrence of a window."""
    spans = found["spans"]
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0), lambda a, x: a + x).cast("bigint")


def contaminated(n_words: Column, hit: Column) -> Column:
    """At least a word in twenty is inside a window."""
    return (hit > 0) & (20 * hit >= n_words)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **settings) -> DataFrame:
    """Add n_words, n_hit, items and contaminated; no row is dropped.

    Input columns named like new ones are replaced.
    """
    found = find_benchmark(docs, items, text, **settings)
    name = "__found"
    while name in docs.columns:
        name = "_" + name
    marked = docs.withColumn(name, found)
    hit = n_hit(F.col(name))
    words = F.col(f"{name}.n_words")
    out = with_columns(marked, {"n_words": words, "n_hit": hit, "items": F.col(f"{name}.items"), "contaminated": contaminated(words, hit)})
    return out.drop(name)
