"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

A text passes if no rule rejects it, so the order changes the work and never
the verdict. The order comes from a sample: each rule's mean time and its share
of rejected texts, measured where the texts are.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh, slices, with_columns

#: Texts that a rule's cost and selectivity are measured on, about.
SAMPLE_ROWS = 2_000
WINDOW = 8


class Text:
    """One text with what rules measure, computed when first asked for and kept."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        """Runs of other characters than space and \\t to \\r, as UTF-8."""
        return self.text.encode().split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: all but the six separators."""
        return len(self.text) - sum(map(self.text.count, " \t\n\x0b\x0c\r"))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, "#*$%&|<>"))

    @cached_property
    def lines(self) -> list[str]:
        """Lines with a word."""
        return [x for x in self.text.split("\n") if x and not _BLANK.fullmatch(x)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def ids(self) -> np.ndarray:
        """A number for each word, equal words alike."""
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, self.n_words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of 8 words that occur at least twice.

        Windows are compared exactly: numbers of equal windows of 1, 2, 4 and
        then 8 words are paired, so no hash decides.
        """
        ids = self.ids
        if len(ids) <= WINDOW:
            return 0
        size = 1
        while size < WINDOW:
            ids = np.unique(ids[:-size] * (len(ids) + 1) + ids[size:], return_inverse=True)[1]
            size *= 2
        again = np.bincount(ids)[ids] > 1
        if not again.any():
            return 0
        edges = np.zeros(self.n_words + 1, np.int64)
        edges[: len(again)] += again
        edges[WINDOW:] -= again
        return int((np.cumsum(edges) > 0).sum())

    @cached_property
    def upper_share(self) -> float:
        """Upper-case letters among those that have a case."""
        upper = sum(map(str.isupper, self.text))
        return upper / max(1, upper + sum(map(str.islower, self.text)))

    @cached_property
    def stutter_share(self) -> float:
        """Words equal to the word before."""
        return float((self.ids[1:] == self.ids[:-1]).sum()) / max(1, self.n_words)

    @cached_property
    def alpha_share(self) -> float:
        """Letters among the characters of words."""
        return len(_LETTER.findall(self.text)) / max(1, self.word_chars)


_BLANK = re.compile(r"[ \t-\r]*")
_LETTER = re.compile(r"[^\W\d_]")


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


# Fixed values of the contract: too few words, too many words in repeated windows.
BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
)
#: The method's own rules; limits stand well away from prose in any case and language.
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda t: 5 * t.n_symbols > t.n_words),
    Rule("exclamations", lambda t: 3 * t.text.count("!") > t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("stutter", lambda t: t.stutter_share > 0.3),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
    Rule("upper_case", lambda t: t.upper_share > 0.6),
    Rule("few_letters", lambda t: t.alpha_share < 0.5),
)


class Measured(NamedTuple):
    name: str
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS, seed: int = 5) -> list[Measured]:
    """Mean seconds and share of rejected texts of each rule, each run alone on a sample of about `rows` rows.

    One row for each rule comes to the driver. An empty table measures nothing.
    """
    n = docs.count()
    if not n:
        return [Measured(r.name, 0.0, 0.0) for r in rules]
    sample = docs.select(col(text)).sample(min(1.0, rows / n), seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hits, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for t in batch.column(0):
                value = t.as_py()
                seen += 1
                for i, r in enumerate(rules):
                    began = time.perf_counter()
                    hits[i] += bool(r.rejects(Text(value)))
                    spent[i] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array([r.name for r in rules]), pa.array(spent), pa.array(hits, pa.int64()), pa.array([seen] * len(rules), pa.int64())], ["name", "s", "hits", "n"])

    sums = sample.mapInArrow(run, "name string, s double, hits long, n long").groupBy("name").agg(F.sum("s"), F.sum("hits"), F.sum("n")).collect()
    got = {name: (s / max(1, k), h / max(1, k)) for name, s, h, k in sums}
    return [Measured(r.name, *got.get(r.name, (0.0, 0.0))) for r in rules]


def ordered(rules: Sequence[Rule], measured: Sequence[Measured]) -> list[Rule]:
    """Most rejection per cost first; rules that reject nothing in the sample by cost."""
    by = {m.name: m for m in measured}
    return sorted(rules, key=lambda r: (-by[r.name].gain, by[r.name].seconds, r.name))


METRICS = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,passed:boolean>"
_METRICS_ARROW = pa.struct([*((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("passed", pa.bool_())])


def judge(text: Column, rules: Sequence[Rule], metrics: bool = False) -> Column:
    """struct(the five metrics, passed); the metrics are NULL without `metrics`, so that a rejection ends the work."""
    names = [f.name for f in _METRICS_ARROW if f.name != "passed"]

    @F.arrow_udf(METRICS)
    def cascade(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts):
            for t in map(Text, part.to_pylist()):
                row = {n: getattr(t, n) for n in names} if metrics else {}
                out.append(row | {"passed": not any(r.rejects(t) for r in rules)})
        return pa.array(out, _METRICS_ARROW)

    return cascade(text)


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", metrics: bool = False, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add `kept`, and with `metrics` the five measures of every whole text; no row is dropped, no shuffle.

    NULL and empty texts have no words and fail the word count. Repeated rows
    are judged alike. Input columns named like new ones are replaced.
    """
    order = ordered(rules, measure(docs, rules, text, sample_rows))
    (name,) = fresh(docs, "__quality")
    judged = docs.withColumn(name, judge(col(text), order, metrics))
    shown = [f.name for f in _METRICS_ARROW if f.name != "passed"] if metrics else []
    return with_columns(judged, {n: F.col(f"{name}.{n}") for n in shown} | {"kept": F.col(f"{name}.passed")}).drop(name)
