"""Language identification of whole, possibly mixed texts.

Each word gets a score for every learned language from character trigrams;
the scripts of its letters narrow the languages that may have it. Viterbi with
a switching penalty labels every word, and runs of one label are spans.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh, slices, with_columns

#: Training texts for each language at most, about: those with the least hash.
TRAIN_ROWS = 1_500
#: Trigrams kept for each language, the most frequent.
TRAIN_GRAMS = 50_000
#: Nats that a change of language costs.
SWITCH = 8.0
#: Nats by which one word may favour one language over another at most.
WORD_CAP = 4.0
#: A script is a language's own if it has this share of its training letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: Word scores kept by one Python worker.
CACHE_WORDS = 200_000
SLICE_BYTES = 1 << 20

# First code points of Unicode script ranges, each up to the next.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0750, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"),
    (0x3040, "Hiragana"), (0x30A0, "Katakana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"),
    (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Katakana"),
    (0xFFA0, "Other"), (0x20000, "Han"), (0x30000, "Other"),
]
_STARTS = [s for s, _ in SCRIPTS]
_NOT_LATIN = chr(0x0370)
#: Letters as `str.isalpha` has them; numerals such as ² and Ⅷ are none.
_LETTERS = regex.compile(r"\p{L}+")


def script(letter: str) -> str:
    return SCRIPTS[bisect.bisect_right(_STARTS, ord(letter)) - 1][1]


def grams(word: str) -> list[str]:
    """Trigrams of a lower-cased run of letters with its edges."""
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


class Model(NamedTuple):
    """Log probabilities (one row for each gram, one column for each language) and the languages' scripts."""

    languages: tuple[str, ...]
    grams: dict[str, int]
    weights: np.ndarray
    unseen: np.ndarray
    scripts: tuple[frozenset[str], ...]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS) -> Model | None:
    """Count trigrams in about `rows` whole texts of each language.

    Rows without text or language don't count. The sample is a hash lottery of
    (key, text) with a chance for each language from its row count; counts are summed
    by Spark and the most frequent `TRAIN_GRAMS` of each language come to the
    driver. None without any labelled row.
    """
    labelled = docs.select(col(lang).cast("string").alias("lang"), col(text).alias("text"), col(key).alias("key")).dropna(subset=["lang", "text"])
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    chance = F.create_map(*(F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, rows / n))))
    lottery = F.pmod(F.xxhash64("key", "text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = labelled.where(lottery < F.element_at(chance, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter[str]] = {}
        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = sums.setdefault(language, Counter())
                for word, n in Counter(_LETTERS.findall(value.as_py().lower())).items():
                    for g in grams(word):
                        own[g] += n
                    for c in word:
                        own["script " + script(c)] += n
        rows_ = [(language, g, n) for language, own in sums.items() for g, n in own.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows_, strict=True) if rows_ else ([], [], []), (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "gram", "n"])

    totals = sample.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.startswith("gram", F.lit("script ")).desc(), F.desc("n"), "gram"))
    counts = totals.withColumn("rank", rank).where(F.col("rank") <= TRAIN_GRAMS).select("lang", "gram", "n").collect()
    return fit(sorted(sizes), [(r["lang"], r["gram"], r["n"]) for r in counts])


def fit(languages: list[str], counts: list[tuple[str, str, int]]) -> Model:
    at = {x: i for i, x in enumerate(languages)}
    scripts: list[Counter[str]] = [Counter() for _ in languages]
    table: dict[str, int] = {}
    for language, g, n in counts:
        if g.startswith("script "):
            scripts[at[language]][g[7:]] += n
        else:
            table.setdefault(g, len(table))
    values = np.zeros((len(table), len(languages)))
    for language, g, n in counts:
        if g in table:
            values[table[g], at[language]] += n
    total = values.sum(axis=0) + 0.5 * (len(table) + 1)
    own = tuple(frozenset(s for s, n in c.items() if n >= SCRIPT_SHARE * max(1, c.total())) for c in scripts)
    return Model(tuple(languages), table, np.log((values + 0.5) / total), np.log(0.5 / total), own)


class Scorer:
    """Scores of words, kept from text to text: those of the present generation and of the one before."""

    def __init__(self, model: Model):
        self.model = model
        self.table = np.concatenate([model.weights, model.unseen[None]])
        self.latin = np.array(["Latin" in s for s in model.scripts])
        self._start({})

    def _start(self, old: dict[str, int]) -> None:
        n = len(self.model.languages)
        self.old, self.numbers = old, {}
        self.old_scores, self.old_letters = getattr(self, "scores", np.zeros((0, n))), getattr(self, "letters", np.zeros(0, np.int64))
        self.scores, self.letters = np.zeros((0, n)), np.zeros(0, np.int64)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(score of each language, best 0 and least -`WORD_CAP`; number of letters) of each word.

        The trigrams' log probabilities are summed; languages that don't use a
        script of the word are out, unless that leaves none.
        """
        find, missing = self.model.grams.get, len(self.table) - 1
        places: list[int] = []
        sizes, letters = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        possible = np.broadcast_to(self.latin, (len(words), len(self.latin))).copy()
        for i, w in enumerate(words):
            low = w.lower()
            runs = [low] if low.isalpha() else _LETTERS.findall(low)
            before = len(places)
            for run in runs:
                letters[i] += len(run)
                padded = f"^{run}$"
                places += [find(padded[k : k + 3], missing) for k in range(len(run))]
            sizes[i] = len(places) - before
            if runs and max(low) >= _NOT_LATIN:
                seen = {script(c) for run in runs for c in run}
                possible[i] = [bool(seen & s) for s in self.model.scripts]
        some = np.flatnonzero(sizes)
        total = np.zeros((len(words), len(self.latin)))
        if len(some):
            starts = np.cumsum(sizes[some]) - sizes[some]
            total[some] = np.add.reduceat(self.table[places], starts, axis=0)
            possible[~possible.any(axis=1)] = True
            total[some] = np.where(possible[some], total[some], -np.inf)
            total[some] = np.maximum(total[some] - total[some].max(axis=1, keepdims=True), -WORD_CAP)
        return total, letters

    def number(self, words: set[str]) -> None:
        """Have a number, scores and letters for each of these words."""
        if len(self.numbers) > CACHE_WORDS // 2:
            self._start(self.numbers)
        missing = words - self.numbers.keys()
        again = list(missing & self.old.keys())
        new = list(missing.difference(again))
        kept = np.fromiter(map(self.old.__getitem__, again), np.int64, len(again))
        scores, letters = self.score(new)
        self.numbers.update(zip([*again, *new], range(len(self.numbers), len(self.numbers) + len(missing)), strict=True))
        self.scores = np.concatenate([self.scores, self.old_scores[kept], scores])
        self.letters = np.concatenate([self.letters, self.old_letters[kept], letters])


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word for these scores (words x languages); ties go to staying, then to the first language."""
    rows, n = scores.tolist(), scores.shape[1]
    best, back = rows[0][:], []
    for row in rows[1:]:
        top = max(best)
        jump = top - switch
        source = best.index(top)
        back.append([i if best[i] >= jump else source for i in range(n)])
        best = [max(b, jump) + s for b, s in zip(best, row, strict=True)]
    label = best.index(max(best))
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return np.array(out[::-1])


def label_words(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi labels of the words of many texts; `first` has each text's first word and the end.

    A text whose best single language can't be beaten needs no table: any other
    path has a run of words elsewhere, which must gain more than the one switch
    it costs at least, so no run of words may gain more than `switch`.
    """
    n = np.diff(first)
    labels = np.zeros(len(scores), np.int64)
    some = np.flatnonzero(n)
    if not len(some):
        return labels
    starts = first[:-1][some]
    best = np.add.reduceat(scores, starts, axis=0).argmax(axis=1)
    doc = np.repeat(np.arange(len(some)), n[some])
    labels[:] = best[doc]
    own = scores[np.arange(len(scores)), labels]
    others = scores.copy()
    others[np.arange(len(scores)), labels] = -np.inf
    gain = others.max(axis=1) - own if scores.shape[1] > 1 else np.full(len(scores), -1.0)
    run = np.cumsum(gain)
    # Running minimum before each word, inside its text: each text is moved far below the one before it.
    before = run - gain - doc * 4.0 * (np.abs(gain).sum() + 1)
    most = run - doc * 4.0 * (np.abs(gain).sum() + 1) - np.minimum.accumulate(before)
    for d in np.flatnonzero(np.maximum.reduceat(most, starts) > switch - 1e-6):
        a, b = starts[d], starts[d] + n[some][d]
        labels[a:b] = viterbi(scores[a:b], switch)
    return labels


class Result(NamedTuple):
    lang: str
    score: float
    spans: list[tuple[int, int, str]]


def identify(texts: list[str | None], scorer: Scorer, switch: float = SWITCH, spans: bool = False) -> list[Result]:
    languages = scorer.model.languages
    words = [(t or "").split() for t in texts]
    scorer.number(set().union(*words))
    first = np.cumsum([0, *map(len, words)])
    numbers = np.fromiter(map(scorer.numbers.__getitem__, chain.from_iterable(words)), np.int64, first[-1])
    scores, letters = scorer.scores[numbers], scorer.letters[numbers]
    labels = label_words(scores, first, switch)
    out = []
    for t, a, b in zip(texts, first[:-1], first[1:], strict=True):
        total = int(letters[a:b].sum())
        if not total:
            out.append(Result(UNKNOWN, 0.0, []))
            continue
        share = np.bincount(labels[a:b], weights=letters[a:b], minlength=len(languages))
        top = int(share.argmax())
        own = labels[a:b] == top
        sums = scores[a:b][own].sum(axis=0)
        sure = 1.0 / np.exp(np.minimum(sums - sums[top], 50.0)).sum()
        out.append(Result(languages[top], float(share[top] / total * sure), _spans(t, labels[a:b], letters[a:b], languages) if spans else []))
    return out


_TOKEN = re.compile(r"\S+")


def _spans(text: str, labels: np.ndarray, letters: np.ndarray, languages: tuple[str, ...]) -> list[tuple[int, int, str]]:
    """(first character, end, language) of each run of words with one label; words without letters join the run before."""
    out: list[tuple[int, int, str]] = []
    for m, label, n in zip(_TOKEN.finditer(text), labels.tolist(), letters.tolist(), strict=True):
        if out and (not n or out[-1][2] == languages[label]):
            out[-1] = (out[-1][0], m.end(), out[-1][2])
        else:
            out.append((m.start(), m.end(), languages[label]))
    return out


RESULT = "struct<lang:string,score:double,spans:array<struct<start:int,end:int,lang:string>>>"
_SPAN_ARROW = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
_RESULT_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN_ARROW))])


def _predict(model: Broadcast, switch: float, spans: bool):
    @F.arrow_udf(RESULT)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model.value)  # goes with the task, so later stages have its memory
        for texts in batches:
            out = []
            for part in slices(texts, SLICE_BYTES):
                for r in identify(part.to_pylist(), scorer, switch, spans):
                    out.append({"lang": r.lang, "score": r.score, "spans": [dict(zip(("start", "end", "lang"), s, strict=True)) for s in r.spans]})
            yield pa.array(out, _RESULT_ARROW)

    return predict


def languages(docs: DataFrame, model: Model | None, text: str = "text", switch: float = SWITCH, spans: bool = True) -> DataFrame:
    """Add `lang_pred`, `lang_score` and, with `spans`, `lang_spans` (start, end, lang; characters, end exclusive).

    The language is the one with most letters in its spans (ties: the first by
    name); the score is that share times the chance of that language for those
    spans against the other learned ones. NULL, empty and letterless texts are
    `und` with score 0 and no spans; so is every text where nothing was learned
    (model None). A word in a script that no learned language uses is scored by
    trigrams alone. No row is dropped, nothing is shuffled; input columns named
    like new ones are replaced.
    """
    (name,) = fresh(docs, "__language")
    if model is None:
        result = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.array().cast("array<struct<start:int,end:int,lang:string>>").alias("spans"))
    else:
        # Else a filter on the result moves below the columns made from it, and every text is judged twice.
        result = _predict(docs.sparkSession.sparkContext.broadcast(model), switch, spans).asNondeterministic()(col(text))
    marked = docs.withColumn(name, result)
    new: dict[str, Column] = {"lang_pred": F.col(f"{name}.lang"), "lang_score": F.col(f"{name}.score")}
    if spans:
        new["lang_spans"] = F.col(f"{name}.spans")
    return with_columns(marked, new).drop(name)
