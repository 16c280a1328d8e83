"""Secret scan: a linear-chain conditional random field over tokens, beside fixed patterns.

Tokens are tagged B (a secret begins), I (it goes on) or O from their shape, the
neighbouring words and features of the whole file, and decoded by Viterbi. The
model learns from the pattern matches in a bounded sample of texts, and from
variants of them: the same and respelled secrets without the words that
announce them, and compounds of ordinary words. So it also finds secrets that
no pattern names. A tagged span of any length counts if the model is sure of it
and it doesn't lie inside a pattern match.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh, slices, with_columns, written

# Fixed values of the contract: the kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
#: The kind of spans that the tagger adds.
TAGGED = "crf"

#: Texts without a pattern match that training reads, about; windows of either sort it keeps
#: at most, and texts with a match it reads, about.
TRAIN_ROWS = 20_000
TRAIN_WINDOWS = 4_000
#: Tokens a training window has at most; longer runs are cut into several.
WINDOW_TOKENS = 64
#: Plain tokens of context on either side of a token that isn't plain.
CONTEXT = 3
#: Least chance that the model gives a tagged span, for it to count.
SURE = 0.5

_HEX_RUN = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
# What tokens don't contain; = and : are tokens of their own.
_BETWEEN = r"""\s"'`,;:=()\[\]{}<>|#$%&*!?"""
_TOKEN = re.compile(rf"[^{_BETWEEN}]+|[=:]")
# Anything but letters, other scripts' characters and a closing dot or hyphen, or words that announce a secret.
_NOTABLE = re.compile(
    rf"[0-9_+/\\@~^=:\x00-\x08\x0e-\x1b\x7f]|[.-](?=[^{_BETWEEN}])|[a-z][A-Z]|[A-Za-z]{{20}}"
    r"|[Pp]ass(?:w|code|phrase)|PASSW|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi.?[Kk]ey|[Cc]redential|[Bb]earer"
)
_LETTERS = re.compile(r"[^\W\d_]+")
_CASED = re.compile(r"[a-z][A-Z]")
_HEXISH = re.compile(r"[0-9A-F]+|[0-9a-f]+")
_CLASSES = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+")
_DATED = re.compile(r"[0-9]{1,4}([-/.:])[0-9]{1,2}(?:\1[0-9]{1,4})?\W*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """The pattern matches, leftmost and not overlapping within a kind, by start and then kind."""
    out = []
    if ":" in text or "=" in text:
        out += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [Span("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [Span("hex", *m.span()) for m in _HEX_RUN.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def _values(text: str) -> list[tuple[int, int]]:
    """The secrets themselves in the pattern matches, without what announces them."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    return out + [(s.start, s.end) for s in base_spans(text) if s.kind != "assign"]


class Token(NamedTuple):
    text: str
    start: int
    end: int


def tokens(text: str, start: int = 0, end: int | None = None) -> list[Token]:
    return [Token(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text, start, len(text) if end is None else end)]


def is_plain(token: str) -> bool:
    """A token without anything notable: its tag is O among its like (see `Model.cuts`)."""
    return _NOTABLE.search(token) is None


def shape(token: str) -> list[str]:
    """Shape features of a token."""
    n = len(token)
    if is_plain(token):
        return ["plain"]
    digits = sum(map(str.isdigit, token))
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(token).values())
    out = [
        f"length {min(n // 4, 10)}",
        f"digits {round(4 * digits / n)}",
        f"entropy {round(entropy)}",
        f"entropy {round(entropy)} length {min(n // 8, 5)}",
        f"letters {min(max(map(len, _LETTERS.findall(token)), default=0) // 2, 5)}",
    ]
    parts = _CLASSES.findall(token)
    kinds = sum((any(map(str.islower, parts)), any(map(str.isupper, parts)), digits > 0))
    inner = sum(not x.isalnum() for x in parts)
    out += [f"switches {min(len(parts) - 2 * inner, 12)} of {min(n // 4, 5)}", f"kinds {kinds} marks {min(inner, 3)}", f"kinds {kinds} entropy {round(2 * entropy)}"]
    out += [name for name, test in (("date", _DATED.fullmatch(token)), ("all digits", digits == n), ("hexadecimal", _HEXISH.fullmatch(token)), ("mixed case", _CASED.search(token)), ("dots", token.count(".") >= 2), ("at", "@" in token), ("slash", "/" in token), ("long mixed", n >= 16 and 0 < digits < n)) if test]
    return out


def word(token: str) -> str:
    """What a neighbour sees of a token: a mark, a word that announces, or its class."""
    if token in "=:":
        return token
    if is_plain(token):
        return "plain"
    low = token.lower().rstrip(".")
    return low if low.isalpha() and len(low) < 20 else "other"


def file_features(text: str) -> list[str]:
    """Features of the whole file."""
    n = max(1, len(text))
    marks = text.count("=") + text.count(":")
    symbols = sum(map(text.count, "#$%&*|<>"))
    return [f"file marks {min(marks, 3)}", f"file symbols {min(3, int(20 * symbols / n))}"]


class Run(NamedTuple):
    """Tokens in a row, and whether the text starts and ends with them; else plain tokens surround them."""

    tokens: list[Token]
    first: bool
    last: bool


def neighbours(run: Run) -> Iterator[list[str]]:
    """The features of each token's neighbours, named by their distance."""
    before, after = "" if run.first else "plain", "" if run.last else "plain"
    words = [before, before, *(word(t.text) for t in run.tokens), after]
    for i in range(len(run.tokens)):
        yield [f"-1 {words[i + 1]}", f"-2 {words[i]} {words[i + 1]}", f"+1 {words[i + 3]}"]


def features(run: Run, whole: list[str]) -> list[list[str]]:
    """Features of each token: shape first, then neighbours, then the file's."""
    out = []
    for t, near in zip(run.tokens, neighbours(run), strict=True):
        own = shape(t.text)
        out.append([*own, *near, *whole, "plain token" if own == ["plain"] else "notable token"])
    return out


# Tags and the transitions that can't be: a secret can't go on where none began.
O, B, I = 0, 1, 2
_NEVER = -1e4


class Model(NamedTuple):
    """Weights of features (rows) for O, B and I, and of transitions (from, to)."""

    features: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def score(self, row: list[str]) -> tuple[float, float, float]:
        """The scores of O, B and I by these features together."""
        known = [k for k in map(self.features.get, row) if k is not None]
        return tuple(self.weights[known].sum(axis=0).tolist())

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        return np.array([self.score(row) for row in rows])

    def decode(self, scores: list[tuple[float, float, float]]) -> list[int]:
        """The best tags by Viterbi for the scores of a run's tokens; ties go to the lower tag."""
        (oo, ob, _), (bo, bb, bi), (io, ib, ii) = self.transitions.tolist()
        o, b, i = scores[0][O], scores[0][B], scores[0][I] + _NEVER
        back = []
        for so, sb, si in scores[1:]:
            to_o, to_b, to_i = (o + oo, b + bo, i + io), (o + ob, b + bb, i + ib), (o + _NEVER, b + bi, i + ii)
            o, b, i = max(to_o), max(to_b), max(to_i)
            back.append((to_o.index(o), to_b.index(b), to_i.index(i)))
            o, b, i = o + so, b + sb, i + si
        tag = (o, b, i).index(max(o, b, i))
        out = [tag]
        for step in reversed(back):
            tag = step[tag]
            out.append(tag)
        return out[::-1]

    def chances(self, scores: list[tuple[float, float, float]], spans: list[tuple[int, int]]) -> list[float]:
        """The chance that a secret has exactly the tokens from a to b (exclusive), for each of these spans."""
        rows = np.array(scores)
        n = len(rows)
        forward, backward = np.empty((n, 3)), np.zeros((n, 3))
        forward[0] = rows[0] + np.array([0.0, 0.0, _NEVER])
        for j in range(1, n):
            forward[j] = _sum_exp(forward[j - 1][:, None] + self.transitions, 0) + rows[j]
        for j in range(n - 2, -1, -1):
            backward[j] = _sum_exp(self.transitions + rows[j + 1] + backward[j + 1], 1)
        total = _sum_exp(forward[-1], 0)
        out = []
        for a, b in spans:
            score, tag = forward[a, B], B
            for j in range(a + 1, b):
                score, tag = score + self.transitions[tag, I] + rows[j, I], I
            if b < n:
                ends = self.transitions[tag] + rows[b] + backward[b]
                score += _sum_exp(ends[[O, B]], 0)
            out.append(float(np.exp(score - total)))
        return out

    def cuts(self) -> bool:
        """True if a plain token among plain tokens is O in every best path, for any file.

        Tagging it B or I instead may gain from transitions at most four times
        their range; its scores must outweigh that. Then a text may be decoded
        in runs around its notable tokens with the same result as as a whole.
        """
        allowed = self.transitions[self.transitions > _NEVER / 2]
        gain = 2 * float(allowed.max() - allowed.min())
        own = self.emissions([["plain", "plain token", "-1 plain", "-2 plain plain", "+1 plain"]])[0]
        loss = own[O] - max(own[B], own[I])
        for kind in ("file marks", "file symbols"):
            loss += min((w[O] - max(w[B], w[I]) for f, k in self.features.items() if f.startswith(kind) for w in [self.weights[k]]), default=0.0)
        return loss > gain


def runs(text: str, whole: bool = False) -> Iterator[Run]:
    """Runs of tokens: every one that isn't plain, `CONTEXT` plain ones on either side; with `whole` all tokens as one run."""
    if whole:
        run = tokens(text)
        if run:
            yield Run(run, True, True)
        return
    run, first, done = [], True, 0
    while m := _NOTABLE.search(text, done):
        before, all_of_them = _back(text, m.start(), done)
        if run and not all_of_them:
            yield Run(run, first, False)
            run = []
        if not run:
            first = done == 0 and all_of_them
        run += before
        left = CONTEXT
        for t in _TOKEN.finditer(text, run[-1].end if before else done):
            token = Token(t[0], t.start(), t.end())
            if t.start() < m.end() or not is_plain(token.text):
                left = CONTEXT
            elif not left:
                break
            else:
                left -= 1
            run.append(token)
        done = run[-1].end
    if run:
        yield Run(run, first, _TOKEN.search(text, done) is None)


def _back(text: str, at: int, least: int) -> tuple[list[Token], bool]:
    """The last `CONTEXT` tokens that end at `at` or before, none before `least`; and whether these are all there are.

    A single token more is taken too, so two or more plain tokens stand before what isn't all.
    """
    width = 64
    while True:
        start = max(least, at - width)
        found = tokens(text, start, at)
        # The token at `at` may begin before it, and the first one before `start`.
        if found and found[-1].end == at and _TOKEN.match(text, found[-1].start).end() > at:
            found.pop()
        if start == least:
            return (found, True) if len(found) <= CONTEXT + 1 else (found[-CONTEXT:], False)
        if len(found) > CONTEXT + 2:
            return found[-CONTEXT:], False
        width *= 4


#: Shapes whose scores a tagger remembers.
REMEMBERED = 50_000


class Tagger:
    """A model with the scores of shapes and neighbours it has met; these only save time."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.whole = not model.cuts()
        self.shapes = lru_cache(REMEMBERED)(self._shape)
        self.near = lru_cache(REMEMBERED)(lambda *names: model.score(list(names)))

    def _shape(self, token: str) -> tuple[float, float, float]:
        own = shape(token)
        return self.model.score([*own, "plain token" if own == ["plain"] else "notable token"])

    def spans(self, text: str) -> list[Span]:
        """The secrets that the tags mark and that are as likely as `SURE`, without marks at their ends."""
        whole = self.near(*file_features(text))
        out = []
        for run in runs(text, self.whole):
            scores = []
            for t, near in zip(run.tokens, neighbours(run), strict=True):
                (o1, b1, i1), (o2, b2, i2), (o3, b3, i3) = self.shapes(t.text), self.near(*near), whole
                scores.append((o1 + o2 + o3, b1 + b2 + b3, i1 + i2 + i3))
            tags = self.model.decode(scores)
            if B not in tags:
                continue
            places = []
            for i, tag in enumerate(tags):
                if tag == B:
                    places.append((i, i + 1))
                elif tag == I:
                    places[-1] = (places[-1][0], i + 1)
            for (a, b), chance in zip(places, self.model.chances(scores, places), strict=True):
                start, end = run.tokens[a].start, run.tokens[b - 1].end
                while start < end and not (text[start].isalnum() or text[start] in "_+/"):
                    start += 1
                while start < end and not (text[end - 1].isalnum() or text[end - 1] in "_+/="):
                    end -= 1
                if chance >= SURE and start < end:
                    out.append(Span(TAGGED, start, end))
        return out


def scan(text: str | None, tagger: Tagger | None) -> tuple[list[Span], list[Span]]:
    """(pattern spans, all spans): those of the tagger join unless they lie inside a pattern span."""
    if not text:
        return [], []
    base = base_spans(text)
    if tagger is None:
        return base, base
    extra = [s for s in tagger.spans(text) if not any(b.start <= s.start and s.end <= b.end for b in base)]
    order = (*KINDS, TAGGED)
    return base, sorted([*base, *extra], key=lambda s: (s.start, order.index(s.kind)))


_ALPHABETS = ("0123456789ABCDEF", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-")


def _short(draw: random.Random) -> str:
    """A short random secret in which letters of both cases and digits change at least four times."""
    while True:
        value = "".join(draw.choices(_ALPHABETS[1], k=draw.randint(8, 15)))
        parts = _CLASSES.findall(value)
        if len(parts) > 4 and len({x[0].isdigit() + 2 * x[0].isupper() for x in parts}) == 3:
            return value


def _variants(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Short texts for training with the places of their secrets, made from a text with secrets; the text decides all choices."""
    draw = random.Random(zlib.crc32(text.encode()))
    words = [w for w in text.split() if is_plain(w)] or ["a"]
    for a, b in sorted(set(_values(text))):
        value = text[a:b]
        respelled = ["".join(draw.choices(x, k=draw.randint(16, 44))) for x in _ALPHABETS]
        for secret in (value, *respelled):
            before, after = " ".join(draw.choices(words, k=4)) + " ", " " + " ".join(draw.choices(words, k=4))
            yield before + secret + after, [(len(before), len(before) + len(secret))]
        # Prefixed ones, ones in groups, and short ones.
        alphabet = draw.choice(["0123456789abcdef", *_ALPHABETS])
        prefix, more = draw.choice(words)[: draw.randint(2, 4)].lower(), draw.choice(["", "", draw.choice(words)[:4].lower() + "_"])
        prefixed = prefix + draw.choice("_-") + more + "".join(draw.choices(alphabet, k=draw.randint(16, 36))) + draw.choice(["", _short(draw)[:4]])
        groups = "-".join("".join(draw.choices(_ALPHABETS[1], k=draw.randint(4, 6))) for _ in range(draw.randint(3, 5)))
        for secret in (prefixed, groups, *(_short(draw) for _ in range(3))):
            before, after = " ".join(draw.choices(words, k=4)) + " ", " " + " ".join(draw.choices(words, k=4))
            yield before + secret + after, [(len(before), len(before) + len(secret))]
        for mark in "-_/.@":
            own = mark.join(draw.choices(words, k=draw.randint(2, 4))).lower() + draw.choice(["", str(draw.randint(0, 9999)), mark + str(draw.randint(0, 99))])
            yield " ".join([*draw.choices(words, k=3), own, *draw.choices(words, k=3)]), []
        path = draw.choices([w.lower() for w in words], k=6)
        yield f"{words[0]} https://{path[0]}.{path[1]}/{path[2]}/{draw.randint(0, 9999)}/{path[3]}-{path[4]}-{path[5]} {words[-1]}", []
        yield f"{words[0]} https://{path[0]}.example.com/{path[1][0]}/{path[2]}{draw.randint(0, 9)}/{path[3].capitalize()}{draw.randint(0, 99)}?{path[4]}={draw.randint(0, 99)} {words[-1]}", []
        name, number = draw.choice(words), str(draw.randint(0, 99999))
        harmless = [str(draw.randint(10**9, 10**20)), name + number, name.upper() + "-" + number, name.capitalize() + draw.choice(words).capitalize() + number[:2], "v" + ".".join(number), number + name[:2]]
        harmless += [draw.choice(words).lower() + name.capitalize() + draw.choice(["", draw.choice(words).capitalize()]), name[0].lower() + name.capitalize() + number[:2]]
        harmless += [f"{draw.randint(1900, 2100)}-{draw.randint(1, 12):02}-{draw.randint(1, 31):02}", f"{draw.choice(words)}_{name}_{number}", f"{name}{number}@{draw.choice(words)}.example.com"]
        for own in harmless:
            yield " ".join([*draw.choices(words, k=3), own, *draw.choices(words, k=3)]), []


def _windows(text: str) -> Iterator[tuple[list[list[str]], list[int]]]:
    """Runs of a text and of its variants with their tags."""
    whole = file_features(text)
    values = _values(text)
    yield from _tagged_runs(text, values, whole)
    if values:
        for variant, places in _variants(text):
            yield from _tagged_runs(variant, places, whole)


def _tagged_runs(text: str, values: list[tuple[int, int]], whole: list[str]) -> Iterator[tuple[list[list[str]], list[int]]]:
    for run in runs(text):
        tags, last = [], None
        for t in run.tokens:
            inside = next((v for v in values if t.start < v[1] and v[0] < t.end), None)
            tags.append(O if inside is None else I if inside == last else B)
            last = inside
        found = features(run, whole)
        for i in range(0, len(tags), WINDOW_TOKENS):
            yield found[i : i + WINDOW_TOKENS], tags[i : i + WINDOW_TOKENS]


def _may_match(text: Column) -> Column:
    """True where a text may have a pattern match: each such text and few others, without Python."""
    assign = rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{{{ASSIGN_LEAST},}}"""
    return text.rlike(rf"{assign}|AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}|[0-9a-f]{{{HEX_LEAST},}}")


def train(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS, windows: int = TRAIN_WINDOWS) -> Model | None:
    """Fit on at most `windows` windows with and `windows` without a secret.

    They come from about `windows` distinct texts with a pattern match and `rows`
    without one, each a hash lottery of its own, so few such texts among very many are
    all learned and copies count once. The windows are those with the least digest:
    the model doesn't depend on partitions. None if no text has a secret.
    """
    own = docs.select(col(text).alias("text")).where(col(text).isNotNull())
    own = own.select("text", F.xxhash64("text").alias("hash"), _may_match(F.col("text")).alias("matches"))
    some, plain = own.agg(*(F.approx_count_distinct(F.when(F.col("matches") == m, F.col("hash"))) for m in (True, False))).first()
    if not some:
        return None
    chance = F.when(F.col("matches"), min(1.0, windows / some)).otherwise(min(1.0, rows / max(1, plain)))
    lottery = F.pmod("hash", F.lit(1_000_000_007)) < chance * 1_000_000_007
    sample = written(own.where(lottery).dropDuplicates(["hash"]).select("text", "matches"), "training")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                for t in part.to_pylist():
                    found = [("\t".join("\n".join(f) for f in fs), "".join(map(str, tags))) for fs, tags in _windows(t or "")]
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.string())], ["features", "tags"])

    picked = []
    for secret, texts in ((True, sample.where("matches")), (False, sample)):
        found = texts.select("text").mapInArrow(collect, "features string, tags string").distinct()
        chosen = found.where(F.contains("tags", F.lit("1")) == secret)
        picked.append(chosen.orderBy(F.md5("features"), "tags").limit(windows).collect())
    if not picked[0]:
        return None
    return fit([([f.split("\n") for f in r["features"].split("\t")], list(map(int, r["tags"]))) for r in [*picked[0], *picked[1]]])


def fit(cut: list[tuple[list[list[str]], list[int]]], epochs: int = 150, rate: float = 0.15, decay: float = 0.0005) -> Model:
    """Weights of greatest conditional likelihood with a quadratic penalty, by Adam over all windows at once."""
    names: dict[str, int] = {}
    for fs, _ in cut:
        for f in fs:
            for x in f:
                names.setdefault(x, len(names) + 1)
    longest, widest = max(len(t) for _, t in cut), max(len(f) for fs, _ in cut for f in fs)
    idx = np.zeros((len(cut), longest, widest), np.int64)
    tag = np.zeros((len(cut), longest), np.int64)
    length = np.array([len(t) for _, t in cut])
    for i, (fs, ts) in enumerate(cut):
        tag[i, : len(ts)] = ts
        for j, f in enumerate(fs):
            idx[i, j, : len(f)] = [names[x] for x in f]
    real = np.arange(longest) < length[:, None]
    w, t = np.zeros((len(names) + 1, 3)), np.zeros((3, 3))
    fixed = np.zeros((3, 3))
    fixed[O, I] = _NEVER
    state = [np.zeros_like(x) for x in (w, w, t, t)]
    for epoch in range(1, epochs + 1):
        gw, gt = _gradient(idx, tag, real, w, t + fixed)
        for k, (x, g) in enumerate(((w, gw), (t, gt))):
            g = g / len(cut) + decay * x
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
        w[0] = 0.0
        t[O, I] = 0.0
    return Model({x: k for x, k in names.items()}, w, t + fixed)


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradient(idx: np.ndarray, tag: np.ndarray, real: np.ndarray, w: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log likelihood, by the forward-backward recursions over padded windows."""
    n, longest, _ = idx.shape
    own = idx[real]
    scores = np.zeros((n, longest, 3))
    scores[real] = w[own].sum(axis=1)
    forward = np.zeros((n, longest, 3))
    backward = np.zeros((n, longest, 3))
    forward[:, 0] = scores[:, 0] + np.array([0.0, 0.0, _NEVER])
    for j in range(1, longest):
        live = np.flatnonzero(real[:, j])
        forward[:, j] = forward[:, j - 1]
        forward[live, j] = _sum_exp(forward[live, j - 1, :, None] + t, 1) + scores[live, j]
    for j in range(longest - 2, -1, -1):
        live = np.flatnonzero(real[:, j + 1])
        backward[live, j] = _sum_exp(t + (scores[live, j + 1] + backward[live, j + 1])[:, None, :], 2)
    total = np.broadcast_to(_sum_exp(forward[:, -1], 1)[:, None], real.shape)
    chance = np.exp(forward[real] + backward[real] - total[real][:, None])
    chance -= np.arange(3) == tag[real][:, None]
    gw = np.zeros_like(w)
    for k in range(3):
        gw[:, k] = np.bincount(own.ravel(), weights=np.repeat(chance[:, k], own.shape[1]), minlength=len(w))
    both = real[:, 1:]
    ahead = (scores + backward)[:, 1:][both]
    pair = np.exp(forward[:, :-1][both][:, :, None] + t + ahead[:, None, :] - total[:, 1:][both][:, None, None])
    gt = pair.sum(axis=0)
    np.subtract.at(gt, (tag[:, :-1][both], tag[:, 1:][both]), 1.0)
    return gw, gt


RESULT = "struct<base:array<struct<kind:string,start:int,end:int>>,spans:array<struct<kind:string,start:int,end:int>>>"
_SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_RESULT_ARROW = pa.struct([("base", pa.list_(_SPAN_ARROW)), ("spans", pa.list_(_SPAN_ARROW))])


def _scan_udf(model: Broadcast):
    @F.arrow_udf(RESULT)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = Tagger(model.value) if model.value else None  # goes with the task
        for texts in batches:
            out = []
            for part in slices(texts):
                for t in part.to_pylist():
                    base, spans = scan(t, tagger)
                    out.append({"base": [s._asdict() for s in base], "spans": [s._asdict() for s in spans]})
            yield pa.array(out, _RESULT_ARROW)

    return find


def find_secrets(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add `base_spans` and `secret_spans`: arrays of (kind, start, end), code points, end exclusive.

    NULL and empty texts have none; without a model both are the pattern spans.
    A tagged span inside a pattern span isn't added. No row is dropped,
    nothing is shuffled, equal rows get equal spans; input columns named like
    new ones are replaced.
    """
    (name,) = fresh(docs, "__secrets")
    found = docs.withColumn(name, _scan_udf(docs.sparkSession.sparkContext.broadcast(model))(col(text)))
    return with_columns(found, {"base_spans": F.col(f"{name}.base"), "secret_spans": F.col(f"{name}.spans")}).drop(name)


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, kind: str) -> Column:
    """How many of these spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
