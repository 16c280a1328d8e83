"""Personal data: a character-level bidirectional LSTM with CRF transitions, beside fixed patterns.

Every text is read through overlapping windows of characters. The network gives each
character a score for each tag (O, or the begin or inside of an email address, IP
address, card or phone number), Viterbi decodes each window, and the spans of all
windows of a text are reconciled: pieces cut by a window's edge are joined, and of
spans that overlap the set of greatest weight stays. It is trained in numpy from the
pattern matches of a bounded sample and from respelled ones, so it also finds forms
that the patterns leave out, such as numbers without a country code.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh, slices, with_columns, written

# Fixed values of the contract: the kinds in order and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL, _DOMAIN = re.compile(r"[A-Za-z0-9._%+-]+"), re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A run of digits that starts no match at its first digit starts none further on.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Characters of a window, and from one window's start to the next one's.
WINDOW, STRIDE = 96, 48
#: Texts with a match and texts without one that training reads, about, and windows it keeps of each sort.
TRAIN_TEXTS, TRAIN_WINDOWS = 2_000, 1_500
#: Least mean probability, over its characters, that a span isn't O.
LEAST_SCORE = 0.5
#: Numbers in the network.
EMBEDDED, HIDDEN = 10, 16
#: Windows that go through the network at once.
_BATCH = 1_024

#: What each kind has in some form: a window without one of these is O throughout.
_MARK = r"[0-9@]|[\[({] ?[Aa][Tt] ?[\])}]"
_MARKS = re.compile(_MARK)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, looked for around each @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """(pattern spans, matches that fail a kind's further test), each by kind and start."""
    base, failed = [], []

    def put(kind: str, start: int, end: int, ok: bool) -> None:
        (base if ok else failed).append(Span(kind, start, end))

    for start, end in _emails(text):
        put("email", start, end, True)
    for m in _IP.finditer(text):
        put("ip", *m.span(), all(len(p := g.lstrip("0")) < 4 and int(p or "0") <= 255 for g in m.groups()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) <= 19:
            put("card", *m.span(), len(digits) >= 16 and _luhn(digits))
        else:
            put("card", *m.span(), False)
    for m in _PHONE.finditer(text):
        put("phone", *m.span(), 8 <= len(_digits(m[0])) <= 15)
    return base, failed


# Characters and tags.

_PAD, _LETTER, _OTHER = 0, 96, 97
CLASSES = 98
_CLASS = np.full(128, _OTHER, np.uint8)
_CLASS[32:127] = np.arange(1, 96)
_CLASS[48:58] = _CLASS[48]  # digits are alike
_CLASS[[9, 10, 13]] = _CLASS[32]

O = 0
TAGS = 1 + 2 * len(KINDS)
_NEVER = np.float32(-1e4)
#: A kind can only go on where it began.
_FORBIDDEN = np.zeros((TAGS, TAGS), np.float32)
_START = np.zeros(TAGS, np.float32)
for _k in range(len(KINDS)):
    _FORBIDDEN[[t for t in range(TAGS) if t not in (1 + 2 * _k, 2 + 2 * _k)], 2 + 2 * _k] = _NEVER
    _START[2 + 2 * _k] = _NEVER


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def classes(points: np.ndarray) -> np.ndarray:
    """The class of each code point; other letters than ASCII's, and all else beyond it, are one each."""
    wide = np.where((points >= 0xC0) & (points < 0x2000) | (points >= 0x3040), _LETTER, _OTHER).astype(np.uint8)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], wide)


# The network.


class Network(NamedTuple):
    """Weights: embeddings; input, recurrent and bias of the LSTM forwards and backwards; output; transitions."""

    embedding: np.ndarray
    into: np.ndarray
    again: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    transitions: np.ndarray


def fresh_network(seed: int = 7) -> Network:
    r, e, h = np.random.RandomState(seed), EMBEDDED, HIDDEN
    bias = np.zeros((2, 1, 4 * h), np.float32)
    bias[..., h : 2 * h] = 1.0  # remember, to begin with
    normal = lambda scale, *shape: (scale * r.randn(*shape)).astype(np.float32)
    return Network(normal(0.5, CLASSES, e), normal(e**-0.5, 2, e, 4 * h), normal(h**-0.5, 2, h, 4 * h), bias, normal((2 * h) ** -0.5, 2 * h, TAGS), np.zeros(TAGS, np.float32), np.zeros((TAGS, TAGS), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _states(net: Network, chars: np.ndarray) -> tuple[np.ndarray, list]:
    """((windows, length, 2 hidden) states, what the gradient needs) of windows of classes, padded at their ends."""
    n, length = chars.shape
    h = HIDDEN
    both = np.stack([chars, chars[:, ::-1]])
    projected = np.matmul(net.embedding[None], net.into) + net.bias  # of each class
    state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    states, kept = np.zeros((2, length, n, h), np.float32), []
    for t in range(length):
        now = both[:, :, t]
        gates = np.matmul(state, net.again)
        gates[0] += projected[0, now[0]]
        gates[1] += projected[1, now[1]]
        ifo, g = _sigmoid(gates[..., : 3 * h]), np.tanh(gates[..., 3 * h :])
        real = (now != _PAD)[..., None]
        before = (state, cell)
        cell = (ifo[..., h : 2 * h] * cell + ifo[..., :h] * g) * real
        squashed = np.tanh(cell)
        state = ifo[..., 2 * h :] * squashed * real
        states[:, t] = state
        kept.append((before, ifo, g, squashed, real))
    return np.concatenate([states[0].transpose(1, 0, 2), states[1, ::-1].transpose(1, 0, 2)], axis=2), [both, kept]


def scores(net: Network, chars: np.ndarray) -> np.ndarray:
    """(windows, length, tags); padding is O."""
    out = _states(net, chars)[0] @ net.out + net.out_bias
    return _padded(out, chars)


def _padded(out: np.ndarray, chars: np.ndarray) -> np.ndarray:
    out[chars == _PAD] = _NEVER
    out[..., O][chars == _PAD] = 0.0
    return out


def marginals(emissions: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability of each tag, expected transitions, log of the sum over paths) by forward-backward, scaled at each step."""
    n, length, _ = emissions.shape
    top = emissions.max(axis=2, keepdims=True)
    here, step = np.exp((emissions - top).astype(np.float64)), np.exp(transitions.astype(np.float64))
    forward, backward, scale = np.zeros_like(here), np.ones_like(here), np.zeros((n, length, 1))
    now = here[:, 0] * np.exp(_START.astype(np.float64))
    for t in range(length):
        if t:
            now = (now @ step) * here[:, t]
        size = now.sum(axis=1, keepdims=True)
        now = now / size
        forward[:, t], scale[:, t] = now, size
    now = backward[:, -1]
    for t in range(length - 2, -1, -1):
        now = (here[:, t + 1] * now / scale[:, t + 1]) @ step.T
        backward[:, t] = now
    ahead = (here * backward / scale)[:, 1:].reshape(-1, step.shape[0])
    pairs = (forward[:, :-1].reshape(-1, step.shape[0]).T @ ahead) * step
    return forward * backward, pairs, np.log(scale).sum(axis=(1, 2)) + top.sum(axis=(1, 2))


def viterbi(emissions: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The best tags of each window; ties go to the lower tag."""
    n, length, _ = emissions.shape
    best, back = emissions[:, 0] + _START, np.zeros(emissions.shape, np.int8)
    for t in range(1, length):
        paths = best[:, :, None] + transitions
        back[:, t] = paths.argmax(axis=1)
        best = paths.max(axis=1) + emissions[:, t]
    tags = np.zeros((n, length), np.int8)
    tags[:, -1] = best.argmax(axis=1)
    rows = np.arange(n)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[rows, t, tags[:, t]]
    return tags


def gradient(net: Network, chars: np.ndarray, tags: np.ndarray) -> tuple[float, Network]:
    """Mean negative log likelihood of the tags, and its gradient, by back-propagation through time."""
    n, length = chars.shape
    h = HIDDEN
    states, (both, kept) = _states(net, chars)
    emissions = _padded(states @ net.out + net.out_bias, chars)
    transitions = net.transitions + _FORBIDDEN
    chance, pairs, total = marginals(emissions, transitions)
    rows, at = np.arange(n)[:, None], np.arange(length)
    path = emissions[rows, at, tags].sum() + transitions[tags[:, :-1], tags[:, 1:]].sum()
    np.subtract.at(pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1.0)
    chance[rows, at, tags] -= 1.0
    chance[chars == _PAD] = 0.0
    d_out = states.reshape(-1, 2 * h).T @ chance.reshape(-1, TAGS)
    d_states = chance.astype(np.float32) @ net.out.T
    d_states = np.stack([d_states[..., :h].transpose(1, 0, 2), d_states[:, ::-1, h:].transpose(1, 0, 2)])
    changes = np.zeros((2, length, n, 4 * h), np.float32)
    before = np.zeros((2, length, n, h), np.float32)
    d_state, d_cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
    for t in range(length - 1, -1, -1):
        (state, cell), ifo, g, squashed, real = kept[t]
        i, f, o = ifo[..., :h], ifo[..., h : 2 * h], ifo[..., 2 * h :]
        d_state = (d_state + d_states[:, t]) * real
        d_cell = (d_cell + d_state * o * (1 - squashed * squashed)) * real
        gates = changes[:, t]
        gates[..., :h], gates[..., h : 2 * h] = d_cell * g, d_cell * cell
        gates[..., 2 * h : 3 * h], gates[..., 3 * h :] = d_state * squashed, d_cell * i * (1 - g * g)
        gates[..., : 3 * h] *= ifo * (1 - ifo)
        before[:, t] = state
        d_state = np.matmul(gates, net.again.transpose(0, 2, 1))
        d_cell = d_cell * f
    changes = changes.reshape(2, -1, 4 * h)
    d_again = np.matmul(before.reshape(2, -1, h).transpose(0, 2, 1), changes)
    which = both.transpose(0, 2, 1).reshape(2, 1, -1) == np.arange(CLASSES)[:, None]
    d_projected = np.matmul(which.astype(np.float32), changes)
    d_into = np.matmul(net.embedding.T[None], d_projected)
    d_embedding = np.matmul(d_projected, net.into.transpose(0, 2, 1)).sum(axis=0)
    parts = (d_embedding, d_into, d_again, d_projected.sum(axis=1, keepdims=True), d_out, chance.sum(axis=(0, 1)), pairs * (_FORBIDDEN == 0))
    return float(total.sum() - path) / n, Network(*(np.asarray(p, np.float32) / n for p in parts))


def fit(windows: list[tuple[str, list[int]]], steps: int = 460, batch: int = 32, rate: float = 0.05) -> Network:
    """Train on (text, tags) windows by Adam in as many steps, however many windows there are; the order is fixed by their place."""
    net = fresh_network()
    chars = np.zeros((len(windows), WINDOW), np.uint8)
    tags = np.zeros((len(windows), WINDOW), np.int64)
    for i, (text, t) in enumerate(windows):
        chars[i, : len(text)] = classes(codes(text))
        tags[i, : len(t)] = t
    first, second = [[np.zeros_like(p) for p in net] for _ in "12"]
    order, waiting = np.random.RandomState(11), np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        while len(waiting) < batch:
            waiting = np.concatenate([waiting, order.permutation(len(windows))])
        own, waiting = waiting[:batch], waiting[batch:]
        _, change = gradient(net, chars[own], tags[own])
        now = rate * (1 - step / (steps + 1))
        for p, g, m, v in zip(net, change, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


# Texts.


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(starts, classes) of the windows of a text that hold a mark, on a grid of `STRIDE`; shorter ones are padded."""
    marks = np.array([p for m in _MARKS.finditer(text) for p in (m.start(), m.end() - 1)], np.int64)
    n = len(text)
    k = np.unique(np.concatenate([marks // STRIDE - j for j in range(WINDOW // STRIDE)])) if len(marks) else marks
    starts = k[k >= 0] * STRIDE
    own = classes(codes(text))
    at = starts[:, None] + np.arange(WINDOW)
    return starts, np.where(at < n, own[np.minimum(at, max(0, n - 1))], _PAD).astype(np.uint8) if n else np.zeros((0, WINDOW), np.uint8)


class Piece(NamedTuple):
    """A span of one window, with its score and whether the window's edges may have cut it."""

    kind: int
    start: int
    end: int
    score: float
    cut: bool


def decode(net: Network, starts: np.ndarray, chars: np.ndarray, lengths: np.ndarray) -> list[tuple[int, Piece]]:
    """(window, span) of each span that Viterbi finds; lengths: of the windows' texts."""
    emissions = scores(net, chars)
    transitions = net.transitions + _FORBIDDEN
    tags = viterbi(emissions, transitions)
    some = np.flatnonzero((tags != O).any(axis=1))
    if not len(some):
        return []
    inside = 1.0 - marginals(emissions[some], transitions)[0][..., O]
    out = []
    for row, w in enumerate(some):
        t, i = tags[w], 0
        while i < WINDOW:
            j = i + 1
            if t[i] != O:
                kind = (int(t[i]) - 1) // 2
                while j < WINDOW and t[j] == 2 + 2 * kind:
                    j += 1
                a, b = int(starts[w]) + i, int(starts[w]) + j
                cut = i == 0 and a > 0 or j == WINDOW and b < lengths[w]
                out.append((int(w), Piece(kind, a, b, float(inside[row, i:j].mean()), cut)))
            i = j
    return out


def reconciled(pieces: list[Piece]) -> list[Piece]:
    """The spans of a whole text from those of its windows.

    Overlapping pieces of one kind, one of them cut by its window's edge, are one span. Of the
    spans, those that don't overlap with the greatest sum of score times length stay.
    """
    joined: list[Piece] = []
    for kind in range(len(KINDS)):
        held: Piece | None = None
        for p in sorted((p for p in pieces if p.kind == kind), key=lambda p: (p.start, p.end)):
            if held and p.start < held.end and (held.cut or p.cut):
                held = Piece(kind, held.start, max(held.end, p.end), max(held.score, p.score), p.cut if p.end >= held.end else held.cut)
            else:
                if held:
                    joined.append(held)
                held = p
        if held:
            joined.append(held)
    joined = sorted({(p.start, p.end, p.kind): p for p in sorted(joined, key=lambda p: p.score)}.values(), key=lambda p: (p.end, p.start, p.kind))
    ends, best, take = [p.end for p in joined], [0.0], []
    for i, p in enumerate(joined):
        before = bisect_right(ends, p.start, 0, i)
        gain = best[before] + p.score * (p.end - p.start)
        take.append((gain > best[i], before))
        best.append(max(best[i], gain))
    out, i = [], len(joined)
    while i:
        taken, before = take[i - 1]
        if taken:
            out.append(joined[i - 1])
            i = before
        else:
            i -= 1
    return out[::-1]


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (KINDS.index(s.kind), s.start, s.end))


def scan(texts: list[str | None], net: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of each text. A found span joins unless a pattern span covers it."""
    base = [ordered(matches(t)[0]) if t else [] for t in texts]
    if net is None:
        return [(b, b) for b in base]
    pieces: list[list[Piece]] = [[] for _ in texts]
    held: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if held:
            owner = np.concatenate([np.full(len(s), i) for i, s, _ in held])
            lengths = np.array([len(texts[i]) for i in owner])
            starts = np.concatenate([s for _, s, _ in held])
            for w, p in decode(net, starts, np.concatenate([c for *_, c in held]), lengths):
                pieces[owner[w]].append(p)
            held.clear()

    waiting = 0
    for i, text in enumerate(texts):
        if text and _MARKS.search(text):
            starts, chars = windows(text)
            for at in range(0, len(starts), _BATCH):
                held.append((i, starts[at : at + _BATCH], chars[at : at + _BATCH]))
                waiting += len(held[-1][1])
                if waiting >= _BATCH:
                    flush()
                    waiting = 0
    flush()
    out = []
    for text, own, found in zip(texts, base, pieces, strict=True):
        more = [Span(KINDS[p.kind], p.start, p.end) for p in reconciled(found) if p.score >= LEAST_SCORE and _MARKS.search(text, p.start, p.end)]
        out.append((own, ordered([*own, *(s for s in more if not any(b.start <= s.start and s.end <= b.end for b in own))])))
    return out


# Training windows.


def _respelled(kind: str, words: list[str], draw: random.Random) -> str:
    """A piece of personal data of a kind, in one of several spellings."""
    number = lambda n: "".join(draw.choices("0123456789", k=n))
    name = lambda: (draw.choice(words) + draw.choice(["", number(2)])).lower()
    if kind == "email":
        local = draw.choice(["{}", "{}.{}", "{}_{}", "{}-{}", "{}+{}"]).format(name(), name())
        host = ".".join([name() for _ in range(draw.randint(1, 2))])
        end = draw.choice(["com", "org", "net", "de", "fr", "es", "co.uk", "io"])
        if draw.random() < 0.25:
            mark, dot = draw.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("[at]", "."), (" [at] ", ".")])
            return f"{local}{mark}{host}{dot}{end}"
        return f"{local}@{host}.{end}"
    if kind == "ip":
        if draw.random() < 0.2:
            return ":".join(f"{draw.randint(0, 65_535):x}" for _ in range(8))
        return ".".join(str(draw.randint(0, 255)) for _ in range(4))
    if kind == "card":
        mark = draw.choice(["", "", " ", "-", "."])
        return mark.join(number(4) for _ in range(4)) if draw.random() < 0.8 else mark.join([number(4), number(6), number(5)])
    a, b, c = number(3), number(3), number(4)
    return draw.choice([f"+{draw.randint(1, 99)} ({a}) {b}-{c}", f"+{draw.randint(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{draw.randint(10, 99)} {a} {b}{c}", f"0{a}/{b}{c}", f"+{draw.randint(10, 99)}{a}{b}{c}"])


def _harmless(words: list[str], draw: random.Random) -> str:
    """Something with digits or an at sign that is no personal data."""
    n = draw.randint
    return draw.choice([
        str(n(0, 9_999)), f"{n(1900, 2099)}", f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", f"{n(0, 23):02}:{n(0, 59):02}:{n(0, 59):02}", f"{n(1990, 2050)}-{n(1, 12):02}-{n(1, 28):02}",
        f"{n(1, 28)}.{n(1, 12)}.{n(1990, 2050)}", f"v{n(0, 20)}.{n(0, 30)}.{n(0, 99)}", f"{n(0, 9)}.{n(0, 10**6)}", f"#{n(1, 10**6)}", f"{n(0, 100)}%", f"${n(1, 10**4)}.{n(10, 99)}", f"@{draw.choice(words)}", f"{n(1, 50)} @ {n(1, 50)}",
        "".join(draw.choices("0123456789abcdef", k=n(24, 48))), f"{draw.choice(words)}{n(0, 99)}", f"{draw.choice(words)}-{n(1, 10**5)}", f"{n(1, 10**8)}", f"({n(1, 40)})", f'= "{"".join(draw.choices("0123456789abcdef", k=40))}"',
    ])


def _tagged(text: str, spans: list[Span]) -> list[int]:
    """A tag for each character; of overlapping spans the first counts."""
    tags = [O] * len(text)
    for s in sorted(spans, key=lambda s: s.start):
        if not any(tags[s.start : s.end]):
            k = KINDS.index(s.kind)
            tags[s.start : s.end] = [1 + 2 * k] + [2 + 2 * k] * (s.end - s.start - 1)
    return tags


def _cut(text: str, spans: list[Span], middle: int, draw: random.Random) -> tuple[str, list[int]]:
    """A window about a place, and its tags; a span that the window cuts goes on from its first character there."""
    start = max(0, min(middle - draw.randint(WINDOW // 4, 3 * WINDOW // 4), len(text) - WINDOW))
    end = min(len(text), start + WINDOW)
    inside = [Span(s.kind, max(s.start, start) - start, min(s.end, end) - start) for s in spans if s.start < end and start < s.end]
    return text[start:end], _tagged(text[start:end], inside)


def training_windows(text: str) -> Iterator[tuple[str, list[int]]]:
    """Windows of a text: about its pattern spans, about marks that aren't in one, and respelled ones.

    A number that only a checksum rules out (`matches`) tells nothing, so windows with one aren't used.
    """
    draw = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    base, failed = matches(text)
    doubtful = [s for s in failed if len(_digits(text[s.start : s.end])) >= 8]

    def usable(middle: int) -> bool:
        return not any(s.start < middle + WINDOW and middle - WINDOW < s.end for s in doubtful)

    for s in base[:40]:
        if usable(s.start):
            yield _cut(text, base, draw.randint(s.start, s.end), draw)
    plain = [m.start() for m, _ in zip(_MARKS.finditer(text), range(200), strict=False) if not any(s.start <= m.start() < s.end for s in base)]
    for at in draw.sample(plain, min(4, len(plain))):
        if usable(at):
            yield _cut(text, base, at, draw)
    words = [w for w in re.findall(r"[^\W\d_]{2,14}", text[:20_000])][:400] or ["a"]
    for kind in (*KINDS, None) * 10 if base else (None,) * 2:
        made = _respelled(kind, words, draw) if kind else _harmless(words, draw)
        more = _harmless(words, draw) if draw.random() < 0.3 else draw.choice(words)
        before, after = (" ".join(draw.choices(words, k=draw.randint(0, 9))) for _ in "12")
        made_at = len(before) + (before != "")
        mark = draw.choice(["", "", "", ".", ",", "!", "***"])
        whole = f"{before}{' ' if before else ''}{made}{mark} {after} {more}"
        yield _cut(whole, [Span(kind, made_at, made_at + len(made))] if kind else [], made_at, draw)


def _has_match(text: Column) -> Column:
    """True where a text may have a pattern match: each such text and few others, without Python."""
    return text.rlike(r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|\+[0-9]|[0-9]([\x20-]?[0-9]){15}")


def train(docs: DataFrame, text: str = "text", texts: int = TRAIN_TEXTS, windows: int = TRAIN_WINDOWS) -> Network | None:
    """Fit on at most `windows` windows with and `windows` without personal data.

    They come from about `texts` distinct texts with a pattern match and as many without,
    each by a hash lottery of its own, whatever their share; the windows are those with the least
    digest, so the network doesn't depend on partitions. None if no text has a match.
    """
    own = docs.select(col(text).alias("text")).where(col(text).isNotNull())
    own = own.select("text", F.xxhash64("text").alias("hash"), _has_match(F.col("text")).alias("matches"))
    some, plain = own.agg(*(F.approx_count_distinct(F.when(F.col("matches") == m, F.col("hash"))) for m in (True, False))).first()
    if not some:
        return None
    chance = F.when(F.col("matches"), min(1.0, texts / some)).otherwise(min(1.0, texts / max(1, plain)))
    sample = own.where(F.pmod("hash", F.lit(1_000_000_007)) < chance * 1_000_000_007).dropDuplicates(["hash"]).select("text")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                made = [w for t in part.to_pylist() for w in training_windows(t)]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in made], pa.string()), pa.array(["".join(map(str, x)) for _, x in made], pa.string())], ["text", "tags"])

    made = written(sample.mapInArrow(collect, "text string, tags string").distinct(), "training")
    picked = [made.where((F.col("tags").rlike("[1-9]")) == found).orderBy(F.md5("text"), "tags").limit(windows).collect() for found in (True, False)]
    if not picked[0]:
        return None
    return fit([(r["text"], list(map(int, r["tags"]))) for r in [*picked[0], *picked[1]]])


# On DataFrames.

_SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_RESULT_ARROW = pa.struct([("base", pa.list_(_SPAN_ARROW)), ("spans", pa.list_(_SPAN_ARROW))])


def _scan_udf(held: Broadcast):
    @F.arrow_udf("struct<base:array<struct<kind:string,start:int,end:int>>,spans:array<struct<kind:string,start:int,end:int>>>")
    def find(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts):
            for base, spans in scan(part.to_pylist(), held.value):
                out.append({"base": [s._asdict() for s in base], "spans": [s._asdict() for s in spans]})
        return pa.array(out, _RESULT_ARROW)

    return find


def find_personal_data(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Add `base_spans` and `personal_spans`: arrays of (kind, start, end) by kind and start; code points, end exclusive.

    NULL and empty texts have none; without a network both are the pattern spans. Every window of
    every text that holds a digit or an at sign is decoded; a window without one is O throughout, as
    no kind goes without, and a text without one isn't sent to Python. No row is dropped, nothing is shuffled,
    equal rows get equal spans; input columns named like new ones are replaced.
    """
    (name,) = fresh(docs, "__personal")
    marked = F.when(col(text).rlike(_MARK), col(text))
    found = docs.withColumn(name, _scan_udf(docs.sparkSession.sparkContext.broadcast(net))(marked))
    return with_columns(found, {"base_spans": F.col(f"{name}.base"), "personal_spans": F.col(f"{name}.spans")}).drop(name)


def masked(text: Column, spans: Column, mark: str = "*") -> Column:
    """The text with the characters of its spans replaced, its length kept."""
    def cover(held: Column, s: Column) -> Column:
        return F.overlay(held, F.repeat(F.lit(mark), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"])

    return F.aggregate(spans, text.cast("string"), cover)
