"""Encode whole texts with a `tokenizers` vocabulary, caching the pieces that repeat."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept by one Python worker, about 200 MB.
CACHE_PIECES = 900_000
#: Pieces seen for the first time that the library gets as one text.
JOINED_PIECES = 256
#: A space before white space or at the end: only then may a cut before every space change the result.
_SPACE_RUN = re.compile(r" (?:\s|\Z)")
#: The byte of a space in a byte-level vocabulary.
_SPACE = "\u0120"


class Encoder:
    """Texts to packed little-endian ids of `width` bytes, on little-endian machines.

    The byte-level pre-tokenizer never joins a space to what stands before it,
    so a text without longer white-space runs can be cut before every space and
    each piece encoded alone. The library encodes every piece; pieces seen
    before come from the cache. Texts where a cut isn't certain to be safe
    (white-space runs with spaces, a NUL character, the string of a special
    token) are encoded whole.

    The pieces of a call are cut and numbered by Arrow, so that Python handles
    each distinct one once; numpy puts their ids in the order of the texts.
    """

    def __init__(self, path: str, width: int = 4, plain_specials: bool = False, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.code = next(c for c in "HIL" if array(c).itemsize == width)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(_SPACE)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece. Those that begin with a space are joined to texts, whose ids are cut at tokens that begin with one."""
        spaced, others = [p for p in pieces if p[:1] == " "], [p for p in pieces if p[:1] != " "]
        joined = ["".join(spaced[i : i + JOINED_PIECES]) for i in range(0, len(spaced), JOINED_PIECES)]
        ids = np.frombuffer(b"".join(self._whole(joined)), self.code)
        cuts = np.append(np.flatnonzero(self.spaced[ids]), len(ids)) * ids.itemsize
        if len(cuts) != len(spaced) + 1:  # some other token holds a space
            return self._whole(pieces)
        data, cuts = ids.tobytes(), cuts.tolist()
        found = iter([data[a:b] for a, b in zip(cuts, cuts[1:])])
        rest = iter(self._whole(others))
        return [next(found) if p[:1] == " " else next(rest) for p in pieces]

    def _learn(self, pieces: list[str]) -> None:
        """Have the ids of all these pieces in the young cache; those unseen for long are forgotten."""
        young, old = self.young, self.old
        new, composed = {}, []
        for p in [p for p in pieces if p not in young]:
            ids = old.get(p)
            if ids is not None:
                young[p] = ids
            elif p[1:].isalpha():
                new[p] = None
            else:
                parts = _atoms(p)
                new.update((x, None) for x in parts if x not in young)
                if len(parts) > 1:
                    composed.append((p, parts))
        fresh = list(new)
        young.update(zip(fresh, self._pieces(fresh), strict=True))
        known = young.__getitem__
        young.update([(p, b"".join(map(known, parts))) for p, parts in composed])

    def _safe(self, text: str) -> bool:
        return "\0" not in text and not _SPACE_RUN.search(text) and not any(s in text for s in self.specials)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; None and "" have none."""
        if 2 * len(self.young) > self.cache_pieces:
            self.old, self.young = self.young, {}
        safe = [bool(t) and self._safe(t) for t in texts]
        whole = iter(self._whole([t for t, s in zip(texts, safe, strict=True) if t and not s]))
        cut = iter(self._cut(pa.array([t for t, s in zip(texts, safe, strict=True) if s], pa.string())))
        return [next(cut) if s else next(whole) if t else b"" for t, s in zip(texts, safe, strict=True)]

    def _cut(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts that may be cut before every space."""
        pieces = pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")
        first = pieces.offsets.to_numpy()
        numbered = pieces.flatten().dictionary_encode()
        distinct, place = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        self._learn(distinct)
        values = list(map(self.young.__getitem__, distinct))
        ids = np.frombuffer(b"".join(values), self.code)
        size = np.fromiter(map(len, values), np.int64, len(values)) // ids.itemsize
        start = np.cumsum(size) - size
        count = size[place]
        end = np.cumsum(count)
        out = ids[np.repeat(start[place] - end + count, count) + np.arange(count.sum())]
        bounds = np.concatenate([[0], end])[first].tolist()
        return [out[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


def _atoms(piece: str) -> list[str]:
    """Cut a piece further where the pre-tokenizer always does: a letter before a last comma or full stop, and
    around a single line feed between a word or mark and a letter."""
    at = piece.find("\n")
    if at > 0 and piece[at + 1 : at + 2].isalpha() and not piece[at - 1].isspace() and piece.find("\n", at + 1) < 0:
        return [*_atoms(piece[:at]), "\n", *_atoms(piece[at + 1 :])]
    if piece[-1:] in (",", ".") and piece[-2:-1].isalpha():
        return [piece[:-1], piece[-1]]
    return [piece]


@lru_cache(maxsize=4)
def encoder(path: str, width: int = 4, plain_specials: bool = False) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(path, width, plain_specials)
