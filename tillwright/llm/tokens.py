"""Token ids of whole texts with the tokenizers library, one encoding per distinct piece of text.

A text is cut where white space follows other characters, and between a letter and one mark that
ends such a piece. Neither vocabulary has a token across such a place, so the ids of a text are those of its pieces in order. Pieces repeat far more often
than texts, so each distinct piece of a batch is encoded once and its ids are copied to where it
stands. Texts in which a cut could change ids (rare kinds of white space, markers of special
tokens) are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Collection, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are encoded together, bytes of known pieces that a worker keeps (and as many of older ones), bytes that a piece takes besides its own.
BATCH_BYTES = 8 << 20
KEPT_BYTES = 72 << 20
ENTRY_BYTES = 200

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
# lead bytes of white space other than the six characters above, and controls that only some libraries call white space
_ODD = np.zeros(256, bool)
_ODD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD[ord("<")] = True
_WHOLE = re.compile(r"<\||[^\S \t\n\r\x0b\x0c]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if c in b"\t\n\r\x0b\x0c" else c for c in range(256))
# marks of which neither vocabulary has a token that also holds a letter before it, and letters of ASCII and Latin-1 (those after a lead byte)
_MARK, _LETTER, _LATIN = np.zeros((3, 256), bool)
_MARK[list(b",.;:!?")] = True
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_LATIN[[c - 64 for c in range(0xC0, 0x100) if chr(c).isalpha()]] = True
# a space and letters of ASCII and Latin-1, in UTF-8
_LETTERS = re.compile(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


class Encoder:
    """Encodes with one vocabulary file; ``lower``: the vocabulary ignores ASCII case and white space; ``kept``: bytes of known pieces."""

    def __init__(self, path: str, lower: bool, kept: int = KEPT_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lower = lower
        self.kept, self.held = kept, 0
        self.plain = _LETTERS.fullmatch
        self.edge = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        marked = (lambda t: t.endswith("</w>")) if lower else (lambda t: t.startswith("\u0120"))
        self.edge[[i for t, i in self.tokenizer.get_vocab().items() if marked(t)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _known(self, pieces: list[bytes]) -> list[bytes | None]:
        """What is known of each piece; what only the older half of the memory knows moves to the younger."""
        found = list(map(self.young.get, pieces))
        if self.old:
            asked = [p for p, x in zip(pieces, found) if x is None]
            again = {p: x for p, x in zip(asked, map(self.old.get, asked)) if x is not None}
            if again:
                self._hold(again, again.values())
                self.young.update(again)
                found = [again.get(p) if x is None else x for p, x in zip(pieces, found)]
        return found

    def _hold(self, pieces: Collection[bytes], ids: Iterable[bytes]) -> None:
        self.held += ENTRY_BYTES * len(pieces) + sum(map(len, pieces)) + sum(map(len, ids))

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces not known yet."""
        plain = [p for p in pieces if (p[1:].isalpha() and p[0] == 32) or self.plain(p)]
        for k in range(0, len(plain), 500):
            self._learn_plain(plain[k : k + 500])
        rest = [p for p in pieces if p not in self.young]
        for piece, out in zip(rest, self.tokenizer.encode_batch_fast([p.decode() for p in rest], add_special_tokens=False)):
            self.young[piece] = np.array(out.ids, dtype="<u4").tobytes()

    def _learn_plain(self, words: list[bytes]) -> None:
        """Letter runs after one space are encoded in one text: the vocabulary marks where each begins or ends."""
        text = b"".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        edges = np.flatnonzero(self.edge[ids])
        edges = np.concatenate([[0], edges + 1] if self.lower else [edges, [len(ids)]]) * 4
        if len(edges) == len(words) + 1:
            data = ids.tobytes()
            self.young.update(zip(words, map(data.__getitem__, map(slice, edges.tolist(), edges[1:].tolist()))))

    @staticmethod
    def _marks(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places of a mark that ends a piece right after a letter."""
        at, size = offsets[1:] - 1, np.diff(offsets)
        ends = _MARK[raw[at]] & (size > 1)
        at, size = at[ends], size[ends]
        before = raw[at - 1]
        return at[_LETTER[before] | ((size > 2) & _LATIN[before] & (raw[at - 2] == 0xC3))]

    def _pieces(self, data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in ``data`` and the place of each text's first id."""
        if not data:
            return np.zeros(0, "<u4"), np.zeros(len(bounds), np.int64)
        raw = np.frombuffer(data.translate(_LOWER) if self.lower else data, np.uint8)
        space = _SPACE[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        cut[bounds] = True
        cut[-1] = True
        cut[self._marks(raw, np.flatnonzero(cut))] = True
        offsets = np.flatnonzero(cut).astype(np.int32)
        chunks = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = chunks.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._known(words)
        if missing := [w for w, k in zip(words, known) if k is None]:
            self._learn(missing)
            self._hold(missing, map(self.young.__getitem__, missing))
            known = [self.young[w] if k is None else k for w, k in zip(words, known)]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        codes = coded.indices.to_numpy()
        taken = sizes[codes]
        ends = np.cumsum(taken)
        at = np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - taken), taken)
        at += np.arange(len(at))
        if self.held > self.kept:
            self.old, self.young, self.held = self.young, {}, 0
        return flat[at], np.concatenate([[0], ends])[np.searchsorted(offsets, bounds)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null counts as empty."""
        out: list[np.ndarray] = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            group.append((text or "").encode())
            size += len(group[-1])
            if size >= BATCH_BYTES:
                out += self._group(group)
                group, size = [], 0
        out += self._group(group)
        pa.default_memory_pool().release_unused()
        return out

    def _group(self, group: list[bytes]) -> list[np.ndarray]:
        if not group:
            return []
        data = b"".join(group)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in group])]).astype(np.int64)
        odd = np.searchsorted(np.flatnonzero(_ODD[np.frombuffer(data, np.uint8)]), bounds)
        ids, first = self._pieces(data, bounds)
        out = [ids[a:b] for a, b in zip(first[:-1], first[1:])]
        for k in np.flatnonzero(np.diff(odd)):
            text = group[k].decode()
            if _WHOLE.search(text):
                out[k] = self.whole(text)
        return out


@lru_cache(maxsize=4)
def encoder(path: str, lower: bool = False, kept: int = KEPT_BYTES) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return Encoder(path, lower, kept)
