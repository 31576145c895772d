"""Token ids of whole batches with the `tokenizers` library, each distinct piece of text encoded once per worker.

The byte-level vocabulary splits text before a white-space run and between a letter and a following sign, so the ids of
a text are those of its pieces in order. Pieces are cut and told apart with numpy; only pieces that a worker has not met
go to the library. Texts with rarer white space (or the special token's string) are one piece of their own.
"""

from __future__ import annotations

import os

import numpy as np

from tidemark.llm.texts import U8, Slice, byte_class, kept, ranges, run_hashes

#: Distinct pieces a worker keeps, about 45 bytes each; at the bound it starts anew. Workers outlive a stage, and what they
#: keep is taken from the next one's memory.
CACHE_PIECES = 1 << 19
_JOIN_BYTES = 1 << 16

_WHITE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
_LETTER = byte_class([(0x41, 0x5A), (0x61, 0x7A)])
_SIGN = byte_class([(0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)])
_RARE = byte_class([(0x1C, 0x1F), (0xC2, 0xC2), (0xE1, 0xE3)])


def _rare_white(data: np.ndarray) -> np.ndarray:
    """Places of white space beyond ASCII's usual six characters, and of the four separators."""
    at = np.flatnonzero(_RARE[data])
    if not len(at):
        return at
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = padded[at], padded[at + 1], padded[at + 2]
    rare = a < 0x20
    rare |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    rare |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    rare |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    rare |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[rare]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.width = np.zeros(self.size, dtype=np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=U8)
        self.at = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _cuts(self, part: Slice) -> np.ndarray:
        data, off = part.data, part.off
        white = _WHITE[data]
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = white[1:] & ~white[:-1]
        # A single white-space character that is no space stands alone before a word.
        alone = cut.copy()
        alone[0] = white[0]
        inner = off[1:-1][off[1:-1] < len(data)]
        alone[inner] = white[inner]
        after = np.flatnonzero(alone[:-1] & ~white[1:] & (data[:-1] != 0x20)) + 1
        cut[after] = True
        letter = _LETTER[data]
        latin = np.zeros(len(data), dtype=bool)
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut[1:] |= (letter | latin)[:-1] & _SIGN[data[1:]]
        odd = np.searchsorted(off, _rare_white(data), "right") - 1
        for s in self.special:
            raw = data.tobytes()
            at = raw.find(s)
            while at >= 0:
                odd = np.append(odd, np.searchsorted(off, at, "right") - 1)
                at = raw.find(s, at + 1)
        for i in np.unique(odd):
            cut[off[i] : off[i + 1]] = False
        cut[off[:-1][off[:-1] < len(data)]] = True
        return np.flatnonzero(cut)

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        plain = (data[starts] == 0x20) & (ends - starts > 1)
        plain[plain] &= ~_WHITE[data[starts[plain] + 1]]
        found: list = [None] * len(starts)
        at = np.flatnonzero(plain)
        size = (ends - starts)[at]
        group = np.cumsum(size) // _JOIN_BYTES
        edges = np.flatnonzero(np.diff(group, prepend=-1))
        blocks = [at[a:b] for a, b in zip(edges, [*edges[1:], len(at)])]
        # Pieces of one space and what follows can stand side by side; the ids of a piece end where its bytes end.
        joined = [b"".join(raw[starts[i] : ends[i]] for i in block).decode() for block in blocks]
        rest = list(np.flatnonzero(~plain))
        for block, text in zip(blocks, joined):
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            stop = np.cumsum(self.width[ids])
            want = np.cumsum((ends - starts)[block])
            end = np.searchsorted(stop, want) + 1
            if len(ids) and end[-1] == len(ids) and (stop[end - 1] == want).all():
                for i, a, b in zip(block, [0, *end[:-1]], end):
                    found[i] = ids[a:b]
            else:
                rest.extend(block)
        for a in range(0, len(rest), 4096):
            some = rest[a : a + 4096]
            for i, e in zip(some, self.library.encode_batch_fast([raw[starts[i] : ends[i]].decode() for i in some], add_special_tokens=False)):
                found[i] = np.array(e.ids, dtype=np.uint32)
        count = np.array([len(f) for f in found], dtype=np.int64)
        flat = np.concatenate(found)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, self.used + np.cumsum(count) - count)
        self.count = np.insert(self.count, place, count)
        self.used += len(flat)

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and how many each text has."""
        data = part.data
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(part), np.int64)
        starts = self._cuts(part)
        ends = np.append(starts[1:], len(data))
        kinds, first, kind = np.unique(run_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(kinds) > CACHE_PIECES:
            self._clear()
        place = np.searchsorted(self.keys, kinds)
        known = np.zeros(len(kinds), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == kinds[inside]
        if not known.all():
            new = first[~known]
            self._learn(data, kinds[~known], starts[new], ends[new])
            place = np.searchsorted(self.keys, kinds)
        count = self.count[place][kind]
        ids = self.flat[np.repeat(self.at[place][kind], count) + ranges(count)]
        total = np.concatenate([[0], np.cumsum(count)])
        by_text = total[np.searchsorted(starts, part.off)]
        return ids, np.diff(by_text)


def encoder(path: str) -> Encoder:
    """One a worker process and stage."""
    return kept(f"encoder {path}", lambda: Encoder(path))
