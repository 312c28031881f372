"""Tokens of many words at once: the merges of all words are made in step, as array operations.

Each row holds a word's symbols. A step finds the best pair of every row, the leftmost among equals, puts the merged
symbol in the pair's place and looks up the two pairs that it is part of now. A row is done when none of its
pairs merges any more; the number of its symbols is the number of its tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np

from holdfast.llm.token_counts import byte_symbols

NEVER = np.iinfo(np.int32).max
# Words of more bytes are left to the caller; a step works on so many cells at once.
LONGEST, CELLS = 64, 1 << 18


class WordMerger:
    """For the byte-level tokenizer with word ends in a file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int32)
        self.last = np.array([vocab[s + end] for s in symbols], dtype=np.int32)
        pairs = np.array([(vocab[a], vocab[b]) for a, b in model["merges"]], dtype=np.int64).reshape(-1, 2)
        self.made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int32)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, `NEVER` where it does not merge; a missing symbol is negative."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.rank_of[at], NEVER)

    def _merged(self, ids: np.ndarray) -> np.ndarray:
        """The number of tokens of each row of symbols; rows end in negative cells."""
        counts = (ids >= 0).sum(axis=1)
        rows = np.arange(len(ids))
        ranks = self.ranks(ids[:, :-1], ids[:, 1:])
        while ranks.shape[1]:
            best = ranks.argmin(axis=1)
            least = ranks[np.arange(len(ids)), best]
            going = np.flatnonzero(least < NEVER)
            if not len(going):
                break
            rows, ids, ranks, best, least = rows[going], ids[going], ranks[going], best[going], least[going]
            counts[rows] -= 1
            each, width = np.arange(len(rows)), ids.shape[1]
            keep = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > best[:, None])
            ids = np.take_along_axis(ids, keep, axis=1)
            ids[each, best] = self.made[least]
            if width == 2:
                break
            ranks = np.take_along_axis(ranks, keep[:, : width - 2] if width > 2 else keep, axis=1)
            for place in (best - 1, best):
                inside = np.flatnonzero((place >= 0) & (place < width - 2))
                at = place[inside]
                ranks[inside, at] = self.ranks(ids[inside, at], ids[inside, at + 1])
        return counts

    def counts(self, words: Iterable[str]) -> np.ndarray:
        """Tokens of each word; -1 for those that are too long."""
        units = [word.encode("utf-8", "surrogatepass") for word in words]
        sizes = np.array(list(map(len, units)), dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        whole = np.frombuffer(b"".join(units), dtype=np.uint8)
        found = np.where(sizes > LONGEST, -1, np.minimum(sizes, 1))
        order = np.flatnonzero((sizes > 1) & (sizes <= LONGEST))
        order = order[np.argsort(sizes[order], kind="stable")]
        at = 0
        while at < len(order):
            width = int(sizes[order[min(at + CELLS // LONGEST, len(order) - 1)]])
            part = order[at : at + max(1, CELLS // width)]
            part = part[sizes[part] <= width]
            at += len(part)
            place = np.arange(width)[None, :]
            size = sizes[part][:, None]
            values = whole[np.minimum(starts[part][:, None] + place, len(whole) - 1)]
            ids = np.where(place < size - 1, self.inner[values], np.where(place == size - 1, self.last[values], -1))
            found[part] = self._merged(ids.astype(np.int32))
        return found
