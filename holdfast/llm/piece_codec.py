"""SentencePiece encoding and decoding with a suffix array.

The texts of a batch are cut where no piece can cross (before a run of spaces), and the different units are
put one after the other into one array of characters. Its suffixes are sorted as far as the longest piece
reaches. Every piece of the vocabulary is then looked up by binary search, which gives the range of all its
occurrences at once. These are the edges: a piece from one position to another. Sorted by where they end,
they are relaxed from left to right: a position keeps the piece whose neighbour before it goes with it under
the model's merging by score, and exactly one does. Walking back from a unit's end gives its pieces.

Characters that no piece covers become byte pieces. Decoding joins the pieces' text, bytes included, turns
the space mark into spaces and drops the one that encoding put in front.

Nulls and edges: a null text counts as empty and has no pieces; a null identifier is carried through;
repeated rows are encoded each; very long texts are handled in batches of their units; an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.bpe import NEVER, Neighbours, Recent
from holdfast.llm.common import read_table

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
UNIT = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")
# Sizes that bound a task's memory; what is beyond is computed again or in another batch.
BATCH_CHARACTERS, SLICE_CHARACTERS, UNITS_HELD, LENGTH_HELD, PAIRS_HELD = 400_000, 4_000_000, 400_000, 48, 1_000_000
SEPARATOR = 0x110000  # stands between units; behind all characters
NO_PIECE = -1


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the `depth` characters that follow, by doubling the length compared."""
    _, rank = np.unique(codes, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    bits = int(rank.max()).bit_length()
    packed = 1
    size = len(codes)
    key = rank.copy()
    while packed < depth and bits * (packed + 1) <= 62:
        key <<= bits
        if packed < size:
            key[: size - packed] |= rank[packed:]
        packed += 1
    order = np.argsort(key)
    while packed < depth:
        rank = np.empty(size, dtype=np.int64)
        ordered = key[order]
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        key = rank << 31
        if packed < size:
            key[: size - packed] |= rank[packed:]
        order = np.argsort(key)
        packed *= 2
    return order


def occurrence_ranges(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of `pieces` (characters, then -1) the range of `order` whose suffixes begin with it.

    All pieces are searched at once, one character deeper in each round; those that are not there drop out.
    """
    padded = np.concatenate([codes, np.full(pieces.shape[1], -1, dtype=codes.dtype)])
    low = np.zeros(len(pieces), dtype=np.int64)
    high = np.full(len(pieces), len(order), dtype=np.int64)
    for depth in range(pieces.shape[1]):
        live = np.flatnonzero((pieces[:, depth] >= 0) & (low < high))
        if not len(live):
            break
        wanted = pieces[live, depth]
        bounds = []
        for target in (wanted, wanted + 1):
            left, right = low[live].copy(), high[live].copy()
            while (open_ := left < right).any():
                middle = (left + right) >> 1
                below = padded[order[np.minimum(middle, len(order) - 1)] + depth] < target
                left = np.where(open_ & below, middle + 1, left)
                right = np.where(open_ & ~below, middle, right)
            bounds.append(left)
        low[live], high[live] = bounds
    return low, high


def common_prefixes(units: list[str], sizes: np.ndarray) -> np.ndarray:
    """How many characters, up to `LENGTH_HELD`, each unit has in common with the one before it."""
    if len(units) < 2:
        return np.zeros(len(units), dtype=np.int64)
    # a mark behind the end keeps null characters apart from the padding
    width = LENGTH_HELD + 1
    marked = np.array([u[:LENGTH_HELD] + "\U0010ffff" for u in units], dtype=f"<U{width}")
    table = marked.view("<u4").reshape(-1, width)
    same = np.argmin(np.column_stack([table[1:] == table[:-1], np.zeros(len(units) - 1, dtype=bool)]), axis=1)
    return np.concatenate([[0], np.minimum(same, np.minimum(sizes[1:], sizes[:-1]))])


class PieceCodec:
    """Encodes and decodes with the pieces and scores of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.vocab_size())
        self.pieces = [model.id_to_piece(i) for i in numbers]
        self.byte_value = {i: int(self.pieces[i][3:5], 16) for i in numbers if model.is_byte(i)}
        self.byte_piece = {b: i for i, b in self.byte_value.items()}
        self.unknown = model.unk_id()
        self.silent = {i for i in numbers if model.is_control(i)}
        plain = [i for i in numbers if i not in self.byte_value and i not in self.silent and i != self.unknown]
        number_of = {self.pieces[i]: i for i in plain}
        self.number_of = number_of
        score = {self.pieces[i]: model.get_score(i) for i in plain}
        self.neighbours = Neighbours(lambda a, b: -score[a + b] if a + b in score else NEVER, list)
        usable = [i for i in plain if self.neighbours.whole(self.pieces[i])]
        self.longest = max(len(self.pieces[i]) for i in usable)
        self.searched = np.full((len(usable), self.longest), -1, dtype=np.int32)
        for row, i in enumerate(usable):
            self.searched[row, : len(self.pieces[i])] = [ord(c) for c in self.pieces[i]]
        self.searched_numbers = np.array(usable, dtype=np.int64)
        self.searched_lengths = np.array([len(self.pieces[i]) for i in usable], dtype=np.int64)
        self.single = np.array(sorted(ord(self.pieces[i]) for i in usable if len(self.pieces[i]) == 1))
        self.held: Recent[str, bytes] = Recent(UNITS_HELD)
        self.written = [np.array([i], dtype="<i4").tobytes() for i in numbers]
        self.text_of = [self._bytes(i) for i in numbers]
        self.fits: dict[int, bool] = {}

    def _bytes(self, number: int) -> bytes:
        """What a piece decodes to."""
        if number in self.byte_value:
            return bytes([self.byte_value[number]])
        if number in self.silent:
            return b""
        return " ⁇ ".encode() if number == self.unknown else self.pieces[number].replace(SPACE_MARK, " ").encode()

    def _text(self, number: int) -> str:
        """The text of a piece, or of an uncovered character, which is numbered behind the pieces."""
        return self.pieces[number] if number < len(self.pieces) else chr(number - len(self.pieces))

    def _fit(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= PAIRS_HELD:
                self.fits.clear()
            found = self.fits[key] = self.neighbours.fit(self._text(left), self._text(right))
        return found

    def edges(self, codes: np.ndarray, known_to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence that ends behind `known_to` of its start, by end, longer
        pieces first."""
        order = suffix_order(codes, self.longest)
        low, high = occurrence_ranges(codes, order, self.searched)
        counts = high - low
        ends_of = np.cumsum(counts)
        found = np.arange(int(ends_of[-1])) - np.repeat(ends_of - counts, counts) + np.repeat(low, counts)
        starts = order[found]
        ends = starts + np.repeat(self.searched_lengths, counts)
        numbers = np.repeat(self.searched_numbers, counts)
        bare = np.flatnonzero(~np.isin(codes, self.single) & (codes != SEPARATOR))
        starts = np.concatenate([starts, bare])
        ends = np.concatenate([ends, bare + 1])
        numbers = np.concatenate([numbers, codes[bare] + len(self.pieces)])
        open_ = np.flatnonzero(ends > known_to[starts])
        by_end = open_[np.argsort(ends[open_] << 31 | starts[open_])]
        return starts[by_end], ends[by_end], numbers[by_end]

    def encode_units(self, units: list[str]) -> list[bytes]:
        """The piece numbers of each unit, as little-endian 32-bit integers; `units` in sorted order.

        What a unit has in common with the one before it is relaxed already and copied.
        """
        sizes = np.array([len(u) for u in units], dtype=np.int64)
        common = common_prefixes(units, sizes)
        text = " ".join(units) + " "
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<i4").astype(np.int64)
        begins = np.cumsum(sizes + 1) - sizes - 1
        codes[begins + sizes] = SEPARATOR
        starts, ends, numbers = self.edges(codes, np.repeat(begins + common, sizes + 1))
        firsts = np.searchsorted(ends, begins).tolist() + [len(ends)]
        starts, ends, numbers = starts.tolist(), ends.tolist(), numbers.tolist()
        state = [NO_PIECE] * (len(codes) + 1)
        length = [0] * (len(codes) + 1)  # of the piece that ends here
        fits, fit, written, bare = self.fits, self._fit, self.written, len(self.pieces)
        out, last = [], 0
        for unit, (begin, size, same) in enumerate(zip(begins.tolist(), sizes.tolist(), common.tolist(), strict=True)):
            if same:
                state[begin + 1 : begin + same + 1] = state[last + 1 : last + same + 1]
                length[begin + 1 : begin + same + 1] = length[last + 1 : last + same + 1]
            last = begin
            low, high = firsts[unit], firsts[unit + 1]
            for start, end, number in zip(starts[low:high], ends[low:high], numbers[low:high], strict=True):
                if state[end] != NO_PIECE:
                    continue
                before = state[start]
                if start != begin:
                    if before == NO_PIECE:
                        continue
                    ok = fits.get(before << 32 | number)
                    if not (fit(before, number) if ok is None else ok):
                        continue
                state[end], length[end] = number, end - start
            at, parts = begin + size, []
            while at > begin:
                number = state[at]
                parts.append(written[number] if number < bare else self._bare(number))
                at -= length[at]
            out.append(b"".join(parts[::-1]))
        return out

    def _bare(self, number: int) -> bytes:
        """The byte pieces of an uncovered character."""
        return b"".join(self.written[self.byte_piece[b]] for b in self._text(number).encode("utf-8", "surrogatepass"))

    @staticmethod
    def units(text: str | None) -> list[str]:
        if not text:
            return []
        return UNIT.findall(SPACE_MARK + text.replace(" ", SPACE_MARK))

    def learn(self, units: Iterable[str]) -> dict[str, bytes]:
        """Numbers of units not held yet, in batches of bounded size."""
        new: dict[str, bytes] = {}
        batch: list[str] = []
        size = 0
        for unit in sorted(units):
            batch.append(unit)
            size += len(unit) + 1
            if size >= BATCH_CHARACTERS:
                new.update(zip(batch, self.encode_units(batch), strict=True))
                batch, size = [], 0
        if batch:
            new.update(zip(batch, self.encode_units(batch), strict=True))
        return new

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The piece numbers of each text, as little-endian 32-bit integers."""
        cut = [self.units(t) for t in texts]
        known = {u: self.held.get(u) for u in {u for units in cut for u in units}}
        new = self.learn(u for u, numbers in known.items() if numbers is None)
        known |= new
        for unit, numbers in new.items():
            if len(unit) <= LENGTH_HELD:
                self.held.put(unit, numbers)
        for units in cut:
            yield b"".join(map(known.__getitem__, units))

    def decode(self, numbers: Iterable[int]) -> str:
        text = b"".join(map(self.text_of.__getitem__, numbers)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@cache
def codec(path: str) -> PieceCodec:
    """One per worker process and model file."""
    return PieceCodec(path)


def _batches(texts: pd.Series) -> Iterator[list[str | None]]:
    """The texts in slices of about a batch's characters."""
    batch: list[str | None] = []
    size = 0
    for text in texts:
        batch.append(text)
        size += len(text or "")
        if size >= SLICE_CHARACTERS:
            yield batch
            batch, size = [], 0
    yield batch


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, pieces (array of piece numbers)."""
    path = path or public_tokenizers.path(MODEL)

    @F.pandas_udf("array<int>")
    def numbers(texts: pd.Series) -> pd.Series:
        used = codec(path)
        found = [np.frombuffer(n, "<i4") for batch in _batches(texts) for n in used.encode_batch(batch)]
        return pd.Series(found, dtype=object)

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), numbers(F.col(f"`{text_col}`")).alias("pieces"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of doc_id, pieces: doc_id, text. A null array counts as empty."""
    path = path or public_tokenizers.path(MODEL)

    @F.pandas_udf("string")
    def texts(numbers: pd.Series) -> pd.Series:
        used = codec(path)
        return pd.Series([used.decode([] if n is None else n.tolist()) for n in numbers], dtype=object)

    return encoded.select("doc_id", texts("pieces").alias("text"))


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_pieces, pieces_sha256 (of the numbers as little-endian 32-bit
    integers), round_trip (decoding gives the text back, with every space mark as a space)."""
    path = path or public_tokenizers.path(MODEL)

    @F.pandas_udf("n_pieces long, pieces_sha256 string, round_trip boolean")
    def digests(texts: pd.Series) -> pd.DataFrame:
        used = codec(path)
        rows = []
        for batch in _batches(texts):
            for text, numbers in zip(batch, used.encode_batch(batch), strict=True):
                decoded = used.decode(np.frombuffer(numbers, "<i4").tolist())
                same = decoded == (text or "").replace(SPACE_MARK, " ")
                rows.append((len(numbers) // 4, hashlib.sha256(numbers).hexdigest(), same))
        return pd.DataFrame(rows, columns=["n_pieces", "pieces_sha256", "round_trip"])

    return docs.select("doc_id", digests("text").alias("digest")).select("doc_id", "digest.*")


def query(spark, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents"))
