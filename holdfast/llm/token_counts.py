"""Exact token counts at every prefix, by dynamic programming.

For every prefix of a word the last token is found from the last tokens of shorter prefixes, once with the
mark that ends a word and once without. The table of a word thus holds the exact count of tokens of each of
its prefixes, and a text's count at any place is the sum over the words before plus one entry. How many
tokens a text has, whether it keeps a budget and where it must be cut to keep one are read from these tables
without encoding again.

Words and symbols are as the tokenizer file states: special strings first, then composed and lower-cased
text without white space, contractions, letters, single digits, other signs, bytes. Characters that Python's
tables do not know, or know otherwise than the expression library's, are lower-cased, composed and told apart by
the tokenizer library's own tables.

Nulls and edges: a null text counts as empty and has no tokens; a null identifier is carried through;
repeated rows are counted each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdfast.llm.bpe import NEVER, Neighbours, Recent
from holdfast.llm.common import read_table

MAX_TOKENS = 2_048
TOKENIZER = "word_bpe_49k.json"
# Sizes that bound a task's memory; what is beyond is computed again.
WORDS_HELD, LENGTH_HELD, PAIRS_HELD = 400_000, 48, 1_000_000
# White space of the Unicode standard.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
NOT_SPACE = re.compile(f"[^{SPACE}]+")
# Python's own split takes these for white space as well.
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is one, else the next free one."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


@cache
def unknown_characters() -> bytes:
    """By code point, 1 for characters whose case or kind may be another one in the tokenizer library, whose tables can
    be newer: those that one of the two tables here lacks, and those that they take for different kinds."""
    found = bytearray(0x110000)
    for first in range(0, 0x110000, 0x800):  # a block at a time, for little memory; one block holds the surrogates alone
        if first == 0xD800:
            continue
        block = "".join(map(chr, range(max(first, 0x80), first + 0x800)))
        known, letters, digits = (set(regex.findall(kind, block)) for kind in (r"\P{Cn}", r"\p{L}", r"\p{N}"))
        for c in block:
            category = unicodedata.category(c)
            kind = "L" if c in letters else "N" if c in digits else ""
            if category == "Cn" or c not in known or kind != (category[0] if category[0] in "LN" else ""):
                found[ord(c)] = 1
    return bytes(found)


class TextRules:
    """How the tokenizer in a file takes a text apart, down to words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.path = path
        steps = settings["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        special = [t["content"] for t in settings["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        self.library = Tokenizer.from_file(path)
        self.unknown = unknown_characters()
        self.learn(settings)

    def learn(self, settings: dict) -> None:
        """Take in what else of the file is needed."""

    def unsure(self, text: str) -> bool:
        """Whether the text has a character that the tables here may not know rightly."""
        return not text.isascii() and any(map(self.unknown.__getitem__, map(ord, set(text))))

    def words_of(self, chunk: str) -> list[str]:
        """The words of a normalised text without white space."""
        if not self.unsure(chunk):
            return self.words.findall(chunk)
        return [chunk[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def normalised(self, text: str) -> str:
        """Composed and lower-cased; white space stays as it is."""
        if not text.isascii():
            if self.unsure(text):
                return NOT_SPACE.sub(lambda run: self._normalised(run.group()), text)
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # each character by itself: no special form at a word's end
                return "".join(c.lower() for c in text)
        return text.lower()

    def _normalised(self, run: str) -> str:
        return self.library.normalizer.normalize_str(run) if self.unsure(run) else self.normalised(run)

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special strings, normalised, and the special strings themselves."""
        at = 0
        for found in self.special.finditer(text):
            yield self.normalised(text[at : found.start()]), False
            yield found.group(), True
            at = found.end()
        yield self.normalised(text[at:]), False


class PrefixCounter(TextRules):
    """Prefix tables for the tokenizer in a file."""

    def learn(self, settings: dict) -> None:
        model = settings["model"]
        self.end = model["end_of_word_suffix"]
        ranks = {tuple(pair): at for at, pair in enumerate(model["merges"])}
        self.neighbours = Neighbours(lambda a, b: ranks.get((a, b), NEVER), self._symbols)
        self.tokens = list(model["vocab"])
        # beginnings of tokens that no token ends with are -1; tokens that merging never makes are left out
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for number, token in enumerate(self.tokens):
            if not self.neighbours.whole(token):
                continue
            if token.endswith(self.end) and len(token) > len(self.end):
                self.final[token[: -len(self.end)]] = number
                continue
            self.inner[token] = number
            for size in range(1, len(token)):
                self.inner.setdefault(token[:size], -1)
        self.longest = max(map(len, self.final))
        self.symbol_of = dict(enumerate(byte_symbols()))
        self.held: Recent[str, int] = Recent(WORDS_HELD)
        self.held_words: Recent[str, int] = Recent(WORDS_HELD)
        self.fits: dict[int, bool] = {}

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _fit(self, left: int, right: int) -> bool:
        """Whether token `right` may follow token `left`."""
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= PAIRS_HELD:
                self.fits.clear()
            found = self.fits[key] = self.neighbours.fit(self.tokens[left], self.tokens[right])
        return found

    def symbols_in(self, word: str) -> str:
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.symbol_of)

    def prefixes(self, symbols: str) -> tuple[list[int], list[int]]:
        """For each prefix of a word's symbols, without an end mark: its last token and its number of tokens."""
        size = len(symbols)
        last, count = [-1] * (size + 1), [0] * (size + 1)
        inner, fits = self.inner, self.fits
        for start in range(size):
            left = last[start]
            for end in range(start + 1, size + 1):
                token = inner.get(symbols[start:end])
                if token is None:
                    break
                if token < 0 or last[end] >= 0:
                    continue
                if start:
                    ok = fits.get(left << 32 | token)
                    if not (self._fit(left, token) if ok is None else ok):
                        continue
                last[end] = token
                count[end] = count[start] + 1
        return last, count

    def ended(self, symbols: str, at: int, last: list[int], count: list[int]) -> int:
        """Tokens of the prefix of `at` symbols when the word ends there."""
        for start in range(max(0, at - self.longest), at):
            token = self.final.get(symbols[start:at])
            if token is not None and (start == 0 or self._fit(last[start], token)):
                return count[start] + 1
        raise ValueError("the vocabulary lacks a byte")

    def word_count(self, word: str) -> int:
        found = self.held_words.get(word)
        if found is None:
            symbols = self.symbols_in(word)
            found = self.ended(symbols, len(symbols), *self.prefixes(symbols))
            if len(word) <= LENGTH_HELD:
                self.held_words.put(word, found)
        return found

    def word_table(self, word: str) -> list[int]:
        """Tokens of each prefix of the word, in code points; entry 0 is the empty prefix."""
        ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in word]).tolist()
        symbols = self.symbols_in(word)
        last, count = self.prefixes(symbols)
        return [0, *(self.ended(symbols, at, last, count) for at in ends)]

    def chunk_table(self, chunk: str) -> list[int]:
        """Tokens of each prefix of a text without white space. The words of a prefix are those of the whole,
        but for the last, which may fall apart when it is cut (a contraction)."""
        table = [0]
        for word in self.words_of(chunk):
            before, counts = table[-1], self.word_table(word)
            if word[0] == "'" and len(word) > 1 and word[1].isalpha():
                for size in range(1, len(word)):
                    counts[size] = sum(self.word_table(w)[-1] for w in self.words_of(word[:size]))
            table.extend(before + c for c in counts[1:])
        return table

    def chunk_count(self, chunk: str) -> int:
        found = self.held.young.get(chunk) or self.held.get(chunk)
        if found is None:
            words = (chunk,) if chunk.isalpha() else self.words_of(chunk)
            found = sum(map(self.word_count, words))
            if len(chunk) <= LENGTH_HELD:
                self.held.put(chunk, found)
        return found

    def count(self, text: str | None) -> int:
        """Tokens of the whole text."""
        return sum(1 if special else self.part_count(part) for part, special in self.parts(text or ""))

    def part_count(self, part: str) -> int:
        """Tokens of a normalised text without special strings."""
        chunks = NOT_SPACE.findall(part) if SEPARATORS.search(part) else part.split()
        return sum(map(self.chunk_count, chunks))

    def table(self, text: str | None) -> tuple[str, np.ndarray]:
        """The normalised text and the tokens of each of its prefixes, entry 0 for the empty one. A special
        string counts as soon as it is complete; before, it counts as the plain text it still is."""
        pieces, counts = [], [np.zeros(1, dtype=np.int64)]
        total = 0
        for part, special in self.parts(text or ""):
            here = np.full(len(part), total, dtype=np.int64)
            at = 0
            for found in NOT_SPACE.finditer(part):
                here[at : found.start()] = total
                chunk = np.array(self.chunk_table(found.group())[1:], dtype=np.int64)
                here[found.start() : found.end()] = total + chunk
                total += int(chunk[-1])
                at = found.end()
            here[at:] = total
            if special:
                total = int(counts[-1][-1]) + 1
                here[-1] = total
            pieces.append(part)
            if len(here):
                counts.append(here)
        return "".join(pieces), np.concatenate(counts)

    def count_and_reach(self, text: str | None, budget: int) -> tuple[int, int]:
        """The tokens of the whole text, and the size of `cut`'s prefix from the tables of the words around its end
        alone."""
        parts = list(self.parts(text or ""))
        total = sum(1 if special else self.part_count(part) for part, special in parts)
        if total <= budget:
            return total, sum(len(part) for part, _ in parts)
        if len(parts) > 1:  # a special string may count as plain text until it is complete
            return total, int(np.flatnonzero(self.table(text)[1] <= budget)[-1])
        used = 0
        for found in NOT_SPACE.finditer(parts[0][0]):
            count = self.chunk_count(found.group())
            if used + count > budget:
                within = self.chunk_table(found.group())
                return total, found.start() + max(i for i, n in enumerate(within) if used + n <= budget)
            used += count
        raise AssertionError("the text has as many tokens as its words")

    def cut(self, text: str | None, budget: int) -> tuple[str, int]:
        """The longest prefix of the normalised text with at most `budget` tokens, and their number."""
        whole, table = self.table(text)
        size = int(np.flatnonzero(table <= budget)[-1])
        return whole[:size], int(table[size])


@cache
def rules(path: str) -> TextRules:
    """One per worker process and tokenizer file."""
    return TextRules(path)


@cache
def counter(path: str) -> PrefixCounter:
    """One per worker process and tokenizer file."""
    return PrefixCounter(path)


def count_tokens(
    docs: DataFrame, path: str | None = None, limit: int = MAX_TOKENS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    return _counted(docs, path, limit, id_col, text_col, False)


def fit_tokens(
    docs: DataFrame, path: str | None = None, limit: int = MAX_TOKENS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As `count_tokens`, and `fits`: the code points of the longest prefix of the normalised text that keeps the
    limit, which is where `truncate` would cut."""
    return _counted(docs, path, limit, id_col, text_col, True)


def _counted(
    docs: DataFrame, path: str | None, limit: int, id_col: str, text_col: str, with_fits: bool
) -> DataFrame:
    path = path or public_tokenizers.path(TOKENIZER)

    @F.pandas_udf("n_tokens long, fits long")
    def counted(texts: pd.Series) -> pd.DataFrame:
        tokens = counter(path)
        if with_fits:
            found = [tokens.count_and_reach(text, limit) for text in texts]
        else:
            found = [(tokens.count(text), 0) for text in texts]
        return pd.DataFrame(found, columns=["n_tokens", "fits"], dtype="int64")

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        counted(text).alias("counted"),
    )
    over = (F.col("counted.n_tokens") > limit).alias("over_limit")
    return rows.select("doc_id", "n_bytes", "counted.n_tokens", over, *(["counted.fits"] if with_fits else []))


def prefix_counts(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, normalised text, and the tokens of each of its prefixes (entry 0: empty)."""
    path = path or public_tokenizers.path(TOKENIZER)

    @F.pandas_udf("text string, counts array<long>")
    def tables(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([counter(path).table(t) for t in texts], columns=["text", "counts"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), tables(F.col(f"`{text_col}`")).alias("table"))
    return rows.select("doc_id", "table.*")


def truncate(
    docs: DataFrame, budget: int, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, the longest prefix of its normalised text within the budget, n_tokens."""
    path = path or public_tokenizers.path(TOKENIZER)

    @F.pandas_udf("text string, n_tokens long")
    def cuts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([counter(path).cut(t, budget) for t in texts], columns=["text", "n_tokens"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), cuts(F.col(f"`{text_col}`")).alias("cut"))
    return rows.select("doc_id", "cut.*")


def query(spark, sf_dir: str) -> DataFrame:
    return fit_tokens(read_table(spark, sf_dir, "documents"))
