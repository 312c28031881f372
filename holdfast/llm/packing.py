"""Packing into length buckets with the least padding.

Documents longer than `max_tokens` are cut into pieces of that many tokens at most, between words, and inside a
word that is longer than a piece, so nothing is dropped and the histogram of piece lengths has `max_tokens` + 1
entries at most. Dynamic programming over that global
histogram chooses the bucket widths for which padding every piece up to its bucket's width costs least.
Inside a bucket, pieces are numbered and cut into batches of as many rows as the token budget allows.

The numbering is spread over shards of about `ROWS_PER_SHARD` rows, each starting where the one before it
ends, so that a bucket with a third of all rows is no task of its own, and only the last batch of a bucket
can have room left.

Tokens are those of the tokenizer, each piece counted as a text of its own. Nulls and edges: a null or empty text is one piece without tokens; a
null identifier is carried through; repeated rows are packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.bpe import Recent
from holdfast.llm.common import read_table, release_memory, staged
from holdfast.llm.token_counts import NOT_SPACE, TOKENIZER, PrefixCounter, TextRules, counter, rules
from holdfast.llm.word_merge import WordMerger

MAX_TOKENS = 2_048
BUCKETS = 16
BATCH_TOKENS = 65_536
ROWS_PER_SHARD = 20_000
# Of a text with more than so many code points for each token of a piece, the whole is not counted first.
WELL_OVER = 3
# Code points whose words are taken apart together.
CHARS_AT_ONCE = 3_000_000
# Sizes of the memory of words; others are counted again.
WORDS_HELD, LENGTH_HELD = 200_000, 48
WORD = re.compile(r"\S+")
# White space beyond ASCII, and the ASCII characters that separate words.
OTHER_SPACE = "[" + "".join(c for c in map(chr, range(0x80, 0x3001)) if not NOT_SPACE.match(c)) + "]"
SPACE_UNITS = np.isin(np.arange(256), np.frombuffer(b"\t\n\v\f\r ", dtype=np.uint8))


def cut(text: str | None, max_tokens: int) -> list[tuple[int, int, int]]:
    """(start, end, words) of each piece when words count as tokens, in code points; together they cover the text."""
    text = text or ""
    if len(text) < 2 * max_tokens or len(text.split(None, max_tokens)) <= max_tokens:
        return [(0, len(text), len(text.split()))]
    starts, tokens = [0], 0
    for tokens, word in enumerate(WORD.finditer(text)):
        if tokens and tokens % max_tokens == 0:
            starts.append(word.start())
    ends = [*starts[1:], len(text)]
    last = tokens + 1 - max_tokens * (len(starts) - 1)
    sizes = [max_tokens] * (len(starts) - 1) + [last]
    return list(zip(starts, ends, sizes, strict=True))


def fitting(text: str, start: int, end: int, room: int, tokens: PrefixCounter) -> tuple[int, int]:
    """(stop, tokens) of a beginning of text[start:end] with at most `room` tokens, nearly as many if there is more;
    stop is `start` if not even one code point fits."""
    low, held, high = start, 0, end + 1  # text[start:low] fits, text[start:high] does not or goes too far
    guess = start + max(1, room)
    while high - low > 1:
        at = min(max(guess, low + 1), high - 1)
        count = tokens.count(text[start:at])
        if count <= room:
            low, held = at, count
            if at == end or room - count <= room // 64:
                break
        else:
            high = at
        guess = start + (at - start) * room // max(count, 1)
        if not low < guess < high:
            guess = (low + high) // 2 if high <= end else 2 * at - start
    return low, held


def cut_tokens(text: str | None, max_tokens: int, tokens: PrefixCounter) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of each piece, in code points; together they cover the text."""
    text = text or ""
    if len(text) <= WELL_OVER * max_tokens:
        total = tokens.count(text)
        if total <= max_tokens:
            return [(0, len(text), total)]
    # tokens never reach over white space, so that those of a piece are the sum over its words
    plain = not tokens.special.search(text)
    count_of = (lambda word: tokens.chunk_count(tokens.normalised(word))) if plain else tokens.count
    found, start, used = [], 0, 0
    for word in NOT_SPACE.finditer(text):
        at, end = word.span()
        if end - at <= max_tokens:
            count = count_of(word.group())
            if count <= max_tokens:
                if used + count > max_tokens:
                    found.append((start, at, used))
                    start, used = at, 0
                used += count
                continue
        while at < end:
            stop, count = fitting(text, at, end, max_tokens - used, tokens)
            if stop == at and not used:
                stop, count = at + 1, tokens.count(text[at])  # a code point of more tokens than a piece may have
            at, used = stop, used + count
            if at < end:
                found.append((start, at, used))
                start, used = at, 0
    return [*found, (start, len(text), used)]


def word_starts(text: str) -> np.ndarray:
    """The places, in code points, at which the words of a text begin; ASCII white space separates them."""
    units = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    space = SPACE_UNITS[units]
    begins = ~space
    begins[1:] &= space[:-1]
    return (np.cumsum((units & 0xC0) != 0x80) - 1)[begins]


def chunk_counts(chunks: list[str], tokens: TextRules) -> np.ndarray:
    """Tokens of different texts without white space. Words not counted of late are merged together."""
    normalised = tokens.normalised(" ".join(chunks)).split(" ") if chunks else []
    apart = [(chunk,) if chunk.isalpha() else tokens.words_of(chunk) for chunk in normalised]
    merging, held = merger(tokens.path)
    known = {}
    new = []
    for word in {word for words in apart for word in words}:
        count = held.get(word)
        if count is None:
            new.append(word)
        else:
            known[word] = count
    for word, count in zip(new, merging.counts(new).tolist(), strict=True):
        known[word] = count = counter(tokens.path).word_count(word) if count < 0 else count
        if len(word) <= LENGTH_HELD:
            held.put(word, count)
    return np.array([known[w[0]] if len(w) == 1 else sum(map(known.__getitem__, w)) for w in apart], dtype=np.int64)


@cache
def merger(path: str) -> tuple[WordMerger, Recent[str, int]]:
    """One per worker process and tokenizer file, with a memory of words counted of late."""
    return WordMerger(path), Recent(WORDS_HELD)


def parts_of(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """The texts in parts of a bounded size, or of one text: what is held at once follows from it."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def cut_batch(texts: Iterable[str | None], max_tokens: int, tokens: TextRules) -> list[list[tuple[int, int, int]]]:
    """`cut_tokens` of many texts. Their words are taken apart and numbered together, each different word is counted
    once, and pieces end where running sums go beyond a multiple. Texts with special strings, or with a word over
    a piece, go the other way."""
    texts = [text or "" for text in texts]
    held = pa.array(texts, pa.large_string())
    other = pc.match_substring_regex(held, OTHER_SPACE)
    spaced = pc.if_else(other, pc.replace_substring_regex(held, OTHER_SPACE, " "), held) if pc.any(other).as_py() else held
    apart = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(spaced))
    ends = apart.offsets.to_numpy()
    numbered = apart.values.dictionary_encode()
    words = numbered.dictionary.to_pylist()
    counts = chunk_counts(words, tokens)
    over = (counts > max_tokens) | (np.array(list(map(len, words)), dtype=np.int64) > max_tokens)
    of_word = numbered.indices.to_numpy()
    sums = np.concatenate([[0], np.cumsum(counts[of_word])])
    overs = np.concatenate([[0], np.cumsum(over[of_word])])
    special = pc.match_substring_regex(held, tokens.special.pattern).to_numpy(zero_copy_only=False)
    found = []
    for at, text in enumerate(texts):
        first, last = ends[at], ends[at + 1]
        if special[at] or overs[last] > overs[first]:
            found.append(cut_tokens(text, max_tokens, counter(tokens.path)))
            continue
        total = int(sums[last] - sums[first])
        if total <= max_tokens:
            found.append([(0, len(text), total)])
            continue
        cuts = [first]
        while sums[last] - sums[cuts[-1]] > max_tokens:
            cuts.append(np.searchsorted(sums, sums[cuts[-1]] + max_tokens, side="right") - 1)
        places = word_starts(spaced[at].as_py())[np.array(cuts) - first].tolist()
        sizes = np.diff(sums[[*cuts, last]]).tolist()
        found.append(list(zip([0, *places[1:]], [*places[1:], len(text)], sizes, strict=True)))
    return found


def pieces(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """A row per piece: doc_id, number (of the row), piece, start, end, n_tokens."""
    path = path or public_tokenizers.path(TOKENIZER)

    @F.pandas_udf("array<struct<start: long, end: long, n_tokens: long>>")
    def spans(texts: pd.Series) -> pd.Series:
        tokens = rules(path)
        cuts = [spans for part in parts_of(texts) for spans in cut_batch(part, max_tokens, tokens)]
        release_memory()
        return pd.Series([[{"start": s, "end": e, "n_tokens": n} for s, e, n in one] for one in cuts])

    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.monotonically_increasing_id().alias("number"),
        spans(F.col(f"`{text_col}`")).alias("spans"),
    )
    return rows.select("doc_id", "number", F.posexplode("spans").alias("piece", "span")).select(
        "doc_id", "number", "piece", "span.*"
    )


def best_widths(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Widths of at most `buckets` buckets with the least total padding; `lengths` ascending and distinct."""
    size = len(lengths)
    if not size:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.int64)
    # padding[i, j]: of lengths i..j in one bucket of width lengths[j]
    padding = lengths[None, :] * (rows[None, 1:] - rows[:-1, None]) - (tokens[None, 1:] - tokens[:-1, None])
    never = np.iinfo(np.int64).max // 4
    padding = np.where(np.arange(size)[:, None] <= np.arange(size)[None, :], padding, never)
    least, cuts = padding[0], []
    for _ in range(min(buckets, size) - 1):
        before = np.concatenate([[0], least[:-1]])
        total = before[:, None] + padding
        cuts.append(total.argmin(axis=0))
        least = total.min(axis=0)
    widths, at = [], size - 1
    for start_of in reversed(cuts):
        widths.append(int(lengths[at]))
        at = int(start_of[at]) - 1
        if at < 0:
            break
    else:
        widths.append(int(lengths[at]))
    return sorted(widths)


def pack(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, end, n_tokens, bucket, width, batch, padding."""
    rows = staged(pieces(docs, max_tokens, id_col, text_col, path))
    histogram = rows.groupBy("n_tokens").count().orderBy("n_tokens").collect()  # max_tokens + 1 rows at most
    lengths = np.array([r["n_tokens"] for r in histogram], dtype=np.int64)
    counts = np.array([r["count"] for r in histogram], dtype=np.int64)
    widths = best_widths(lengths, counts, buckets) or [0]
    bucket_of = np.searchsorted(widths, lengths)
    held = [int(counts[bucket_of == b].sum()) for b in range(len(widths))]
    shards = [max(1, -(-n // ROWS_PER_SHARD)) for n in held]
    capacity = [max(1, batch_tokens // max(w, 1)) for w in widths]

    def of_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("bucket") + 1)

    wide_enough = F.filter(F.array(*[F.lit(w).cast("long") for w in widths]), lambda w: w < F.col("n_tokens"))
    placed = rows.withColumn("bucket", F.size(wide_enough))
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("number", "piece"), of_bucket(shards)))
    in_shard = Window.partitionBy("bucket", "shard").orderBy("number", "piece")
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket", "shard").count()
    starts = starts.select("bucket", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    numbered = placed.withColumn("place", F.row_number().over(in_shard) - 1).join(starts, ["bucket", "shard"])
    return numbered.select(
        "doc_id",
        "piece",
        "start",
        "end",
        "n_tokens",
        "bucket",
        of_bucket(widths).alias("width"),
        F.floor((F.col("first") + F.col("place")) / of_bucket(capacity)).alias("batch"),
        (of_bucket(widths) - F.col("n_tokens")).alias("padding"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
