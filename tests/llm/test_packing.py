from itertools import combinations

import numpy as np
import public_tokenizers
import pytest

from holdfast.llm import packing as pk
from holdfast.llm.token_counts import TOKENIZER, counter


def brute_padding(lengths, counts, buckets):
    def cost(widths):
        return sum(c * (min(w for w in widths if w >= n) - n) for n, c in zip(lengths, counts, strict=True))

    most = lengths[-1]
    others = lengths[:-1]
    sizes = range(min(buckets - 1, len(others)) + 1)
    return min(cost([*chosen, most]) for size in sizes for chosen in combinations(others, size))


@pytest.mark.parametrize("seed", range(12))
def test_widths_are_the_best(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(0, 60, rng.integers(1, 11)))
    counts = rng.integers(1, 50, len(lengths))
    buckets = int(rng.integers(1, 6))
    widths = pk.best_widths(lengths, counts, buckets)
    assert len(widths) <= buckets and widths == sorted(set(widths)) and widths[-1] == lengths[-1]
    padding = sum(c * (min(w for w in widths if w >= n) - n) for n, c in zip(lengths, counts, strict=True))
    assert padding == brute_padding(lengths.tolist(), counts.tolist(), buckets)


@pytest.mark.parametrize("text", ["", None, "one", " a  b c\nd e f g ", "w " * 23, "\n\n", "x" * 50])
def test_pieces_cover_the_text(text):
    spans = pk.cut(text, 5)
    whole = text or ""
    assert "".join(whole[s:e] for s, e, _ in spans) == whole
    assert [len(whole[s:e].split()) for s, e, _ in spans] == [n for _, _, n in spans]
    assert all(n == 5 for _, _, n in spans[:-1]) and spans[-1][2] <= 5


LONG = "".join(f"{i * i * 7919:x}aZ/" for i in range(12_000))
CHINESE = "\u4f60\u662f\u767d\u75f4\u4eba" * 3_000


@pytest.mark.parametrize("max_tokens", [5, 64, 2_048])
@pytest.mark.parametrize(
    "text",
    ["", None, "one", "Unbelievably, it's 1234 words!  " * 400, LONG[:9_000], f"a b {LONG[:9_000]} c", CHINESE[:4_000],
     "a<|endoftext|>b " * 900, "e\u0301" * 3_000, "\n\n", "\U0001f9ff\ud800" * 500, "\u0130\u03a3 " * 800],
)
def test_pieces_by_tokens(text, max_tokens):
    tokens = counter(public_tokenizers.path(TOKENIZER))
    spans = pk.cut_tokens(text, max_tokens, tokens)
    whole = text or ""
    assert "".join(whole[s:e] for s, e, _ in spans) == whole
    assert [tokens.count(whole[s:e]) for s, e, _ in spans] == [n for _, _, n in spans]
    assert all(n <= max_tokens or e - s == 1 for s, e, n in spans)
    assert max_tokens < 64 or all(n >= 0.8 * max_tokens for _, _, n in spans[:-1])  # no needless pieces


ODD = ["", None, "one", " lead and trail \n", "a\u00a0b\u2003c\x85d " * 900, "a\x1cb\x1fc " * 900, "a<|endoftext|>b " * 900,
       LONG[:9_000], f"a b {LONG[:9_000]} c", CHINESE[:4_000], "e\u0301 \u0301x" * 3_000, "\u0130\u03a3 A\u03a3 " * 800,
       "Unbelievably, it's 1234 words!  " * 400, "\U0001f9ff \u3000" * 2_000, "w " * 4_096, "\n\n", "\ufeff \u200b zz " * 900]


@pytest.mark.parametrize("max_tokens", [5, 64, 2_048])
def test_a_batch_is_cut_like_each_text(max_tokens):
    tokens = counter(public_tokenizers.path(TOKENIZER))
    assert pk.cut_batch(ODD, max_tokens, tokens) == [pk.cut_tokens(t, max_tokens, tokens) for t in ODD]
    assert pk.cut_batch([], max_tokens, tokens) == []


def test_long_texts_without_spaces_keep_the_budget(spark):
    rows = [(1, LONG), (2, CHINESE), (3, "a few words"), (4, "unbelievably 1234567 " * 300)]
    found = pk.pack(spark.createDataFrame(rows, "doc_id long, text string"), batch_tokens=8_192).collect()
    assert all(r["n_tokens"] <= r["width"] <= pk.MAX_TOKENS for r in found)
    assert {i: sum(r["doc_id"] == i for r in found) > 1 for i in range(1, 5)} == {1: True, 2: True, 3: False, 4: True}
    held = {}
    for r in found:
        held[r["bucket"], r["batch"]] = held.get((r["bucket"], r["batch"]), 0) + r["width"]
    assert max(held.values()) <= 8_192


def test_batches(spark):
    rows = [(i % 90, "w " * (i * 7 % 40)) for i in range(900)] + [(None, None), (1, "")]
    df = spark.createDataFrame([(i, t, 0, "b") for i, t in rows], "doc_id long, text string, bucket int, batch string")
    found = pk.pack(df.repartition(5), max_tokens=16, buckets=4, batch_tokens=64).collect()
    assert sum(r["n_tokens"] for r in found) == sum(len((t or "").split()) for _, t in rows)
    assert sum(r["piece"] == 0 for r in found) == len(rows)
    batches = {}
    for r in found:
        assert r["padding"] == r["width"] - r["n_tokens"] >= 0
        batches.setdefault((r["bucket"], r["batch"]), []).append(r["width"])
    for (bucket, batch), widths in batches.items():
        capacity = 64 // max(widths[0], 1)
        assert len(set(widths)) == 1 and len(widths) <= capacity
        last = max(b for k, b in batches if k == bucket)
        assert batch == last or len(widths) == capacity  # only a bucket's last batch has room left


def test_batches_run_on_over_shards(spark, monkeypatch):
    monkeypatch.setattr(pk, "ROWS_PER_SHARD", 7)
    df = spark.createDataFrame([(1, "a b c")] * 100, "doc_id long, text string")
    found = pk.pack(df, batch_tokens=30).collect()
    sizes = {}
    for r in found:
        sizes[r["batch"]] = sizes.get(r["batch"], 0) + 1
    assert sizes == {b: 10 for b in range(10)}


def test_empty_table(spark):
    assert pk.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
