import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from holdfast.llm import simhash_dedup as sh
from holdfast.llm.components import components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable, by fingerprint."""
    parent = {f: f for f in prints.values()}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    keys = list(parent)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(b)] = root(a)
    smallest = {}
    for doc_id, f in prints.items():
        smallest[root(f)] = min(doc_id, smallest.get(root(f), doc_id))
    return {doc_id: smallest[root(f)] for doc_id, f in prints.items()}


def test_fingerprints(spark):
    rng = random.Random(1)
    texts = ["", None, " \t ", "One", "one TWO", "É é É", "a\x0bb\x0cc d", "x\x1cy\xa0z", "a b c " * 30]
    texts += [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(40))) for _ in range(100)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["fp"] % (1 << 64) for r in df.select("doc_id", sh.fingerprint_column(F.col("text")).alias("fp")).collect()}
    assert found == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_very_long_text(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(5000))
    whole = sh.fingerprint(text)
    monkeypatch.setattr(sh, "HASHES_AT_ONCE", 64)
    assert sh.fingerprint(text) == whole == plain_fingerprint(text)


def test_same_hash_as_sql(spark):
    df = spark.createDataFrame([("some words here",)], "text string")
    assert df.select(F.xxhash64("text")).first()[0] % (1 << 64) == xxhash.xxh64_intdigest("some words here", 42)


def dense_prints(seed, centres=30, near=25):
    """Fingerprints in clusters a few bits wide."""
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(near):
            f = centre
            for _ in range(rng.randrange(5)):
                f ^= 1 << rng.randrange(64)
            out.add(f)
    return list(out)


def linked(spark, prints, crowded):
    df = spark.createDataFrame([(sh.signed(f),) for f in prints], "fp long")
    return {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in sh.close_pairs(df, crowded).collect()}


def test_links_reach_what_brute_force_reaches(spark):
    prints = dense_prints(3)
    expected = brute_components(dict(enumerate(prints)))
    for crowded in (64, 1, 3):
        links = linked(spark, prints, crowded)
        assert all((a ^ b).bit_count() <= 2 for a, b in links)
        place = {f: i for i, f in enumerate(prints)}
        rows = [tuple(sorted((place[a], place[b]))) for a, b in links]
        roots = components(spark.createDataFrame(rows, "a long, b long")).collect()
        found = {i: i for i in expected} | {r["node"]: r["root"] for r in roots}
        assert found == expected


def test_no_link_is_lost_where_cells_are_few(spark):
    prints = dense_prints(5, 10, 12)
    expected = {(a, b) for a in prints for b in prints if sh.signed(a) < sh.signed(b) and (a ^ b).bit_count() <= 2}
    assert linked(spark, prints, 10_000) == expected


def test_lower_bound():
    rng = np.random.default_rng(0)
    for a, b in rng.integers(0, 1 << 62, (200, 2)).tolist():
        pairs = [((a >> i & 3).bit_count(), (b >> i & 3).bit_count()) for i in range(0, 64, 2)]
        assert sum(abs(x - y) for x, y in pairs) <= (a ^ b).bit_count()


ROWS = [(8, "one two three four", "z"), (3, "ONE two\tthree four", "y"), (None, "one two three four", "x"), (5, "", "w"), (4, None, "v"),
        (4, None, "v"), (None, "only here, and nowhere else", "u")]


def test_edge_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, fp string")
    found = sorted(((r["doc_id"], r["component_id"], r["fingerprint"]) for r in sh.near_groups(df).collect()), key=repr)
    zero = "0" * 16
    same = f"{plain_fingerprint('one two three four'):016x}"
    alone = f"{plain_fingerprint('only here, and nowhere else'):016x}"
    assert found == sorted(
        [(8, 3, same), (3, 3, same), (None, 3, same), (5, 4, zero), (4, 4, zero), (4, 4, zero), (None, None, alone)], key=repr
    )
    kept = sh.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [3, 4, None]
    assert sh.near_groups(df.limit(0)).count() == 0
    assert sh.keep_one_of_each(df.limit(0)).count() == 0


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_query_like_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = brute_components({d["doc_id"]: plain_fingerprint(d["text"]) for d in docs})
    found = sh.query(spark, sf_dir).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected and len(found) == len(docs)
