import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from holdfast.llm import merkle as mk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, position int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree_of(nodes):
    """The root, and each node's siblings level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 16]) for i in range(0, len(last), 16)])
    paths = []
    for at in range(len(nodes)):
        path, place = [], at
        for level in levels[:-1]:
            first = place // 16 * 16
            path.append((level[first:place], level[place + 1 : first + 16]))
            place //= 16
        paths.append(path)
    return levels[-1][0], paths


def climb(node, path):
    for before, after in path:
        node = h(*before, node, *after)
    return node


def brute(rows):
    trees = defaultdict(list)
    for row in rows:
        doc_id, text, lang, source, n_chars = row[:5]
        forged = None
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            forged = leaf_of(doc_id, lowered(text), lang, source, n_chars)
        trees["" if source is None else f"={source}"].append((doc_id, leaf_of(*row[:5]), forged))
    names = sorted(trees, key=lambda n: n.encode())
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    built = {name: tree_of([r[1] for r in trees[name]]) for name in names}
    root, tops = tree_of([built[name][0] for name in names])
    out = []
    for name, top in zip(names, tops, strict=True):
        subroot, paths = built[name]
        for (doc_id, leaf, forged), path in zip(trees[name], paths, strict=True):
            whole = path + top
            proof = h(*[node for before, after in whole for node in before + after])
            reached = climb(forged or leaf, whole)
            out.append((doc_id, leaf, subroot, root, proof, reached, reached == root))
    return sorted(out, key=repr)


def rows_of(sizes, text="Some Text {}"):
    """Documents of the sources in `sizes`, with identifiers that go round the sources."""
    rows, at = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((at * 7919 % 100_003, text.format(at), "en" if at % 3 else None, source, at, "x", 1))
            at += 1
    return rows


def found(df, **kwargs):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, mk.audited(df, **kwargs).select(*names).collect()), key=repr)


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 4_095, 4_096, 4_097])
def test_appending_gives_every_witness(size):
    nodes = [h(str(i)) for i in range(size)]
    root, paths = tree_of(nodes)
    appended = mk.Appended()
    partial = [appended.append(node) for node in nodes]
    assert appended.finish(None) == root
    for at in {0, 1, size // 2, size - 2, size - 1} & set(range(size)):
        witness, places = partial[at].siblings()
        assert witness == ["".join(before + after) for before, after in paths[at]]
        assert mk.folded(nodes[at], witness, places) == root
        assert not witness or mk.folded(h("forged"), witness, places) != root


def test_a_block_beside_others_goes_through_all_its_levels():
    appended = mk.Appended()
    witness = appended.append(h("a"))
    assert appended.finish(mk.BLOCK_LEVELS) == h(h(h(h("a"))))
    assert witness.siblings() == (["", "", ""], [0, 0, 0])


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {None: 1, "": 1}, {"a": 3, None: 17, "": 40, "é": 2, "Z": 1}, {f"s{i}": 1 + i % 3 for i in range(300)},
     {"hot": 1_500, "a": 700}],
)
def test_against_plain_python(spark, sizes):
    rows = rows_of(sizes)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_trees_of_many_blocks(spark):
    rows = rows_of({"hot": 5_000, "b": 16, "c": 17, "d": 257} | {f"s{i}": 2 for i in range(40)})
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(7), block_levels=1) == brute(rows)


def test_edge_rows(spark):
    rows = [(i, t, lang, s, n, "x", 1) for i, t, lang, s, n in [
        (None, None, None, None, None), (None, "A", "en", None, 1), (5, "", "", "", 0), (5, "", "", "", 0),
        (5, "Ab", "en", "", 2), (9, None, None, "x", None), (9, "ÀÉ Z\U0001f600", "fr", "x", 4), (-3, "m" * 200_000, "en", "x", 1),
    ]]
    rows += [(10, "Same Row", "en", "x", 8, "x", 1)] * 40
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_tampered_rows_do_not_verify(spark):
    rows = rows_of({"a": 400})
    df = spark.createDataFrame(rows, SCHEMA)
    changed = [r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert changed and sorted(r[0] for r in mk.audited(df).where("not verified").collect()) == sorted(changed)


def test_the_manifest_proves_every_row(spark):
    rows = rows_of({"a": 30, "b": 300, None: 1})
    for r in mk.manifest(spark.createDataFrame(rows, SCHEMA)).collect():
        assert mk.folded(r["leaf"], r["witness"], r["places"]) == r["root"]


def test_empty_table(spark):
    assert mk.audited(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mk.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
