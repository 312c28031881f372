"""Merkle manifest of a table, with a proof for every row, by incremental witnesses.

Every row is a leaf. The leaves of a source, in the order of their identifiers, form a tree of `ARITY` children a
node, and the roots of the sources, in the order of their names, form the tree above. A leaf's witness is the list
of its siblings from the bottom up: with it the root follows from the leaf alone.

A tree is built by appending. Each level has one open run of siblings; an appended leaf joins the lowest one. A
witness points into that run, so the leaf starts with the siblings that came before, and each sibling that is
completed later extends the witnesses of all who share the run. A full run is closed: its hash is appended to
the run a level above, on which the witnesses go on.

Leaves are dealt out in blocks of `ARITY` to the power of `BLOCK_LEVELS` places, which are aligned with the tree, so that a task can append a
block by itself, in order, holding no more than that block. The roots of the blocks are appended to a tree of
their own in the same way, in blocks again, until each source has one root, and so are the sources' roots. A
second pass over the leaves completes the witness inside a block with the witness of the block's root. It
travels once per block, at the head of its rows, never with every row.

Nulls and edges: a null field counts as `-`, an empty one as `0:`; a null source is a source of its own, before all
others; null identifiers come first within their source; repeated rows are leaves each, next to each other, and
rows that share an identifier are ordered by their hash; extra columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import read_table, shuffle_width, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16
# The levels of a block; it has ARITY**BLOCK_LEVELS places.
BLOCK_LEVELS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROOT_COLUMNS = "tree string, position long, node string, size long"
WITNESS_COLUMNS = "tree string, position long, root string, witness array<string>, places array<int>"


def digest(nodes: Iterable[str]) -> str:
    return sha256("".join(nodes).encode("ascii")).hexdigest()


class Run:
    """Consecutive siblings. Grows while it is open; closed, it stands in the run a level above."""

    __slots__ = ("nodes", "above", "place", "_rest")

    def __init__(self) -> None:
        self.nodes: list[str] = []
        self.above: Run | None = None  # none above a run that holds nothing but the tree's root
        self.place = 0
        self._rest: tuple[list[str], list[int]] | None = None

    def others(self, place: int) -> str:
        return "".join(self.nodes[:place] + self.nodes[place + 1 :])

    def siblings(self, place: int) -> tuple[list[str], list[int]]:
        """The witness of a node of the run: the siblings and the place among them, bottom up."""
        if self.above is None:
            return [], []
        if self._rest is None:
            self._rest = self.above.siblings(self.place)
        witness, places = self._rest
        return [self.others(place), *witness], [place, *places]


@dataclass(frozen=True, slots=True)
class Witness:
    """Where a leaf stands. Partial while the runs above it are open."""

    run: Run
    place: int

    def siblings(self) -> tuple[list[str], list[int]]:
        return self.run.siblings(self.place)


class Appended:
    """A tree that leaves are appended to; only its open runs are held, and what witnesses point to."""

    def __init__(self) -> None:
        self.open: list[Run] = [Run()]

    def _close(self, level: int) -> str:
        run = self.open[level]
        if level + 1 == len(self.open):
            self.open.append(Run())
        node = digest(run.nodes)
        run.above, run.place = self._append(level + 1, node)
        self.open[level] = Run()
        return node

    def _append(self, level: int, node: str) -> tuple[Run, int]:
        if len(self.open[level].nodes) == ARITY:
            self._close(level)
        run = self.open[level]
        run.nodes.append(node)
        return run, len(run.nodes) - 1

    def append(self, leaf: str) -> Witness:
        return Witness(*self._append(0, leaf))

    def finish(self, levels: int | None) -> str:
        """Close what is open: through `levels` levels, or until one node remains. Returns that node."""
        level = 0
        while level < levels if levels is not None else self._goes_on(level):
            self._close(level)
            level += 1
        return self.open[level].nodes[0]

    def _goes_on(self, level: int) -> bool:
        return level + 1 < len(self.open) or len(self.open[level].nodes) > 1


def folded(leaf: str, witness: Iterable[str], places: Iterable[int]) -> str:
    """The root that follows from a leaf and its siblings; a level without siblings hashes the node alone."""
    node, width = leaf, len(leaf)
    for others, place in zip(witness, places, strict=True):
        node = digest((others[: place * width], node, others[place * width :]))
    return node


def levels_of(size: int, block_levels: int) -> int | None:
    """The levels of a block of a tree with `size` leaves: all of them if there are other blocks beside it."""
    return block_levels if size > ARITY**block_levels else None


def field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hashed(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(columns[name]) for name in columns]), 256)


def leaves(docs: DataFrame, names: Iterable[str] = FIELDS, id_col: str = "doc_id", tree_col: str = "source",
           text_col: str = "text") -> DataFrame:
    """(id, tree, number, node, forged): each row's hash, and the hash after tampering where there is some."""
    columns = {name: F.col(f"`{name}`") for name in names}
    identifier, tree = F.col(f"`{id_col}`"), F.col(f"`{tree_col}`").cast("string")
    tampered = F.crc32(identifier.cast("string")) % 5 == 0
    lowered = columns | {text_col: F.translate(F.col(f"`{text_col}`"), UPPER, LOWER)}
    return docs.select(
        identifier.alias("id"),
        F.coalesce(F.concat(F.lit("="), tree), F.lit("")).alias("tree"),
        F.monotonically_increasing_id().alias("number"),
        hashed(columns).alias("node"),
        F.when(tampered, hashed(lowered)).alias("forged"),
    )


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add `position`, the place of a row in its tree by `order`, and `size`, the number of rows of the tree.

    The rows are sorted over all tasks; the start of each task's part of a tree follows from a table of one row
    per task and tree.
    """
    in_order = staged(rows.orderBy("tree", *order).withColumn("at", F.monotonically_increasing_id()))
    # the upper bits of `at` are the task that sorted the row
    in_order = in_order.withColumn("task", F.shiftright("at", 33))
    parts = in_order.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("held"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "tree",
        "task",
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("start"),
        F.sum("held").over(tree).alias("size"),
    )
    found = in_order.join(staged(starts), ["tree", "task"]).withColumn("position", F.col("start") + F.col("at"))
    return found.drop("task", "at", "start")


def block_of(position: Column, block_levels: int) -> Column:
    return F.floor(position / ARITY**block_levels)


def by_block(rows: DataFrame) -> DataFrame:
    """The rows of each block in one task, in order; blocks are of bounded size."""
    return rows.repartition(shuffle_width(rows.sparkSession), "tree", "block").sortWithinPartitions(
        "tree", "block", "position"
    )


def rows_by_block(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """The rows of one block after the other: (tree, block, ...names)."""
    now: tuple | None = None
    held: list[tuple] = []
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(name)).to_pylist() for name in ["tree", "block", *names]]
        for row in zip(*columns, strict=True):
            if row[:2] != now:
                if held:
                    yield held
                now, held = row[:2], []
            held.append(row)
    if held:
        yield held


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def block_roots(nodes: DataFrame, block_levels: int) -> DataFrame:
    """One row per block, as nodes of the tree above: tree, position, node, size."""
    schema = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("node", pa.string()), ("size", pa.int64())])
    block = ARITY**block_levels

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_by_block(batches, ["node", "size"]):
            tree, place, _, size = rows[0]
            appended = Appended()
            for row in rows:
                appended.append(row[2])
            yield table_of([(tree, place, appended.finish(levels_of(size, block_levels)), -(-size // block))], schema)

    dealt = nodes.select("tree", "position", "node", "size", block_of(F.col("position"), block_levels).alias("block"))
    return by_block(dealt).mapInArrow(roots, ROOT_COLUMNS)


def headed(nodes: DataFrame, upper: DataFrame, block_levels: int) -> DataFrame:
    """The rows of every block behind one row that holds the witness of the block's root."""
    dealt = nodes.withColumn("block", block_of(F.col("position"), block_levels))
    heads = upper.withColumnRenamed("position", "block").withColumn("position", F.lit(-1).cast("long"))
    return by_block(heads.unionByName(dealt, allowMissingColumns=True))


def witnessed(nodes: DataFrame, block_levels: int) -> DataFrame:
    """(tree, position, root, witness, places) per node (tree, position, node, size): the root of its tree, and the
    siblings on the way there, bottom up."""
    upper = above(staged(block_roots(nodes, block_levels)), block_levels)
    schema = pa.schema(
        [("tree", pa.string()), ("position", pa.int64()), ("root", pa.string()),
         ("witness", pa.list_(pa.string())), ("places", pa.list_(pa.int32()))]
    )

    def witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (head, *rows) in rows_by_block(batches, ["position", "node", "size", "root", "witness", "places"]):
            tree, _, _, _, _, root, rest, rest_places = head
            appended = Appended()
            partial = [appended.append(row[3]) for row in rows]
            appended.finish(levels_of(rows[0][4], block_levels))
            found = []
            for row, witness in zip(rows, partial, strict=True):
                siblings, places = witness.siblings()
                found.append((tree, row[2], root, siblings + rest, places + rest_places))
            yield table_of(found, schema)

    dealt = headed(nodes.select("tree", "position", "node", "size"), upper, block_levels)
    return dealt.mapInArrow(witnesses, WITNESS_COLUMNS)


def above(blocks: DataFrame, block_levels: int) -> DataFrame:
    """The witnesses of block roots in their trees. Trees of one block are complete."""
    alone = blocks.where("size = 1").select(
        "tree", "position", F.col("node").alias("root"),
        F.array().cast("array<string>").alias("witness"), F.array().cast("array<int>").alias("places"),
    )
    others = blocks.where("size > 1")
    if others.isEmpty():
        return alone
    return alone.unionByName(staged(witnessed(others, block_levels)))


def manifest(
    docs: DataFrame,
    names: Iterable[str] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "source",
    text_col: str = "text",
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of `docs`: id, leaf, position (in its source), n_leaves (of its source), subroot, root, witness
    (the siblings of each level), places (the node's place among them), and forged, the leaf's hash after tampering."""
    nodes, upper = built(leaves(docs, names, id_col, tree_col, text_col), block_levels)
    fields = [("id", None), ("leaf", pa.string()), ("position", pa.int64()), ("n_leaves", pa.int64()),
              ("subroot", pa.string()), ("root", pa.string()), ("witness", pa.list_(pa.string())),
              ("places", pa.list_(pa.int32())), ("forged", pa.string())]

    def row_of(row, witness, places, subroot, root):
        return row.id, row.leaf, row.position, row.size, subroot, root, witness, places, row.forged

    return leaf_rows(nodes, upper, block_levels, fields, row_of)


@dataclass(frozen=True, slots=True)
class Leaf:
    id: object
    position: int
    size: int
    leaf: str
    forged: str | None


RowOf = Callable[[Leaf, list[str], list[int], str, str], tuple]


def built(hashes: DataFrame, block_levels: int) -> tuple[DataFrame, DataFrame]:
    """The placed leaves, and per block of leaves the rest of its witnesses, through the source to the root."""
    nodes = staged(placed(staged(hashes), ["id", "node", "number"]))
    upper = above(staged(block_roots(nodes, block_levels)), block_levels)
    subroots = upper.where("position = 0").select("tree", F.col("root").alias("node"))
    sources = staged(placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node"), ["name"]))
    tops = sources.join(staged(witnessed(sources, block_levels)), ["tree", "position"])
    tops = tops.select(
        F.col("name").alias("tree"),
        F.col("root").alias("top"),
        F.col("witness").alias("top_witness"),
        F.col("places").alias("top_places"),
    )
    joined = upper.join(tops, "tree").select(
        "tree",
        "position",
        F.col("root").alias("subroot"),
        F.col("top").alias("root"),
        F.concat("witness", "top_witness").alias("witness"),
        F.concat("places", "top_places").alias("places"),
    )
    return nodes, joined


def leaf_rows(nodes: DataFrame, upper: DataFrame, block_levels: int, fields: list[tuple], row_of: RowOf) -> DataFrame:
    """A row for every leaf: `row_of` (leaf, witness, places, subroot, root) gives the values of `fields`."""
    id_type = nodes.schema["id"].dataType.simpleString()
    names = ["id", "position", "size", "node", "forged", "subroot", "root", "witness", "places"]
    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean",
             pa.list_(pa.string()): "array<string>", pa.list_(pa.int32()): "array<int>"}
    columns = ", ".join(f"{name} {id_type if kind is None else kinds[kind]}" for name, kind in fields)

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_kind = None

        def noted(batches):
            nonlocal id_kind
            for batch in batches:
                id_kind = batch.schema.field("id").type
                yield batch

        for (head, *rows) in rows_by_block(noted(batches), names):
            _, _, _, _, _, _, _, subroot, root, rest, rest_places = head
            schema = pa.schema([(name, kind or id_kind) for name, kind in fields])
            appended, held = Appended(), []
            for _, _, identifier, position, size, node, forged, *_ in rows:
                held.append((Leaf(identifier, position, size, node, forged), appended.append(node)))
            appended.finish(levels_of(rows[0][4], block_levels))
            found = []
            for leaf, partial in held:
                witness, places = partial.siblings()
                found.append(row_of(leaf, witness + rest, places + rest_places, subroot, root))
            yield table_of(found, schema)

    dealt = headed(nodes.select("tree", "position", "id", "size", "node", "forged"), upper, block_levels)
    return dealt.mapInArrow(complete, columns)


def audited(
    docs: DataFrame,
    names: Iterable[str] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "source",
    text_col: str = "text",
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """The manifest's digests, and whether each row, some of them tampered with, still leads to the root:
    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, position, n_siblings."""
    nodes, upper = built(leaves(docs, names, id_col, tree_col, text_col), block_levels)
    fields = [("doc_id", None), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
              ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()),
              ("position", pa.int64()), ("n_siblings", pa.int64())]

    def row_of(row, witness, places, subroot, root):
        reached = folded(row.forged or row.leaf, witness, places)
        siblings = sum(map(len, witness)) // len(row.leaf)
        return row.id, row.leaf, subroot, root, digest(witness), reached, reached == root, row.position, siblings

    return leaf_rows(nodes, upper, block_levels, fields, row_of)


def query(spark, sf_dir: str) -> DataFrame:
    return audited(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, coalesce('=' || source, '') AS tree,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') AS f1, coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS f2,
    xor(list_reduce(list_concat([4294967295::BIGINT],
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) AS crc
  FROM documents
), t AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d
), l AS (
  SELECT doc_id, tree, sha256(f1 || f2 || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(f1 || f2 || coalesce(strlen(low) || ':' || low, '-')) END AS forged
  FROM t
), b AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l
), up(level, tree, pos, h, n) AS (
  SELECT 0, tree, pos, leaf, count(*) OVER (PARTITION BY tree) FROM b
  UNION ALL
  SELECT level + 1, tree, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM up WHERE n > 1 GROUP BY level, tree, pos // 16
), subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM up WHERE n = 1
), top(level, pos, h, n) AS (
  SELECT 0, pos, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM top WHERE n > 1 GROUP BY level, pos // 16
), others AS (
  SELECT a.level, a.tree, a.pos, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos <> a.pos), '') AS h
  FROM up a JOIN up s ON a.level = s.level AND a.tree = s.tree AND a.pos // 16 = s.pos // 16
  WHERE a.n > 1 GROUP BY a.level, a.tree, a.pos
), top_others AS (
  SELECT a.level, a.pos, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos <> a.pos), '') AS h
  FROM top a JOIN top s ON a.level = s.level AND a.pos // 16 = s.pos // 16
  WHERE a.n > 1 GROUP BY a.level, a.pos
), proofs AS (
  SELECT b.tree, b.pos, string_agg(o.h, '' ORDER BY o.level) AS h
  FROM b JOIN others o ON o.tree = b.tree AND o.pos = b.pos // (16 ** o.level)::BIGINT GROUP BY b.tree, b.pos
), top_proofs AS (
  SELECT s.tree, string_agg(o.h, '' ORDER BY o.level) AS h
  FROM subroots s JOIN top_others o ON o.pos = s.pos // (16 ** o.level)::BIGINT GROUP BY s.tree
), fold(level, tree, leaf_pos, pos, h) AS (
  SELECT 0, tree, pos, pos, coalesce(forged, leaf) FROM b
  UNION ALL
  SELECT f.level + 1, f.tree, f.leaf_pos, f.pos // 16,
    sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.h ELSE s.h END, '' ORDER BY s.pos))
  FROM fold f JOIN up s ON s.level = f.level AND s.tree = f.tree AND s.pos // 16 = f.pos // 16 AND s.n > 1
  GROUP BY f.level, f.tree, f.leaf_pos, f.pos // 16
), reached AS (
  SELECT tree, leaf_pos, max_by(h, level) AS h FROM fold GROUP BY tree, leaf_pos
), top_fold(level, tree, leaf_pos, pos, h) AS (
  SELECT 0, r.tree, r.leaf_pos, s.pos, r.h FROM reached r JOIN subroots s ON s.tree = r.tree
  UNION ALL
  SELECT f.level + 1, f.tree, f.leaf_pos, f.pos // 16,
    sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.h ELSE s.h END, '' ORDER BY s.pos))
  FROM top_fold f JOIN top s ON s.level = f.level AND s.pos // 16 = f.pos // 16 AND s.n > 1
  GROUP BY f.level, f.tree, f.leaf_pos, f.pos // 16
), done AS (
  SELECT tree, leaf_pos, max_by(h, level) AS h FROM top_fold GROUP BY tree, leaf_pos
), root AS (SELECT h FROM top WHERE n = 1)
SELECT b.doc_id, b.leaf, s.h AS subroot, root.h AS root,
  sha256(coalesce(p.h, '') || coalesce(q.h, '')) AS proof_sha256, done.h AS folded_root, done.h = root.h AS verified,
  b.pos AS position, (length(coalesce(p.h, '')) + length(coalesce(q.h, ''))) // 64 AS n_siblings
FROM b JOIN subroots s USING (tree) CROSS JOIN root JOIN done ON done.tree = b.tree AND done.leaf_pos = b.pos
LEFT JOIN proofs p ON p.tree = b.tree AND p.pos = b.pos LEFT JOIN top_proofs q ON q.tree = b.tree
"""
