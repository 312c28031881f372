"""Near-duplicates by SimHash fingerprints.

Fingerprints at most two bits apart are found through the popcounts of their segments. With segments of two
bits, a fingerprint becomes a point with 32 coordinates of 0, 1 or 2. A changed bit moves the point by one
step at most, so the Manhattan distance of two points never exceeds the bit distance of their fingerprints.
Two points at distance two or less share a grid cell among the cells one step around each of them: every
fingerprint is put into its own cell and the neighbouring ones, a join on the cell brings all candidates
together, and the bits are counted exactly.

A cell with very many fingerprints (one group of near copies can fill it) is not joined with itself. Its
members are put once more into cells, now with segments of one bit, where a cell holds at most 65 different
fingerprints, all within two bits of each other: linking each with the smallest loses no link. That covers
every size in the same way; `crowded` only says from which size on it is used.

Nulls and edges: a null or empty text has the fingerprint zero and links like any other; null identifiers
take part but never name a component unless it holds nothing else; repeated rows share a component; an
empty table gives an empty result; other columns are carried along unread.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import read_table, row_of, shuffle_width, staged, unpacked
from holdfast.llm.components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
HASH_SEED = 42
CROWDED = 64
EVEN_BITS = 0x5555555555555555
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends.tolist()
    size = min(shingle_words, len(words))
    total = len(words) - size + 1
    set_bits = np.zeros(64, dtype=np.int64)
    for low in range(0, total, HASHES_AT_ONCE):
        high = min(total, low + HASHES_AT_ONCE)
        hashes = np.array(
            [
                xxhash.xxh64_intdigest(joined[s:e], HASH_SEED)
                for s, e in zip(starts[low:high], ends[low + size - 1 : high + size - 1], strict=True)
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return compute(text)


def pair_popcounts(fingerprint: Column) -> Column:
    """The bits set in each of the 32 pairs of bits, packed as two bits each."""
    other = F.shiftrightunsigned(fingerprint, 1)
    one = fingerprint.bitwiseXOR(other).bitwiseAND(F.lit(EVEN_BITS))
    two = fingerprint.bitwiseAND(other).bitwiseAND(F.lit(EVEN_BITS))
    return one.bitwiseOR(F.shiftleft(two, 1))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def cells_around(point: Column) -> Column:
    """The cell of a point and those one step away: a coordinate of 0 can only grow, one of 2 only shrink."""
    around = [point]
    for at in range(0, 64, 2):
        low, high, step = (F.lit(signed(1 << at)), F.lit(signed(2 << at)), F.lit(signed(1 << at)))
        one, two = point.bitwiseAND(low) != 0, point.bitwiseAND(high) != 0
        # 0 -> 1 and 2 -> 1 set the low bit and clear the high one; 1 -> 2 and 1 -> 0 do the reverse
        more = F.when(one, point.bitwiseXOR(low).bitwiseOR(high)).otherwise(point.bitwiseOR(step))
        around.append(F.when(two, point.bitwiseXOR(high).bitwiseOR(low)).otherwise(more))
        around.append(F.when(one, point.bitwiseXOR(low)))
    return F.array_compact(F.array(*around))


def close_pairs(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between different fingerprints, enough to reach every one within the distance.

    `prints` holds each fingerprint once, as column fp.
    """
    # the cells are many times the fingerprints: dealt out first, so that all tasks share in making them
    spread = prints.repartition(shuffle_width(prints.sparkSession), "fp")
    placed = spread.select("fp", F.explode(cells_around(pair_popcounts(F.col("fp")))).alias("cell"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = staged(placed.join(sizes, "cell"))
    few, many = shared.where(F.col("members") <= crowded), shared.where(F.col("members") > crowded)
    left, right = few.select("cell", F.col("fp").alias("a")), few.select("cell", F.col("fp").alias("b"))
    joined = left.join(right, "cell").where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE)
    )
    return joined.select("a", "b").union(links_of_crowded(many.select("fp").distinct())).distinct()


def links_of_crowded(prints: DataFrame) -> DataFrame:
    """The same links for fingerprints that share a crowded cell, by segments of one bit."""
    fp = F.col("fp")
    around = F.array(fp, *[fp.bitwiseXOR(F.lit(signed(1 << at))) for at in range(64)])
    cells = prints.select("fp", F.explode(around).alias("bits"))
    smallest = cells.groupBy("bits").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("members"))
    linked = cells.join(smallest.where("members > 1"), "bits").where("a < fp")
    return linked.select("a", fp.alias("b")).distinct()


def linked_prints(prints: DataFrame) -> DataFrame:
    """(fp, root) for every fingerprint that has a link; `root` names its component."""
    return components(close_pairs(prints)).select(F.col("node").alias("fp"), "root")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id."""
    rows = staged(
        df.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            fingerprint_column(F.col(f"`{text_col}`")).alias("fp"),
        )
    )
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    named = name_components(prints)
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def name_components(prints: DataFrame) -> DataFrame:
    """(fp, component_id): the smallest identifier of all linked fingerprints, from (fp, first_id)."""
    roots = linked_prints(prints.select("fp"))
    rooted = staged(prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id")


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, one of each component, with its columns: that with the smallest identifier.

    Rows are numbered as they are written, so that of rows with equal identifiers one stays as well.
    """
    rows = staged(
        df.select(
            row_of(df).alias("row"),
            F.col(f"`{id_col}`").cast("long").alias("id"),
            fingerprint_column(F.col(f"`{text_col}`")).alias("fp"),
            F.monotonically_increasing_id().alias("number"),
        )
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "number")
    prints = staged(rows.groupBy("fp").agg(F.min(order).alias("first")))
    roots = linked_prints(prints.select("fp"))
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.number").alias("number"))
    return unpacked(rows.join(kept, "number", "left_semi"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"))
