"""Exact de-duplication by sorting the texts' content.

Sampled splitters deal the rows out into buckets of a total order: the first bytes of the normalised text,
its SHA-256, the identifier. Inside a bucket an external sort places equal texts next to each other, and
each row is compared in full with its neighbour. A group of copies may run over many buckets, because the
identifier is part of the order: no task gets more than its bucket. Runs that touch a bucket's edge are
joined through one small table with a row per bucket, which holds keys only; where these agree, the texts on
both sides of the edge are compared in a join of each bucket with the one before it.

Only DataFrame functions are used.

Nulls and edges: a null text counts as empty; a null identifier sorts last, so it stays only in a group
without any other; of rows equal in text and identifier exactly one stays; an empty table gives an empty
result; other columns are carried along unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import read_table, shuffle_width, staged

PREFIX_BYTES = 16
BUCKETS_PER_TASK = 4
SAMPLED_PER_BUCKET = 24
SEED = 11


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_key(text: Column) -> Column:
    """First bytes and digest of the normalised text, in hex: equal texts have equal keys."""
    norm = normalised(text).cast("binary")
    return F.concat(
        F.rpad(F.hex(F.substring(norm, 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0"), F.sha2(norm, 256)
    )


def digest_of(key: Column) -> Column:
    return F.substring(key, 2 * PREFIX_BYTES + 1, 64)


def order_key(key: Column, identifier: Column) -> Column:
    """The key with the identifier behind it, as text that sorts by both; null identifiers last."""
    low = (identifier.cast("long") % F.lit(1 << 32) + F.lit(1 << 32)) % F.lit(1 << 32)
    high = (identifier.cast("long") - low) / F.lit(float(1 << 32)) + F.lit(float(1 << 31))
    number = F.concat(
        F.lpad(F.hex(high.cast("long")), 8, "0"), F.lpad(F.hex(low), 8, "0")
    )
    return F.concat(key, F.coalesce(number, F.lit("G")))


def splitters(df: DataFrame, id_col: str, text_col: str, buckets: int) -> list[str]:
    """`buckets` - 1 keys at most, from a sample of the rows that only steers how evenly they are dealt out."""
    share = min(1.0, buckets * SAMPLED_PER_BUCKET / max(df.count(), 1))
    identifier, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    drawn = df.select(identifier.alias("id"), text.alias("text")).sample(share, SEED)
    sample = sorted(r[0] for r in drawn.select(order_key(content_key(F.col("text")), F.col("id"))).collect())
    return sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []


def bucket_of(key: Column, bounds: list[str]) -> Column:
    """The number of bounds not above `key`, by binary search."""
    if not bounds:
        return F.lit(0)
    held = F.split(F.lit(",".join(bounds)), ",")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def step(at: Column, width: Column) -> Column:
        further = (at + width <= len(bounds)) & (F.try_element_at(held, at + width) <= key)
        return F.when(further, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def content_sorted(df: DataFrame, id_col: str, text_col: str, carried: Column, with_text: bool = False) -> DataFrame:
    """Rows (row, id, key, bucket, run, first, edge_text): `run` numbers the different texts of a bucket,
    `first` marks the first row of each, and the outermost rows of a bucket keep their normalised text; all rows
    keep the text as it was in `text` if asked to."""
    width = shuffle_width(df.sparkSession)
    keyed = df.select(
        carried.alias("row"),
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        content_key(F.col(f"`{text_col}`")).alias("key"),
    )
    bounds = splitters(df, id_col, text_col, width * BUCKETS_PER_TASK)
    placed = keyed.withColumn("bucket", bucket_of(order_key(F.col("key"), F.col("id")), bounds))
    placed = placed.repartition(width, "bucket")
    inside = Window.partitionBy("bucket").orderBy("key", F.col("id").asc_nulls_last())
    same = F.when(
        F.lag("key").over(inside) == F.col("key"),
        normalised(F.lag("text").over(inside)) == normalised(F.col("text")),
    )
    outermost = F.lag("key").over(inside).isNull() | F.lead("key").over(inside).isNull()
    marked = placed.withColumn("first", ~F.coalesce(same, F.lit(False))).withColumn(
        "edge_text", F.when(outermost, normalised(F.col("text")))
    )
    marked = marked if with_text else marked.drop("text")
    return marked.withColumn("run", F.sum(F.col("first").cast("long")).over(inside))


def bucket_keys(runs: DataFrame) -> DataFrame:
    """(bucket, runs, opening, closing, before) per bucket that has rows: its first and last key, and the bucket before
    it if that ends with the key this one begins with. No text is among what comes together here."""
    edges = runs.where(F.col("edge_text").isNotNull()).groupBy("bucket")
    keys = edges.agg(
        F.min_by("key", "run").alias("opening"), F.max_by("key", "run").alias("closing"), F.max("run").alias("runs")
    )
    by_bucket = Window.orderBy("bucket")
    before = F.when(F.lag("closing").over(by_bucket) == F.col("opening"), F.lag("bucket").over(by_bucket))
    return keys.withColumn("before", before)


def continued_runs(runs: DataFrame) -> DataFrame:
    """Buckets whose first run goes on from an earlier bucket: (bucket, head_bucket, head_run)."""
    keys = staged(bucket_keys(runs))
    edges = runs.where(F.col("edge_text").isNotNull()).groupBy("bucket")
    openings = edges.agg(F.min_by("edge_text", "run").alias("opening_text"))
    closings = edges.agg(F.max_by("edge_text", "run").alias("closing_text")).withColumnRenamed("bucket", "before")
    pairs = keys.where(F.col("before").isNotNull()).select("bucket", "before")
    alike = pairs.join(openings, "bucket").join(closings, "before").where("opening_text = closing_text")
    linked = keys.select("bucket", "runs").join(alike.select("bucket", F.lit(True).alias("linked")), "bucket", "left")
    linked = staged(linked.select("bucket", "runs", F.col("linked").isNotNull().alias("goes_on")))
    head = F.when((F.col("runs") > 1) | ~F.col("goes_on"), F.struct("bucket", "runs"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        linked.withColumn("head", F.last(head, ignorenulls=True).over(before))
        .where("goes_on")
        .select("bucket", F.col("head.bucket").alias("head_bucket"), F.col("head.runs").alias("head_run"))
    )


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are summed up by their run within a bucket first, so that a large group is a row per bucket in the sum over
    groups, and no key of the join with the rows has more of them than a bucket.
    """
    runs = staged(content_sorted(df, id_col, text_col, F.lit(None).cast("string"))).drop("row")
    heads = continued_runs(runs).withColumn("run", F.lit(1).cast("long"))
    local = runs.groupBy("bucket", "run").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    local = local.join(heads, ["bucket", "run"], "left").select(
        "bucket",
        "run",
        "least",
        "n",
        F.col("head_bucket").isNotNull().alias("goes_on"),
        F.coalesce("head_bucket", "bucket").alias("group_bucket"),
        F.coalesce("head_run", "run").alias("group_run"),
    )
    local = staged(local)
    groups = local.groupBy("group_bucket", "group_run").agg(
        F.min("least").alias("keep_id"), F.sum("n").alias("group_size")
    )
    found = local.join(groups, ["group_bucket", "group_run"]).select("bucket", "run", "goes_on", "keep_id", "group_size")
    return runs.drop("edge_text").join(found, ["bucket", "run"]).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("first") & ~F.col("goes_on")).alias("kept"),
        digest_of(F.col("key")).alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, with its columns. Each text is exchanged once."""
    others = F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in df.columns if c != text_col])
    sorted_rows = content_sorted(df, id_col, text_col, others, with_text=True)
    runs = staged(sorted_rows.where(F.col("first") | F.col("edge_text").isNotNull()))
    heads = continued_runs(runs).select("bucket", F.lit(1).cast("long").alias("run"))
    kept = runs.where("first").join(heads, ["bucket", "run"], "left_anti")
    columns = [F.col("text") if c == text_col else F.col(f"row.`{c}`") for c in df.columns]
    return kept.select(*[column.alias(c) for column, c in zip(columns, df.columns, strict=True)])


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)
"""
