"""Training and test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, DoubleType, FloatType

from holdfast.functions.columns import hash_head
from holdfast.schema import KEY, SEED, TRAIN_RATIO

# Copies of a repeated row that are drawn in one piece of work.
COPIES_PER_TASK = 10_000


def on_train_side(key: str = KEY, train_ratio: float = TRAIN_RATIO) -> Column:
    """Whether the key's hash, of 2^32 values, is below the ratio. A null key is, unless the ratio is 0."""
    return hash_head(key) < F.lit(round(train_ratio * 2**32))


def hash_split(df: DataFrame, key: str = KEY, train_ratio: float = TRAIN_RATIO) -> tuple[DataFrame, DataFrame]:
    """Split by the key's hash: all rows of a key on one side, the same side in every run and layout.

    Two filters over the same scan, no exchange.
    """
    is_train = on_train_side(key, train_ratio)
    return df.filter(is_train), df.filter(~is_train)


def row_text(df: DataFrame) -> Column:
    """The whole row as text that no other row has: each value with its length, or a dash for null."""

    def field(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*[field(name) for name in df.columns])


def random_split(df: DataFrame, train_ratio: float = TRAIN_RATIO, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Seeded random split by a draw for every row, with the same sides however the rows are spread.

    The draw is the MD5 of the seed, the row and the number of its copy, from 0: copies of a row are drawn each,
    and which of them is which does not matter. Every task counts its own rows first, so that a row that fills a third
    of the table reaches the exchange once per task; the copies of rows with more than `COPIES_PER_TASK` are dealt out
    in parts of that many. A negative zero stays one, but inside a nested value, where it may lose its sign.
    """
    train, test = (_side(df, train_ratio, seed, is_train) for is_train in (True, False))
    return train, test


def _side(df: DataFrame, train_ratio: float, seed: int, is_train: bool) -> DataFrame:
    def drawn(copy: Column) -> Column:
        """Whether a row's copy is on the wanted side."""
        head = F.conv(F.substring(F.md5(F.concat_ws(" ", F.lit(str(seed)), copy.cast("string"), "text")), 1, 8), 16, 10)
        chosen = head.cast("long") < F.lit(round(train_ratio * 2**32))
        return chosen if is_train else ~chosen

    # Columns by number, as the names may be any. A group's key loses the sign of a zero, its text does not.
    kinds = [f.dataType for f in df.schema.fields]
    keys = [f"c{i}" for i in range(len(kinds))]
    texts = [isinstance(kind, (FloatType, DoubleType)) for kind in kinds]
    named = list(zip(df.columns, keys, kinds, texts, strict=True))
    rows = df.select(*[(F.col(f"`{c}`").cast("string") if is_text else F.col(f"`{c}`")).alias(key) for c, key, _, is_text in named])
    text = row_text(rows).alias("text")
    if all(isinstance(kind, AtomicType) for kind in kinds):
        copies = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(*keys, text, "n")
    else:  # a nested value may be a key without its text
        copies = rows.select(*keys, text).groupBy(*keys, "text").agg(F.count(F.lit(1)).alias("n"))
    some = copies.where(F.col("n") <= COPIES_PER_TASK).select(*keys, "text", F.lit(0).cast("long").alias("start"), "n")
    parts = F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(COPIES_PER_TASK))).alias("start")
    many = copies.where(F.col("n") > COPIES_PER_TASK).select(*keys, "text", parts, "n").repartition("start", "text")
    last = F.least(F.col("start") + COPIES_PER_TASK, "n") - 1
    each = some.unionAll(many).select(*keys, "text", F.explode(F.sequence("start", last)).alias("copy"))
    fields = [(F.col(key).cast(kind) if is_text else F.col(key)).alias(c) for c, key, kind, is_text in named]
    return each.where(drawn(F.col("copy"))).select(*fields)
