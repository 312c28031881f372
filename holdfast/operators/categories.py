"""Category columns: frequency ranking, indexing and one-hot encoding."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.cluster import scratch_dir
from holdfast.functions.columns import present
from holdfast.operators.wide import RankedCategories, category_slot, index_by_ranking, sparse_vector

__all__ = ["index_by_ranking"]

# Values of one column that a model holds and the driver receives.
HELD_VALUES = 100_000
# Spark's own bound of a limit.
MOST_ROWS = (1 << 31) - 1


class TooManyCategories(ValueError):
    """A column listed as a category has more distinct values than a model may hold."""


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) per non-null value of the listed columns the table has, in one pass.

    Counts form within each task first; the exchange carries one row per task and distinct value.
    """
    texts = [F.col(c).cast("string").alias(c) for c in present(df, columns)]
    if not texts:
        raise ValueError("none of the category columns is present")
    narrow = df.select(*texts)
    return (
        narrow.unpivot([], narrow.columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_ranking(df: DataFrame, columns: list[str], path: str) -> DataFrame:
    """(column, value, n, index): index 0 is the most frequent value, ties in value order.

    For any number of values. The distinct values are sorted over all tasks and written to `path`, which
    the result reads and the caller keeps as long as it is needed; the start of each task then follows
    from the tasks' sizes, a table of one row per task and column.
    """
    return ranking_of(category_counts(df, columns), path)


def ranking_of(counts: DataFrame, path: str) -> DataFrame:
    """`category_ranking` of counts that are there already."""
    place = F.monotonically_increasing_id()
    counts.orderBy("column", F.desc("n"), "value").withColumn("place", place).write.parquet(path)

    # The upper bits of the place are the task that sorted the row, the lower 33 its row there.
    ordered = counts.sparkSession.read.parquet(path).withColumn("task", F.shiftright("place", 33))
    sizes = ordered.groupBy("column", "task").agg(
        F.count(F.lit(1)).alias("size"), F.min("place").alias("first")
    )
    before = Window.partitionBy("column").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "column", "task", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    # As many rows as tasks, and one more per column that ends inside a task.
    return ordered.join(F.broadcast(starts), ["column", "task"]).select(
        "column", "value", "n", (F.col("start") + F.col("place") - F.col("first")).alias("index")
    )


@dataclass(frozen=True)
class Categories:
    """What is known of category columns after a fit: the values of some by falling frequency, ties in value order,
    and the number of values of the others, whose ranking is at `path`."""

    labels: dict[str, list[str]]
    wide: dict[str, int]
    path: str = ""

    def sizes(self, columns: list[str]) -> dict[str, int]:
        """The number of values of each of `columns` that has any, in their order."""
        found = {c: len(values) for c, values in self.labels.items()} | self.wide
        return {c: found[c] for c in columns if c in found}


def categories_of(
    df: DataFrame, columns: list[str], max_categories: int | None = None, held_values: int | None = None
) -> Categories:
    """The values of each listed column that has any.

    The driver, and a model, hold up to `held_values` of a column. Wider columns are ranked in a table of their own. A
    caller who names `max_categories` gets an error for a column with more; nothing is ever cut off.
    """
    held_values = HELD_VALUES if held_values is None else held_values
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in present(df, columns)}
    if not found:
        return Categories({}, {})
    # The counts are read several times and made once.
    counts = category_counts(df, list(found)).persist(StorageLevel.DISK_ONLY)
    try:
        return _categories(counts, found, max_categories, held_values)
    finally:
        counts.unpersist()


def _categories(
    counts: DataFrame, found: dict[str, list[tuple[int, str]]], max_categories: int | None, held_values: int
) -> Categories:
    """`categories_of` the columns in `found`, whose values are empty yet."""
    # With one row more than all columns may have together, one of them is over its bound: what is left out
    # is never part of a result.
    most = held_values if max_categories is None else max_categories
    rows = counts.limit(min(most * len(found) + 1, MOST_ROWS)).collect()
    wide: dict[str, int] = {}
    path = ""
    if max_categories is None:
        wide = _wide_columns(counts, rows, most * len(found), held_values)
        if wide:
            rows = counts.where(~F.col("column").isin(list(wide))).collect()
    for row in rows:
        found[row["column"]].append((-row["n"], row["value"]))
    over = [c for c, values in found.items() if max_categories is not None and len(values) > max_categories]
    if over:
        raise TooManyCategories(f"more than {max_categories} values in: {', '.join(over)}")
    if wide:
        folder = scratch_dir(counts.sparkSession)
        path = f"{folder}/ranking"
        ranking = ranking_of(counts.where(F.col("column").isin(list(wide))), f"{folder}/sorted")
        ranking.select("column", "value", "index").write.parquet(path)
        found = {c: values for c, values in found.items() if c not in wide}
    labels = {c: [value for _, value in sorted(values)] for c, values in found.items() if values}
    return Categories(labels, wide, path)


def _wide_columns(counts: DataFrame, rows: list, most: int, held_values: int) -> dict[str, int]:
    """The columns with more than `held_values` of the counts, of which `rows` are the first."""
    if len(rows) <= most:  # these are all
        sizes = Counter(row["column"] for row in rows)
    else:
        sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}
    return {c: size for c, size in sizes.items() if size > held_values}


def category_labels(
    df: DataFrame, columns: list[str], max_categories: int | None = None
) -> dict[str, list[str]]:
    """The values of each listed column that has any, by falling frequency, all held by the driver: for columns known
    to be narrow, or with a bound beyond which to fail."""
    return categories_of(df, columns, max_categories, MOST_ROWS).labels


def index_stages(labels: dict[str, list[str]]) -> list[StringIndexerModel]:
    """Indexers `c -> c_idx`; null and unseen values get the index after the last.

    One model per number of values: the Python constructor takes a rectangular array only.
    """
    by_size: dict[int, list[str]] = {}
    for column, values in labels.items():
        by_size.setdefault(len(values), []).append(column)
    return [
        StringIndexerModel.from_arrays_of_labels(
            [labels[c] for c in columns],
            inputCols=columns,
            outputCols=[f"{c}_idx" for c in columns],
            handleInvalid="keep",
        )
        for _, columns in sorted(by_size.items())
    ]


def one_hot_encoder(columns: list[str]) -> OneHotEncoder:
    """Encoder `c_idx -> c_enc`; the slot of null and unseen values is dropped, so those are all zero."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_enc" for c in columns])


def fit_category_index(
    df: DataFrame, columns: list[str], max_categories: int | None = None, held_values: int | None = None
) -> PipelineModel:
    """Frequency index of all listed columns the table has; columns without any value are left out."""
    known = categories_of(df, columns, max_categories, held_values)
    return PipelineModel([*index_stages(known.labels), *wide_stages(known)])


def wide_stages(known: Categories) -> list[RankedCategories]:
    return [RankedCategories(sizes=known.wide, path=known.path)] if known.wide else []


def encode_categories(
    df: DataFrame, columns: list[str], max_categories: int | None = None, held_values: int | None = None
) -> tuple[DataFrame, PipelineModel]:
    """The table with `c_idx` and `c_enc` for each listed column that has a value, and the model of the indices and of
    the encodings of columns that it holds the values of."""
    known = categories_of(df, columns, max_categories, held_values)
    if not known.labels and not known.wide:
        raise ValueError("none of the category columns has a value")
    encoders = [one_hot_encoder(list(known.labels))] if known.labels else []
    model = Pipeline(stages=[*index_stages(known.labels), *encoders, *wide_stages(known)]).fit(df)
    encoded = model.transform(df)
    for column, size in known.wide.items():
        slot = F.array_compact(F.array(category_slot(column, size, 0)))
        encoded = encoded.withColumn(f"{column}_enc", sparse_vector(size, slot))
    return encoded, model
