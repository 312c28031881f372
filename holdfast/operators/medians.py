"""Exact medians of several columns at once, by counting over narrowing ranges of values."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import finite_or_null

# A pass cuts each column's present range into so many parts of about as many rows each; the summary it does that
# with has this accuracy. Ranges with at most so many rows are counted value by value.
PARTS, ACCURACY, FEW_ROWS = 1_000, 10_000, 20_000
# Parts to either side of where the middle should lie. Counting tells whether it does.
MARGIN = 2


@dataclass(frozen=True)
class Range:
    """Values from `low` to `high`; without a bound there is none. The bounds belong to it unless they are open."""

    low: float | None = None
    high: float | None = None
    low_open: bool = False
    high_open: bool = False

    def holds(self, value: Column) -> Column:
        condition = value.isNotNull()
        if self.low is not None:
            condition &= value > F.lit(self.low) if self.low_open else value >= F.lit(self.low)
        if self.high is not None:
            condition &= value < F.lit(self.high) if self.high_open else value <= F.lit(self.high)
        return condition

    def lies_above(self, value: Column) -> Column:
        if self.low is None:
            return F.lit(False)
        return value <= F.lit(self.low) if self.low_open else value < F.lit(self.low)


@dataclass
class Search:
    """The range that is known to hold the middle one of a column's `n` values, and one that is thought to."""

    n: int
    known: Range = Range()
    guess: Range = Range()

    @property
    def rank(self) -> int:
        """From 0; of two values in the middle the lower one."""
        return (self.n - 1) // 2

    def learn(self, below: int, inside: int, cuts: list[float]) -> bool:
        """Takes in how many values lie below and inside the guess, and its cuts into parts. Whether the rest can be
        counted by value."""
        guess = self.guess
        if self.rank < below:
            self.known = self.guess = replace(self.known, high=guess.low, high_open=True)
        elif self.rank >= below + inside:
            self.known = self.guess = replace(self.known, low=guess.high, low_open=True)
        else:
            self.known = guess
            if inside <= FEW_ROWS or guess.low is not None and guess.low == guess.high:
                return True
            at = (self.rank - below) * (len(cuts) - 1) // max(inside - 1, 1)
            self.guess = Range(cuts[max(0, at - MARGIN)], cuts[min(at + 1 + MARGIN, len(cuts) - 1)])
            if (self.guess.low, self.guess.high) in ((cuts[0], cuts[-1]), (guess.low, guess.high)):
                self.guess = Range(cuts[at], cuts[at])  # one value of the range: it is the middle one, or parts it
        return False


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """The median of the finite values of each listed column that has any; of an even number of values the lower
    of the two in the middle, so that it is always a value of the column.

    Every pass reads the columns once and hands on a summary of fixed size per task and column. It narrows the
    range in which the middle lies some hundredfold, however the values are spread, so that a few passes leave few
    enough rows, or a single value, to count them by value. Counts decide; the summary only proposes ranges, and
    one that misses the middle still narrows the search.
    """
    if not columns:
        return {}
    values = df.select(*[finite_or_null(c).alias(c) for c in columns])
    counts = values.agg(*[F.count(f"`{c}`").alias(c) for c in columns]).first()
    searches = {c: Search(counts[c]) for c in columns if counts[c]}
    left = [c for c, search in searches.items() if search.n > FEW_ROWS]
    shares = F.array(*[F.lit(i / PARTS) for i in range(PARTS + 1)])
    while left:
        facts = []
        for c in left:
            value, guess = F.col(f"`{c}`"), searches[c].guess
            facts.append(
                F.struct(
                    F.count_if(guess.lies_above(value)).alias("below"),
                    F.count_if(guess.holds(value)).alias("inside"),
                    F.percentile_approx(F.when(guess.holds(value), value), shares, ACCURACY).alias("cuts"),
                ).alias(c)
            )
        found = values.agg(*facts).first()
        left = [c for c in left if not searches[c].learn(**found[c].asDict())]
    return _middles(values, {c: (search.known, search.rank) for c, search in searches.items()})


def _middles(values: DataFrame, searches: dict[str, tuple[Range, int]]) -> dict[str, float]:
    """The values with the wanted ranks, from the counts of values in ranges that hold few different ones."""
    if not searches:
        return {}
    facts = [F.count_if(within.lies_above(F.col(f"`{c}`"))).alias(c) for c, (within, _) in searches.items()]
    below = values.agg(*facts).first()
    held = {c: F.when(within.holds(F.col(f"`{c}`")), F.col(f"`{c}`")) for c, (within, _) in searches.items()}
    rows = values.select(*[value.alias(c) for c, value in held.items()])
    rows = rows.unpivot([], list(searches), "column", "value").where(F.col("value").isNotNull())
    counted = rows.groupBy("column", "value").count().collect()  # FEW_ROWS per column at most
    found = {}
    for c, (_, rank) in searches.items():
        reached = below[c]
        for value, n in sorted((r["value"], r["count"]) for r in counted if r["column"] == c):
            reached += n
            if rank < reached:
                found[c] = value
                break
    return found
