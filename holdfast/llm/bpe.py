"""What merging by rank does to two neighbouring tokens.

Merging symbols by rank, leftmost first among equals, leaves a text cut so that every two neighbouring
tokens, merged alone, come out as these two tokens again; and only one cut has that property. So the tokens
of a prefix follow from those of shorter prefixes: the last token is the one that goes with the token before.
"""

from __future__ import annotations

from collections.abc import Callable

NEVER = float("inf")
Rank = Callable[[str, str], float]


def merge_all(symbols: list[str], rank: Rank) -> tuple[list[str], list[tuple[float, str, str]]]:
    """The tokens, and for each merge its rank with the outermost symbols after it."""
    symbols, history = list(symbols), []
    while len(symbols) > 1:
        ranks = [rank(a, b) for a, b in zip(symbols, symbols[1:])]
        best = min(ranks)
        if best == NEVER:
            break
        at = ranks.index(best)
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        history.append((best, symbols[0], symbols[-1]))
    return symbols, history


class Recent[Key, Value]:
    """A memory of bounded size: the last `size` entries stored or used, and up to as many older ones."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[Key, Value] = {}
        self.old: dict[Key, Value] = {}

    def get(self, key: Key) -> Value | None:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: Key, value: Value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Neighbours:
    """Tells which token may follow which. `symbols_of` cuts a token into what merging starts from."""

    def __init__(self, rank: Rank, symbols_of: Callable[[str], list[str]]):
        self.rank, self.symbols_of = rank, symbols_of
        self.grown: dict[str, tuple | None] = {}

    def growth(self, token: str) -> tuple | None:
        """(ranks, leftmost symbols, rightmost symbols) of the merges that make the token; None if none do."""
        if token not in self.grown:
            symbols = self.symbols_of(token)
            made, history = merge_all(symbols, self.rank)
            self.grown[token] = (
                (
                    (*(r for r, _, _ in history), NEVER),
                    (symbols[0], *(left for _, left, _ in history)),
                    (symbols[-1], *(right for _, _, right in history)),
                )
                if len(made) == 1
                else None
            )
        return self.grown[token]

    def whole(self, token: str) -> bool:
        """Whether the token comes out whole when merged alone."""
        return self.growth(token) is not None

    def fit(self, left: str, right: str) -> bool:
        """Whether the two tokens stay apart. Plays both tokens' merges in the order of their ranks and looks
        for a merge across the border that would come first."""
        left_ranks, _, left_edge = self.growth(left)
        right_ranks, right_edge, _ = self.growth(right)
        i = j = 0
        while True:
            across, next_left, next_right = self.rank(left_edge[i], right_edge[j]), left_ranks[i], right_ranks[j]
            # of equal ranks the leftmost merge comes first
            if across < next_left and across <= next_right:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1
