"""A k-way merge of sorted iterators by a tree of losers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

# Sorts behind every key: an ended run.
_END = (1,)


def merge(runs: list[Iterable[tuple[Any, Any]]]) -> Iterator[Any]:
    """Items of (key, item) runs in the order of the keys; ties go to the earlier run.

    Inner nodes hold the loser of their match. After the winner is put out, only the matches
    between its leaf and the root are played again: one comparison per level.
    """
    sources = [iter(run) for run in runs]
    k = len(sources)
    if not k:
        return
    held: list[Any] = [None] * k

    def advance(run: int) -> tuple:
        for key, item in sources[run]:
            held[run] = item
            return (0, key, run)
        return _END

    heads = [advance(run) for run in range(k)]
    losers = [0] * k
    winners = [0] * k + list(range(k))  # leaf of run r is k + r
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if heads[a] <= heads[b] else (b, a)
    winner = winners[1] if k > 1 else 0
    while heads[winner] != _END:
        yield held[winner]
        heads[winner] = advance(winner)
        node = (k + winner) // 2
        while node:
            if heads[losers[node]] < heads[winner]:
                losers[node], winner = winner, losers[node]
            node //= 2
