"""Polite requests: a service is asked in lanes, one request at a time in each, with a pause between them.

With one lane, the default, queries are asked one after another in their order, as many cores as the cluster may have. With more, slow answers
don't hold up the others, and each lane pauses as much longer and begins as much later, so that the service isn't asked more often.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql.datasource import InputPartition


class Lane(InputPartition):
    def __init__(self, number: int, of: int, queries: list):
        self.number, self.of, self.queries = number, of, queries


def lanes(queries: list, n: int = 1) -> list[Lane]:
    """The queries dealt out in turn; none for no queries."""
    n = max(1, min(n, len(queries)))
    return [Lane(i, n, queries[i::n]) for i in range(n)] if queries else []


def paced(items: Iterable, pause: float, number: int = 0, of: int = 1, sleep: Callable = time.sleep) -> Iterator:
    """The items of a lane, each when the one before is done with and the lane's pause over."""
    wait = pause * number
    for item in items:
        if wait > 0:
            sleep(wait)
        yield item
        wait = pause * of
