"""Independent Spark actions submitted together.

A run ends in many small sinks (one directory per report) that read the same materialised copies.
Submitted one after another, every sink waits for the previous one's planning and its last
straggler task while the other task slots idle. Submitted from a bounded pool of driver threads,
they run as concurrent Spark jobs that share the executors' task slots: the scheduler interleaves
their tasks. Each action is still an ordinary distributed job; only the submission overlaps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

R = TypeVar("R")

DEFAULT_PARALLEL_ACTIONS = 8


def run_all(actions: Iterable[Callable[[], R]], max_parallel: int = DEFAULT_PARALLEL_ACTIONS) -> list[R]:
    """Run the callables as concurrent jobs; results in input order. Every action runs to its end;
    the first failure (in input order) is then raised."""
    actions = list(actions)
    if max_parallel <= 1 or len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(actions)),
                            thread_name_prefix="vaultshift-action") as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]
