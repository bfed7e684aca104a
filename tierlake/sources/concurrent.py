"""Jobs that do not need each other, given to the cluster at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

#: Actions that run at once, so that the tasks of many small jobs fill the cluster.
AT_ONCE = 4


def side_by_side(actions: Iterable[Callable[[], Result]]) -> list[Result]:
    """Results in order. All actions have ended when this returns or raises the first one's error, so
    a caller may then drop what they used. They must not write to one table."""
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(AT_ONCE) as pool:
        started = [pool.submit(in_session(action)) for action in actions]
    return [each.result() for each in started]
