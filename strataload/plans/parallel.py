"""Running independent steps of a load at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def side_by_side(spark: SparkSession, step: Callable[[str], Result], names: Iterable[str]) -> dict[str, Result]:
    """Call ``step`` for every name from a driver thread of its own.

    The threads only submit Spark jobs; the cluster works on all of them, so a small
    dimension fills the cores that a large one leaves idle. All steps end before an
    error of one of them is raised.
    """
    names = list(names)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        run = inheritable_thread_target(spark)(step)
        started = {name: pool.submit(run, name) for name in names}
    return {name: future.result() for name, future in started.items()}
