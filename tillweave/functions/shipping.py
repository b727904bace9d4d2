"""Task code by value: executors need no copy of the repository."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module: str) -> None:
    """Send a module's functions with the tasks that use them."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
