"""Code that runs inside Python workers (stateful processors, sink writers, batch functions)
is pickled by value, so executors need no copy of this package on their path."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    """Pickle by value what belongs to the module's package, all its modules included: code of
    one module uses functions of others, which a worker could not import either."""
    try:
        cloudpickle.register_pickle_by_value(sys.modules[module_name.partition(".")[0]])
    except ValueError:  # already registered
        pass


ship_by_value(__name__)
