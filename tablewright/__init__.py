"""tablewright: table, series, loop and model analytics written as Spark jobs."""

import sys

from pyspark import cloudpickle

from tablewright.session import get_session, pin, scratch_path, scratch_scope

# Functions that run inside tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session", "pin", "scratch_path", "scratch_scope"]
