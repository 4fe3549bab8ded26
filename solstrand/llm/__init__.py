"""Operators of a training-data pipeline, one module each; their queries are in `queries.py`."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
