"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors get the package's functions with each task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
