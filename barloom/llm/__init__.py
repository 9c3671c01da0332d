"""Operators of a training-data pipeline over documents and conversations."""

import sys

from pyspark import cloudpickle

# Executors receive the functions of this package with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
