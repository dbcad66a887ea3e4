"""Operators for training-data pipelines. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the task: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
