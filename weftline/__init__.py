"""Spark-native table, file and stream jobs expressed as DataFrame plans."""

import sys

from pyspark import cloudpickle

# Tasks receive this package's functions by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
