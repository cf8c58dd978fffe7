"""Genomics files as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Executors and planning workers need not have the library installed: its classes travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
