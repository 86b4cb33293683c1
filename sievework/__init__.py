"""Spark-native engine for refining text corpora into audited training data."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the executors by value, so that a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
