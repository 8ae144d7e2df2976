"""Spark-native analytics and retrieval over tables of free-text complaint records."""

import sys

from pyspark import cloudpickle

# Ship the splitter, encoder and search helpers to the executors with the plan,
# so that a cluster does not need this package installed on every node.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
