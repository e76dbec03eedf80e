"""Operators for training-data preparation; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# executors get the functions with the query and need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
