"""Operators for training-data pipelines; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors whole, so these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
