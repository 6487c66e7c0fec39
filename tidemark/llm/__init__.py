"""Operators of a training-data pipeline. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
