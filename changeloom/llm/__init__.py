"""Operators of a training-data pipeline. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package go to the tasks by value: the workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
