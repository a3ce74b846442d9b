"""Operators for preparing training text at scale; nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
