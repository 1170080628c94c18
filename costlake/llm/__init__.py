"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value, so it needs no installation there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
