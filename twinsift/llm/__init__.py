"""Operators of a training-data pipeline. Nothing else in the library imports
this subpackage. Its functions travel to the executors by value, so Python
workers need no copy of the package on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
