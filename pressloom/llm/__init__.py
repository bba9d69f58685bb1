"""Operators of a training-data pipeline over tables of documents and vectors.

Functions that run in Python workers are shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
