"""Operators of a training-data pipeline. Nothing else in the library imports this package.

The functions that run inside tasks are sent to the executors by value, so that the executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
