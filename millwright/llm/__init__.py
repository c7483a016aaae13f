"""Operators of a training-data pipeline; nothing outside this package imports them."""

import sys

from pyspark import cloudpickle

# task functions travel by value: executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
