"""Operators of a training-data pipeline over text tables."""

import sys

from pyspark import cloudpickle

# tasks carry the code of these operators along: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
