"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run in Python workers are pickled by value, so executors need
numpy and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
