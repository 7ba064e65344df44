"""Operators for preparing language-model training data; nothing outside this package imports it.

Functions that Spark sends to its Python workers travel by value, so that the workers need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
