"""Operators for preparing training text: each module is one operator with an interface of its own.

Functions that run in Python workers are shipped by value, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
