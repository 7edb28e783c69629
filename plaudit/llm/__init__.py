"""Operators for building training corpora: one module for each, queries in ``registry``.

Functions that run in Python workers travel by value, so executors need numpy and
Arrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
