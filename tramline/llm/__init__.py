"""Operators for preparing text corpora; nothing outside this folder imports them.

Functions that run in Python workers travel by value, so executors need only
the libraries they call, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
