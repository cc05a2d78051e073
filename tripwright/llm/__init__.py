"""Operators for preparing training data; nothing else in the library imports them.

Functions of this package travel to the executors by value, so that the package need not be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
