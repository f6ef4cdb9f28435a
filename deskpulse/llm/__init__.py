"""Operators for preparing training text.

Functions sent to the executors are pickled by value, so the workers need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
