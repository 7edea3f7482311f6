"""Operators for preparing training data; nothing else in the library imports them.

Their Python code travels to the executors by value, so that these need the
third-party packages only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
