"""A PySpark-native engine for curating document corpora.

Functions that run on executors are pickled by value, so executors need Python's libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
