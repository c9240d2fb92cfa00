"""Operators of a training-data pipeline; nothing else in the library imports this package.

Functions of this package travel to the executors by value, so a cluster needs numpy and pyarrow
there but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
