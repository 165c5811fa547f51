"""Operators that prepare text for training language models.

Nothing else in the library imports this package. Its functions travel to the executors by value,
so that a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
