"""Operators of a training-data pipeline over `documents`, `pages` and `benchmark`.

Nothing else in the library imports this package. Functions of the package travel
to executors by value, so executors need the third-party libraries but not this
repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
