"""Operators for preparing training data, with their queries and SQL.

Nothing else in the library imports this package. Its Python functions are sent
to the executors by value, so a cluster needs no copy of the package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
