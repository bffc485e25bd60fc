"""Spark-native analytics for paged documents.

Functions of this package are shipped to executors by value, so that a cluster
needs no copy of the package installed beside PySpark, pyarrow and numpy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
