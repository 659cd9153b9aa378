"""lumenlink: a Spark-native record-linkage engine."""

import sys

from pyspark import cloudpickle

# functions travel to Python workers by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
