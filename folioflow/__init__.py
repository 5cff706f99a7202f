"""folioflow: a Spark-native engine for preparing, searching and evaluating document collections."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
