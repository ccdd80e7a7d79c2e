"""Spark-native data jobs for a machine-learning platform."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so executors need no copy of this
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
