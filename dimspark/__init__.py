"""A dimensional warehouse on PySpark."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent with the code they call, so that executors
# need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
