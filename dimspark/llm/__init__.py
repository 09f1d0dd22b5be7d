"""Operators for preparing training data, each usable on its own."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent with the code they call, so that executors
# need the libraries in use but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
