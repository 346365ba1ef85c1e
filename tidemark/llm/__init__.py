"""Operators that prepare text for training language models."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with them, so executors
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
