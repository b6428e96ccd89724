"""Operators that prepare text, page and vector collections for training language models."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
