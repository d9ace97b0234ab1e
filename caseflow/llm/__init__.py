"""Operators that prepare training data for language models."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so that no executor needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
