"""Operators on text corpora, pages and vectors for preparing training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, so that these need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
