"""Operators of a training-data pipeline: filters, near-duplicate and
substring removal, formatting, tokenising, packing, archive resolution.
Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that the
# executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
