"""Operators for preparing training text: scoring, scans, deduplication, mixing, encoding, search."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the workers by value, which need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
