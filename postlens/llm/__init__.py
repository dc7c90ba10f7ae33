"""Operators for preparing training text: dedup, tokens, fingerprints, archives, mixing, filters."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
