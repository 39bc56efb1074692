"""Operators for building a training corpus: archives, duplicates, languages, scores, mixtures."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so they need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
