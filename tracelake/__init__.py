"""Spark-native analytics over traces, spans, scores, evaluations and retrieval corpora."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the workers by value, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
