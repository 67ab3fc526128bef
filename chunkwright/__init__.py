"""chunkwright: a Spark-native engine for building, searching and curating text corpora."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the plan: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
