"""Spark-native assembly, quality control and comparison of transcribed documents."""

import sys

from pyspark import cloudpickle

# Workers get our functions by value: a cluster needs no copy of the package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
