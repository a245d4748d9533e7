"""Corpus preparation and vector collections as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, so a cluster needs no
# separate installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
