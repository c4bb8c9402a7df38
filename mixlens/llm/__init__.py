"""Corpus operators for training-data pipelines; nothing else in the package imports these."""

import sys

from pyspark import cloudpickle

# functions for Python workers travel by value: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
