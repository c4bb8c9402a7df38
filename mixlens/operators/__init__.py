"""DataFrame -> DataFrame operators: cleaning, KPI repair, allocation, views, features,
models, forecast, explanations and insights."""

import sys

from pyspark import cloudpickle

# functions for Python workers travel by value: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
