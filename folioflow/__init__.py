"""Document processing and data quality over ordered text, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python workers get the package's functions by value, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
