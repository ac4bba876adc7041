"""Match analytics on Spark."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with the plan: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
