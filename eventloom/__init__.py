"""eventloom: e-commerce event analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel with their job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
