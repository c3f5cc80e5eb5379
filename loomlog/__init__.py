"""Log analytics and anomaly detection as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Ship the few Python functions that run in tasks by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
