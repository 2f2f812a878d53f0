"""Spark-native operators for customer-conversion analytics.

Every operator takes and returns a DataFrame.  Row-level work stays on the
executors; only bounded results (a fitted vocabulary, one profile row per
column, one metric row) ever reach the driver.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so the
# executors need no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
