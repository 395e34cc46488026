"""Design and analysis of salted-hash experiments over unit-by-day metric tables, on Spark."""

import sys

from pyspark import cloudpickle

# The functions that run in Python tasks travel with the tasks, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
