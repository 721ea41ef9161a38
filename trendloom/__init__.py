"""trendloom: topic trends over captured news pages, as PySpark jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to the executors with the job, which need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
