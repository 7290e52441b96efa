"""foldwise: leak-free modelling of mixed tables as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task functions travel inside the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
