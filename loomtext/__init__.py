"""loomtext: Spark-native text preparation, search, guarding and conversation state."""

import sys

from pyspark import cloudpickle

# Executors receive the small per-batch helpers inside the task closure, so the package
# does not have to be installed on every worker.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
