"""Trip cleaning, enrichment, aggregation and result reconciliation on Spark."""

import sys

from pyspark import cloudpickle

# Functions of the library travel to the executors by value: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
