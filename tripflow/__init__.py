"""tripflow: taxi-trip ingestion, quality and enrichment as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job: executors need not have the
# package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
