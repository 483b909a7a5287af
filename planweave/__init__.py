"""Spark-first analytics for building drawings and building models."""

import sys

from pyspark import cloudpickle

# Executors need not have the library installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
