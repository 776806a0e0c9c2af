"""Genome delivery QC as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python functions of this package travel by value, so workers need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
