"""Spark-native analytics over robot-run recordings."""

from __future__ import annotations

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Functions sent to Python workers carry their code, so executors need no copy
# of this package on their path.
register_pickle_by_value(sys.modules[__name__])
