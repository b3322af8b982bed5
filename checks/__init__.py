"""Queries and DuckDB oracles used by the driver contract."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
