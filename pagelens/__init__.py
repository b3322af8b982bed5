"""pagelens: building and studying a labelled web-page corpus with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run inside Python workers travel with their code, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
