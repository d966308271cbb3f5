"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
