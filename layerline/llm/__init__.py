"""Operators of a training-data pipeline, one module each, and their queries."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers with the tasks that use them, so it need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
