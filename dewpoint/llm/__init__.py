"""Operators for preparing training data. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with their code, so executors need no copy of the
# library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
