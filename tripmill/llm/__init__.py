"""Operators for preparing training text. Nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Functions for executors travel with their code, so workers need not find this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
