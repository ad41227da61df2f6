"""Dumps rendered from the given tables. Functions that run in tasks travel with them."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
