"""Operators that prepare text for training language models. Nothing else in the library needs them.

Functions of this subpackage that run in tasks travel with them, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
