"""Operators for preparing training data; nothing else in the library imports this subpackage.

Functions that run inside tasks travel by value, so executors need only numpy, pyarrow and zstandard.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
