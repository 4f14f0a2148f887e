"""Operators for preparing language-model training text.

Python functions of this package travel to the executors by value, so a cluster needs nothing installed
but numpy and pyarrow.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
