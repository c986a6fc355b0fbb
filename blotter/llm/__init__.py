"""Operators for preparing training text; nothing else in the library imports this subpackage.

Its Python functions travel to the executors by value, so a cluster needs
numpy and pyarrow there but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
