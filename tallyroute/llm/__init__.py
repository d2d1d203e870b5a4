"""Operators for preparing training text: one module each, and the queries that apply them.

Nothing else in the library imports this subpackage. Its functions are shipped to the executors by
value, so a cluster needs the packages they use (numpy, pyarrow, xxhash, tiktoken) but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
