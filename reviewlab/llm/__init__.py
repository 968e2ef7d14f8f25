"""Operators for training-data pipelines: sharding, filters, archives, tokens, deduplication, search.

Functions of this package travel to the workers by value, so executors need Python
with numpy and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
