"""Operators for training-data pipelines over documents, conversations and embeddings.

Their functions travel to the executors by value, so a cluster needs numpy and pyarrow there, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
