"""Operators of a training-data pipeline: archives, packing, exact vector search, source mixing,
token counts, toxicity, token files, near-duplicates, quality rules, sharding, nearest neighbours, phrase collocations
and prefix tries of conversations.

Nothing outside this folder imports it. Functions that run in Python workers are shipped with the
tasks (pickled by value), so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
