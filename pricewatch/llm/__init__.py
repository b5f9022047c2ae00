"""Operators over text corpora: search, near duplicates, filtering, mixing and packing.

Each module holds one operator; ``queries`` binds them to the given tables. Nothing else
in the library imports this folder. Functions that run in Python workers are sent with
their code, so executors need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
