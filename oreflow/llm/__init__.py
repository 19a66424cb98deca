"""Operators for training-data pipelines over text documents.

Each module holds one operator with a general interface; ``queries`` applies them to the tables.
Functions that run in Python workers are shipped by value, so executors need only the public
libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
