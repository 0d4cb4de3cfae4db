"""Operators of a training-data pipeline over documents, pages and labels.

Nothing else in the library imports this package; `queries.py` holds the
registered queries and their SQL. Modules are named after what they do, one
operator each.

Functions that run in tasks are sent by value, so executors need the libraries the
operators use but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
