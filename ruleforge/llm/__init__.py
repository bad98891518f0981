"""Operators for preparing large text corpora, with their queries and SQL.

Nothing outside this subpackage imports it. Each module holds one operator;
``queries.py`` holds the thin ``opN_*`` queries the driver runs.

Functions of this package that run in Python workers are pickled by value, so
the package has to be importable on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
