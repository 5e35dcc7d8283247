"""Operators for training-data pipelines over a ``documents`` table.

Nothing else in the package imports this subpackage. One module per operator; ``queries`` holds
the thin registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent with their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
