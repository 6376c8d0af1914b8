"""Operators for preparing training text at corpus scale.

Nothing outside this package imports it. Each module holds one operator with a
general interface; ``queries`` binds the operators to the given tables.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
