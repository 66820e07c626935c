"""Operators for large-scale training-data preparation.

One module per operator; ``queries`` registers them. Nothing else in the
library imports this subpackage.

Functions that run in tasks are sent by value, so executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
