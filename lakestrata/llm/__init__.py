"""Operators for preparing text corpora; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to executors inside the tasks that use
# them: executors need the public libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
