"""paperloom: scholarly-article corpora, term-weight indexes and batch similarity search on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers receive the small helpers by value, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
