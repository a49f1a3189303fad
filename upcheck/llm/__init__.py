"""Training-data operators: deduplication, language, quality, privacy, packing.

Nothing else in the library imports this subpackage.  Its functions travel to
executors by value, so workers need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
