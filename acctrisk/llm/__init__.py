"""Operators for preparing training corpora: quality, language, duplicates, tokens, packing, chat."""

import sys

from pyspark import cloudpickle

# The task functions travel to the workers as code, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
