"""Operators for preparing training text and embeddings at scale.

Nothing else in the library imports this subpackage. Its Python functions are
pickled by value, so executors need numpy, pandas, xxhash and tokenizers but
not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
