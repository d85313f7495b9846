"""Training-data operators (quality, sharding, secrets, near-duplicates, extraction, decontamination,
tokenization, language ID, token files, fill-in-middle, hard negatives, byte-level BPE).  Nothing else in the library imports this subpackage.

Functions of this subpackage run inside Spark's Python workers.  They ship by value, so the workers need not have the
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
