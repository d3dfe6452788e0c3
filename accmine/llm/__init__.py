"""Training-data operators: search, classifiers, token counts, decontamination, near-duplicates,
tokenization, license scans, language-model scores and chat formatting.

Nothing outside this folder imports it. Code that runs in Python workers travels with the job
(pickled by value), so executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
