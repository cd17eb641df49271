"""Operators for large training-data pipelines (documents, conversations,
embeddings). One module per operator; ``catalog`` registers one query each.
Nothing outside this folder imports it.

Functions of this package that run on executors are shipped by value, so the
executors need numpy, pyarrow and the tokenizer files, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
