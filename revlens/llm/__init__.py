"""Operators of a training-data pipeline: language identification, copies
and near copies, decontamination, formatting, tokenization, quality,
archives.  Nothing else in the library imports this subpackage.

Kernels that run on workers are pickled by value, so executors need the
public libraries the kernels import but not this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
