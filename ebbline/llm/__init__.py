"""Corpus operators for training data. Nothing else in the library imports this subpackage."""

import os
import sys
from pathlib import Path

from pyspark import cloudpickle

# Workers import this package by the driver's PYTHONPATH or, on one machine, its working folder. A driver that found it by
# other means (a changed ``sys.path``) sends the functions themselves along instead.
_ROOT = Path(__file__).resolve().parents[2]
_SEEN = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
if _ROOT not in [Path(p).resolve() for p in _SEEN]:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
