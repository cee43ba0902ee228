"""distillery: distillation-data building and rerank evaluation as Spark DataFrame operators.

Sub-packages
------------
sources    readers/sinks for JSONL samples, scored pairs, triplets; driver-table fixtures
functions  column-level functions (cosine, softmax, log-prob lookup, prompt text, formats)
operators  DataFrame -> DataFrame operators (pairs, teacher scoring, mining, metrics, losses, report)
plans      end-to-end pipelines and plan-inspection helpers
streaming  Structured Streaming variants of the per-sample (stateless) stages
"""

__version__ = "0.1.0"

import sys as _sys

try:  # ship this package's Python UDF code by value: executors need not have it installed
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle; then the package must be on executors
    pass
