"""Spark-native engine that turns raw text corpora into dependency-graph datasets."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no
# copy of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Names that are loaded when asked for, so that importing the package stays cheap.
_PUBLIC = {
    "Config": "config", "load_config": "config", "make_session": "runtime", "read_pairs": "sources.readers", "build_dataset": "plans.dataset", "dataset_from_files": "plans.dataset",
    "parse_pairs": "plans.dataset", "process_directory": "plans.directory", "Backend": "operators.parse", "register": "operators.parse", "split_and_shard": "operators.sharding",
    "EmbeddingCache": "operators.embed", "ingest": "streaming.ingest", "organize": "operators.contrast",
}
__all__ = sorted(_PUBLIC)


def __getattr__(name: str):
    if name not in _PUBLIC:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    import importlib

    return getattr(importlib.import_module(f"{__name__}.{_PUBLIC[name]}"), name)


__version__ = "0.1.0"
