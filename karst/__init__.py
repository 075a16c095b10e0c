"""karst: vector and multimodal tables as plain PySpark jobs.

Every operator takes DataFrames and returns DataFrames, so Spark plans,
partitions and shuffles the work.  ``karst.plans.store`` adds named, versioned
tables (Parquet segments plus one small commit record per write) on top.
"""

__all__ = ["Database", "Table", "connect"]


def __getattr__(name: str):
    # loaded on demand, so a worker that only needs a kernel stays light
    if name in __all__:
        from karst.plans import store
        return getattr(store, name)
    raise AttributeError(name)
