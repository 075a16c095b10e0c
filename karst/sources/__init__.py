"""Readers for CSV, JSON, SQLite, Arrow IPC and media files, and table imports."""

__all__ = ["import_csv", "import_json", "import_sqlite"]


def __getattr__(name: str):
    # loaded on demand: planning workers import only the one source they run
    if name in __all__:
        from karst.sources import imports
        return getattr(imports, name)
    raise AttributeError(name)
