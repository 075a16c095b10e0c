"""Session helpers: the shared scratch folder and cut-off points for lineage."""

from __future__ import annotations

import contextlib
import pathlib
import tempfile
import uuid
import zipfile

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a temporary folder, because there driver and executors share
    one disk.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    root = _local_roots.get(context.applicationId)
    if root is None:
        root = _local_roots[context.applicationId] = "file:" + tempfile.mkdtemp(prefix="karst-")
        context.setCheckpointDir(root)
    return root


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/karst-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the scratch folder."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the scratch folder.

    Call it when no DataFrame built on intermediate tables (manifests, batches,
    embeddings) is needed any more.
    """
    from karst.plans import files
    files.delete(spark, _application_folder(spark))


def posix_path(path: str) -> str:
    """Local form of a ``file:`` URI, for readers that need a mounted file system."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        return "/" + path.lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is not on a mounted file system")
    return path


def write_observed(df: DataFrame, path: str, aggregates: Sequence[Column], group_rows: int | None = None) -> dict:
    """Write Parquet and return aggregates of the written rows, in the same pass."""
    options = {} if group_rows is None else {"parquet.block.row.count.limit": group_rows}
    if not aggregates:
        df.write.options(**options).parquet(path)
        return {}
    observation = Observation()
    df.observe(observation, *aggregates).write.options(**options).parquet(path)
    return observation.get


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Inside, a finished query's shuffle files are deleted at once.

    Otherwise they stay until the driver happens to collect its garbage.  Meant
    for a single write: Spark would run the stages of a query again if the same
    DataFrame is asked for a second time.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Inside, Python tasks are given at most so many rows and about so many bytes at once.

    Otherwise a batch is ten thousand rows, whatever their size, and stands in
    the executor and in its Python worker.  Meant for a single write.
    """
    wanted = {ARROW_ROWS: str(rows), ARROW_BYTES: str(size)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def materialise(df: DataFrame, label: str, release: bool = False, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Later actions start from the written table: nothing upstream is computed
    twice, and a lost executor costs only a re-read.  With ``release`` the
    shuffle files behind it go as soon as it is written.  A reader holds a row
    group, or 4,096 rows of one; ``group_rows`` makes groups of wide rows small.
    """
    with shuffles_released(df.sparkSession) if release else contextlib.nullcontext():
        return materialise_observed(df, label, [], group_rows)[0]


def materialise_observed(df: DataFrame, label: str, aggregates: Sequence[Column], group_rows: int | None = None) -> tuple[DataFrame, dict]:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    facts = write_observed(df, path, aggregates, group_rows)
    return spark.read.schema(df.schema).parquet(path), facts


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Needed where it is not installed on the workers; the same as ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = pathlib.Path(__file__).parent
    folder = pathlib.Path(tempfile.mkdtemp(prefix="karst-pkg-"))
    archive = folder / "karst.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, str(source.relative_to(root.parent)))
    # addPyFile copies the archive from the driver to every executor
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
