"""Session helpers.

Library code never creates its own session; it takes the caller's.  The only
settings touched here are the ones a job needs to be correct (time zone for
ISO period text) and the checkpoint folder, which the caller or the session
names.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "statsheet", extra_conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench (not used by library code)."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(executors: int, cores_per_executor: int, input_tb: float) -> dict[str, str]:
    """Suggested session settings for a large cluster (set by the job owner).

    Shuffle partitions start at ~3 per core and grow with the input (about
    256 MB of shuffle input per partition) and AQE coalesces them at run
    time; skewed partitions are split by AQE; broadcasts are capped at a
    size the driver and every executor can hold; scan splits of 256 MB keep
    tasks a few seconds long without flooding the scheduler.
    """
    cores = executors * cores_per_executor
    by_size = int(input_tb * 1024 * 1024 / 256)
    return {
        "spark.sql.shuffle.partitions": str(max(3 * cores, by_size)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The shared checkpoint folder: the argument, else the one that the session
    names in ``spark.checkpoint.dir``.  Without either, an error, also locally."""
    path = folder or spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not path:
        raise RuntimeError(f"name a folder that all executors share, as an argument or in {_CHECKPOINT_KEY}")
    spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``statsheet`` importable by Python workers (pandas UDFs).

    Zips the package once per application and registers it with
    ``addPyFile``, which Spark distributes to every executor.  A no-op when
    already done for this application.
    """
    import zipfile
    from pathlib import Path

    spark = spark or SparkSession.getActiveSession() or getattr(SparkSession, "_instantiatedSession", None)
    if spark is None:
        return
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    out_dir = Path(tempfile.mkdtemp(prefix="statsheet-py-"))
    target = out_dir / "statsheet.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for p in sorted(pkg.rglob("*")):
            if p.is_file() and "__pycache__" not in p.parts and p.suffix in (".py", ".yaml"):
                zf.write(p, p.relative_to(pkg.parent).as_posix())
    sc.addPyFile(str(target))
    _SHIPPED.add(app)
