"""Session settings and the helpers every job shares."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, memory: str = "12g",
                  name: str = "sluice") -> SparkSession:
    """Session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (builder.config("spark.ui.enabled", "false").config("spark.driver.memory", memory)
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
            .getOrCreate())


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that functions
    in it can be loaded there wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="sluice-package-")) / "sluice-package.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for tables between steps; a local session without
    one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="sluice-checkpoint-"))
    return _LOCAL[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small file over all cores before costly cell work.  A scan that
    already has a split per core is returned as it is, so nothing is shuffled on
    large inputs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded_rows(df: DataFrame, limit: int = 200_000, what: str = "table") -> list[dict]:
    """Rows of a metadata table on the driver; refuses a table that is not small."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is not a metadata table")
    return [r.asDict(recursive=True) for r in rows]
