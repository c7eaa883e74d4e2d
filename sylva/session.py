"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sylva")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch one only when unset in local mode (tests).

    Reads ``spark.checkpoint.dir`` from the session (runtime or context
    configuration) and makes sure the context uses it for ``checkpoint()``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all machines share")
    path = tempfile.mkdtemp(prefix="sylva-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def durable(df):
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Used for model-sized results that later jobs reuse (the SHAP table), so a
    lost executor does not send Spark back through the pandas build.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make ``sylva`` importable in Python workers (once per SparkContext).

    Arrow and pandas steps run functions from this package inside executors.
    When the package is not installed there, it is zipped on the driver and
    added with ``addPyFile``; Spark copies it to every executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_sylva_shipped", False):
        return
    import os
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="sylva-pkg-"), "sylva.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, dirs, files in os.walk(root):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.join("sylva", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._sylva_shipped = True
