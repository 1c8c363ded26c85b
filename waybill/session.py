"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "waybill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; ANSI mode stays on.

    Keyword arguments are extra settings with ``__`` in place of dots. Shuffle
    partition counts are left to the caller: they depend on the cluster.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for written intermediates and stream checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local
    session may go without that setting; it then gets a temporary folder. Nothing
    here removes what is written: whoever owns the folder clears it once the job
    that wrote there is over.
    """
    unique = f"{name}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{unique}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="waybill-"), unique)
