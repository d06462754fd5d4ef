"""Cutting of lineage: intermediate results go to the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the checkpoint folder of the cluster, so that a lost executor loses none of them.

    The folder is read from ``spark.checkpoint.dir``. Where that is unset, a master on this machine, as in tests, gets a folder
    that goes with the process; on a cluster that is an error, since executors would write to disks of their own. Set
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` to have files removed once nothing refers to them.
    """
    context = df.sparkSession.sparkContext
    if not context.getConf().get("spark.checkpoint.dir", "") and not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint()
