"""Spark session and shared-storage helpers.

The library never creates its own session inside an operator; these helpers are
for tests, the bench and command-line use.  Settings that matter at scale:

* AQE on, with partition coalescing and skew-join splitting, so the shuffle
  partition count can be sized for the largest stage and small stages shrink.
* Broadcast joins only through Spark's own size check
  (``spark.sql.autoBroadcastJoinThreshold``, applied by AQE on runtime sizes),
  except for the handful of sides whose row count has a proven bound (see
  ``operators.panel.join_back``).
* Session time zone pinned to UTC so calendar months do not depend on the
  machine the driver runs on.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "demandcast", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is only read here.
    Where it is unset (tests, local runs) a fresh scratch folder is made and
    registered, so ``DataFrame.checkpoint()`` and the table sinks have a place
    to write.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; checkpoint() uses the server's setting
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.conf.get("spark.master", None)
        if master is None or not re.match(r"local(\[|$)", str(master)):   # unknown counts as a cluster
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                               "(checkpoints and written tables must survive the loss of an executor)")
        conf_dir = tempfile.mkdtemp(prefix="demandcast-ckpt-")   # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is not None:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    return conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for a written table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name
