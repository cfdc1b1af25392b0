"""Session defaults and the shared scratch location.

Every job in the package is a pure ``DataFrame -> DataFrame`` function, so the
session is the only place where engine behaviour is configured:

* UTC session time zone: epoch-millisecond packet times are formatted and
  bucketed without depending on the machine's zone.
* ANSI on (the Spark 4 default): parsing uses ``try_*`` functions explicitly
  instead of relying on silent NULLs.
* AQE with skew-join splitting and partition coalescing: windows and
  join-backs are keyed by addresses and protocol stacks, and one address can
  carry a large share of all packets.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # DROPMALFORMED must drop the same rows whichever columns a query reads.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # Keep one JSON parse per record: the optimizer would otherwise split a
    # from_json into one narrower parse per field read.
    "spark.sql.optimizer.enableJsonExpressionOptimization": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = "local[*]", app: str = "flowlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults (``master=None``
    leaves the master to spark-submit or the cluster defaults; without
    ``shuffle_partitions`` the cluster's setting stays)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every query relies on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    spark.conf.set("spark.sql.optimizer.enableJsonExpressionOptimization", "false")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and staged tables.

    The cluster names it in ``spark.checkpoint.dir`` (or via
    ``SparkContext.setCheckpointDir``).  Only a local-mode session with
    nothing configured (tests, the bench) gets a private folder of its own;
    a cluster session without a shared folder is an error, because executors
    cannot see a machine-local directory.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="flowlens-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder, deleted when
    the driver ends."""
    path = checkpoint_root(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def materialize(df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder and read
    it back.  For intermediates that several passes reuse (model fitting,
    quantile search): a lost executor then re-reads files instead of
    recomputing the shuffles that produced them."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
