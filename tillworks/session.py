"""Session helpers. A running session is always respected; nothing here sets a master."""

from pyspark.sql import SparkSession


def shuffle_partitions(input_bytes: int, per_partition: int = 256 << 20) -> int:
    """Partitions for shuffling an input of this size: about 256 MB each, 200 at least.

    Adaptive execution merges partitions that turn out small but never splits all of them, so
    the number has to be high enough at the start.
    """
    return max(200, -(-input_bytes // per_partition))


def build_session(
    app_name: str = "tillworks", input_bytes: int = 0, **conf: str
) -> SparkSession:
    """The running session as it is, or a new one in which results do not depend on the host's
    time zone."""
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes))
        # Plans are built from many small expressions; no call site is looked up for each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: that of ``spark.checkpoint.dir``, or one in the
    warehouse where it is unset. On a cluster a warehouse without a scheme, or on ``file:``, is a
    folder of one machine, and is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    scheme = warehouse.split(":", 1)[0] if ":/" in warehouse else "file"
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_work"
