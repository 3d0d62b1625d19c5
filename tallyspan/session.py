"""Session helpers: one place for the settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The shared folder that ``spark.checkpoint.dir`` names. Where it is unset a local session (tests, bench) uses the warehouse folder beside
    its tables; a cluster session has to name one, since a folder of one machine is lost with it."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder: computed once, read by every later branch, safe to lose executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A side is broadcast only after it was counted and holds no more rows and no more bytes of text than this.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def is_small(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether a bounded count proves that ``df`` holds at most ``most`` rows and ``BROADCAST_BYTES`` bytes of text."""
    text = [F.octet_length(F.col(f"`{f.name}`") if f.dataType.typeName() in ("string", "binary") else F.to_json(F.struct(F.col(f"`{f.name}`")))) for f in df.schema if f.dataType.typeName() in ("string", "binary", "array", "map", "struct")]
    size = sum((F.coalesce(t, F.lit(0)).cast("bigint") for t in text), F.lit(0).cast("bigint"))
    r = df.select(size.alias("b")).limit(most + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return r.n <= most and r.b <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a bounded count proves it small; unmarked (shuffled join) otherwise."""
    return F.broadcast(df) if is_small(df, most) else df


def left_join_dimension(facts: DataFrame, dim: DataFrame, key: str | list[str], spread_by: Column, most: int = BROADCAST_ROWS, salts: int = 32, how: str = "left") -> DataFrame:
    """``facts`` joined with ``dim``, which has one row per ``key``: broadcast if counted small, else shuffled with every key spread over ``salts``
    tasks, so that a key that holds a third of all rows is no task of its own. ``spread_by`` tells the rows of a key apart."""
    key = [key] if isinstance(key, str) else list(key)
    if is_small(dim, most):
        return facts.join(F.broadcast(dim), key, how)
    salted = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).join(salted, [*key, "_salt"], how).drop("_salt")


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input of fewer splits than the cluster has cores, spread over them; a larger input is left as it is read.
    For work in Python that costs far more than moving the rows once."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
