"""Session factory and the helpers that touch cluster-wide settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows and bytes of a side that is broadcast; above either a salted or sort-merge join is used.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Rows of one key from which a join splits it.
HOT_ROWS = 200_000


def get_session(app: str = "framewright", master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the operators were written for (UTC, AQE)."""
    b = SparkSession.builder.appName(app).master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _shared_folder(spark: SparkSession) -> str:
    """The reliable folder of this application: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without that setting (tests): it gets a folder of this process. On a cluster such a folder would be
    the driver's own, so there a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="framewright-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, which ``drop_written`` removes too."""
    return f"{_shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` in the reliable checkpoint folder, its lineage cut. For small and middling results; see ``written``."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, its lineage cut: a third of a checkpoint's size, and later reads take only the
    columns they need. ``drop_written`` removes the tables of a session.
    """
    path = f"{_shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Remove the tables that ``written`` made in this session; frames built on them can't be read afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_shared_folder(spark)}/tables")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _width(c: Column, t: T.DataType) -> Column:
    """About how many bytes a value takes in memory."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(t, T.ArrayType):
        fixed = not isinstance(t.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))
        inner = F.greatest(F.size(c), F.lit(0)) * 8 if fixed else F.aggregate(F.coalesce(c, F.array().cast(t)), F.lit(0).cast("long"), lambda s, x: s + _width(x, t.elementType).cast("long"))
        return inner + 24
    if isinstance(t, T.MapType):
        return _width(F.map_entries(c), T.ArrayType(T.StructType([T.StructField("key", t.keyType), T.StructField("value", t.valueType)])))
    if isinstance(t, T.StructType):
        return sum((_width(c.getField(f.name), f.dataType) for f in t.fields), F.lit(16))
    return F.lit(8)


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes (about, in memory) of ``df``, by one aggregation."""
    r = df.agg(F.count("*"), F.sum(sum((_width(F.col(f"`{f.name}`"), f.dataType).cast("long") for f in df.schema.fields), F.lit(16).cast("long")))).first()
    return r[0], r[1] or 0


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a materialised side may be broadcast: at most BROADCAST_ROWS rows and BROADCAST_BYTES bytes."""
    rows, size = size_of(df)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", per: int = HOT_ROWS) -> DataFrame:
    """Join in which no key of ``left`` puts more than about ``per`` rows into one task.

    The keys of more rows are counted first (at most one for every ``per`` rows of ``left``); their rows are spread over as many
    salts as it takes, and only the rows of ``right`` under those keys are repeated by them. ``how``: inner, left or left_semi.
    """
    hot = checkpointed(left.groupBy(*on).count().where(F.col("count") > per).dropna(subset=on).select(*on, F.ceil(F.col("count") / per).cast("int").alias("__k")))
    if hot.isEmpty():
        return left.join(right, on, how)
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot
    spread = [f.name for f in left.schema.fields if f.name not in on and not isinstance(f.dataType, T.MapType)]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread]) if spread else F.monotonically_increasing_id(), F.coalesce("__k", F.lit(1)))
    big = left.join(hot, on, "left").withColumn("__salt", salt.cast("int")).drop("__k")
    rep = right.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__k", F.lit(1)) - 1))).drop("__k")
    return big.join(rep, [*on, "__salt"], how).drop("__salt")


def guarded_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join ``big`` with a table expected to be small.

    ``small`` is materialised and measured first. Within the bounds of ``fits_broadcast`` it is broadcast, so a key that
    holds a third of ``big`` causes no shuffle at all; beyond them ``salted_join`` splits such a key over many tasks.
    """
    small = checkpointed(small)
    return big.join(F.broadcast(small), on, how) if fits_broadcast(small) else salted_join(big, small, on, how)


def ranked(df: DataFrame, order: list[tuple[Column, bool]], out: str, weight: str | None = None) -> DataFrame:
    """Number from 0 (or the sum of ``weight``) of the rows before each row in ``order``, pairs of a column and whether it falls.

    No global sort: rows are cut into ranges, numbered within each, and offset by what the ranges before hold, one row a range.
    """
    d = df.withColumns({f"__o{i}": c for i, (c, _) in enumerate(order)})
    by = [F.col(f"__o{i}").desc() if falls else F.col(f"__o{i}").asc() for i, (_, falls) in enumerate(order)]
    d = checkpointed(d.repartitionByRange(*by).withColumn("__p", F.spark_partition_id()))
    one = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    n = d.groupBy("__p").agg(F.sum(one).alias("__n"))
    before = checkpointed(n.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__b")))
    w = Window.partitionBy("__p").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return d.join(F.broadcast(before), "__p").withColumn(out, F.col("__b") + F.coalesce(F.sum(one).over(w), F.lit(0))).drop("__p", "__b", *[f"__o{i}" for i in range(len(order))])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
