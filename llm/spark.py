"""What the operators share on the Spark side: tables, work folder, sizes, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whole words of a text, as the contracts have them.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of input a bucket of a packed exchange stands for.
BUCKET_BYTES = 8 << 20
#: The optimizer takes a table of unknown size for one of exabytes, or some share of that.
UNKNOWN_BYTES = 1 << 55


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one in the warehouse."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        known = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return known.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """`df` written as a table into the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = new_folder(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, what: str) -> DataFrame:
    """`written`, after which the shuffle files that the rows came from are removed, where Spark can do so.

    For a `df` that nothing else reads: its shuffles would else lie beside those of the steps that follow.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        # the plan takes the setting when it is made
        return written(df.select("*"), what)
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df.checkpoint()`, with the shared folder set first where the session has none."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def input_bytes(df: DataFrame) -> int:
    """Size of `df` as the optimizer estimates it from its files; where it cannot, from the number of partitions."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known if known < UNKNOWN_BYTES else df.rdd.getNumPartitions() * (64 << 20)


def buckets(df: DataFrame) -> int:
    """Buckets that a packed exchange of `df` takes: they grow with the input, so that each fits a task."""
    return min(1 << 20, max(partitions(df.sparkSession), input_bytes(df) // BUCKET_BYTES))


def row_key(docs: DataFrame) -> str:
    """A name for a row key that no column of docs has."""
    name = "row"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def with_row_key(docs: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """docs(doc_id, text, ...) with a long `name` that no two rows share, in the order of doc_id, nulls first; is it the doc_id?

    Where doc_ids are known and differ, the key is the doc_id itself. Else rows of one doc_id are in the order of a hash
    of their texts, and rows that are equal get a key each; the rows are written once, so that a key stays with its row.
    """
    ids = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("known"), F.count_distinct("doc_id").alias("d")).first()
    if ids["n"] == ids["known"] == ids["d"]:
        # no id is null here; saying so keeps joins from filtering one use of the rows and not another, so that they
        # share an exchange
        return docs.withColumn(name, F.coalesce(F.col("doc_id").cast("long"), F.lit(0))), True
    order = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    names = [f"{name}_{k}" for k in range(3)]
    ordered = docs.select("*", *[c.alias(k) for c, k in zip(order, names, strict=True)])
    ordered = ordered.repartitionByRange(buckets(docs), *names).sortWithinPartitions(*names)
    return written(ordered.select(*docs.columns, F.monotonically_increasing_id().alias(name)), "rows"), False


def with_doc_id(found: DataFrame, rows: DataFrame) -> DataFrame:
    """found(doc_id, ...), whose doc_id is a row key, with the doc_id of rows(row, doc_id) in its place."""
    ids = rows.select("row", F.col("doc_id").alias("own_id"))
    named = found.join(ids, found["doc_id"] == ids["row"])
    return named.select(F.col("own_id").alias("doc_id"), *[c for c in found.columns if c != "doc_id"])


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component) for every end of an edge; the component is the smallest id reachable.

    Large-star and small-star in turn, until nothing changes. Each step regroups at most the edges there are,
    and the minimum is taken by aggregation, so that no neighbourhood is gathered in a task.
    """
    now = checkpointed(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    )
    seen = None
    while (state := _state(now)) != seen:
        seen, now = state, checkpointed(_small_star(_large_star(now)))
    roots = now.groupBy("u").agg(F.min("v").alias("component"))
    return (
        roots.select(F.col("u").alias("id"), "component")
        .unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")))
        .groupBy("id")
        .agg(F.min("component").alias("component"))
    )


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    both = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(both), F.bit_xor(F.xxhash64("v", "u")), F.min("v"), F.max("u")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked with the node's smallest neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
