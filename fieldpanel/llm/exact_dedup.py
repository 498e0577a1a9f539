"""Exact deduplication by a stateful stream.

A Structured Streaming aggregation keeps, per content digest and without expiry, the
stable identifier and the content locator of the row that stays, and the group's size.
The state lives in RocksDB on the executors' disks and is checkpointed to the shared
folder, so it may outgrow memory and survives lost executors; new files only touch the
keys that they contain. A digest hit is not trusted: the full bytes of every hit are
compared with the content that the locator names, and rows whose bytes differ (digest
collisions) are grouped anew by their whole text.

Defined results: null text counts as empty; null identifiers lose against any other, and
a group of only null identifiers keeps one row with a null ``keep_id``; of rows with
equal text and equal identifier, the one with the largest locator stays, so exactly one
row of a group is ``kept``; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fieldpanel.llm.common import fresh, shuffle_width, stage, staging_path

# Each open RocksDB store holds 4 MB of disk, however small: a task closes its own once
# its state is in the shared checkpoint.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}

Digest = Callable[[Column], Column]


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _located(files: DataFrame, doc_id: str, text: str, normalise: Digest | None) -> DataFrame:
    """(doc_id, at, content) of a scan or stream of Parquet files."""
    content = F.coalesce(F.col(text), F.lit(""))
    return files.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
        ).alias("at"),
        (normalise(content) if normalise else content).alias("content"),
    )


def _as_glob(path: str) -> str:
    """The same path as a pattern: a stream then also takes a table that is one file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def ingest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    root: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Digest = sha256,
    normalise: Digest | None = None,
) -> DataFrame:
    """Take all files below ``path`` not seen before into the state kept at ``root``.

    Returns the newest state of every digest: digest, keep (doc_id, at), group_size.
    Each micro-batch writes the keys it changed; a repeated batch overwrites its own
    folder, so that a restart after a failure counts nothing twice.
    """
    changed_rows = T.StructType(
        [
            T.StructField("digest", T.StringType()),
            T.StructField(
                "keep",
                T.StructType(
                    [
                        T.StructField("doc_id", T.LongType()),
                        T.StructField(
                            "at",
                            T.StructType(
                                [
                                    T.StructField("file", T.StringType()),
                                    T.StructField("row", T.LongType()),
                                ]
                            ),
                        ),
                    ]
                ),
            ),
            T.StructField("group_size", T.LongType()),
        ]
    )
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        state = (
            _located(spark.readStream.schema(schema).parquet(_as_glob(path)), doc_id, text, normalise)
            .groupBy(digest(F.col("content")).alias("digest"))
            .agg(
                F.max(F.struct("doc_id", "at")).alias("keep"),
                F.count(F.lit(1)).alias("group_size"),
            )
        )
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{root}/checkpoint")
            .foreachBatch(
                lambda rows, batch: rows.write.mode("overwrite").parquet(
                    f"{root}/changes/batch={batch}"
                )
            )
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    with_batch = T.StructType([*changed_rows.fields, T.StructField("batch", T.LongType())])
    changes = spark.read.schema(with_batch).option("basePath", f"{root}/changes")
    try:
        found = changes.parquet(f"{root}/changes")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):  # no batch ran: there was no file
            raise
        return spark.createDataFrame([], changed_rows)
    newest = F.max_by(F.struct("keep", "group_size"), "batch").alias("newest")
    return found.groupBy("digest").agg(newest).select("digest", "newest.*")


def _spread(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with column ``salt``, over which the rows of a hot digest are dealt.

    A digest is hot if it holds more than one shuffle partition's share of the rows, so
    there are fewer hot ones than shuffle partitions: few enough to broadcast.
    """
    width = shuffle_width(rows.sparkSession)
    total = state.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") * width > F.lit(total)
    hot = state.where(is_hot).select(F.col("digest").alias("hot"))
    salts = F.sequence(F.lit(0), F.lit(width - 1))
    marked = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left")
    salt = F.when(F.col("hot").isNull(), 0).otherwise(F.pmod(F.xxhash64("at"), F.lit(width)))
    copies = F.explode(F.when(is_hot, salts).otherwise(F.array(F.lit(0))))
    return (
        marked.withColumn("salt", salt.cast("int")).drop("hot"),
        state.withColumn("salt", copies),
    )


def deduplicate(
    spark: SparkSession,
    path: str,
    *,
    root: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Digest = sha256,
    normalise: Digest | None = None,
) -> DataFrame:
    """One row per document of the Parquet table at ``path``.

    Columns: doc_id, at (content locator), keep_id, group_size, kept, text_sha256.
    ``root`` names a kept state; by default a new one is made in the shared folder.
    """
    files = spark.read.parquet(path)
    root = root or staging_path(spark, "exact_dedup")
    state = ingest(
        spark, path, files.schema, root, doc_id=doc_id, text=text, digest=digest,
        normalise=normalise,
    )
    state = stage(state, "digests")
    scan = _located(files, doc_id, text, normalise).withColumn("digest", digest(F.col("content")))

    # Every hit's bytes: equal contents of a digest collapse where they are read and meet by
    # (digest, content), so a group of copies travels once per task; what is left over a
    # digest with several contents is a collision.
    collided = (
        scan.groupBy("digest")
        .agg(F.count_distinct("content").alias("contents"))
        .where(F.col("contents") > 1)
        .select("digest")
    )
    apart = stage(scan.join(stage(collided, "collided"), "digest", "left_semi"), "collisions")
    by_text = apart.groupBy("content").agg(
        F.max(F.struct("doc_id", "at")).alias("true_keep"),
        F.count(F.lit(1)).alias("true_size"),
    )
    mended = apart.join(by_text, "content").select("at", "true_keep", "true_size")

    rows = scan.select("doc_id", "at", "digest", sha256(F.col("content")).alias("text_sha256"))
    rows, state = _spread(rows, state)
    keep, size = F.coalesce("true_keep", "keep"), F.coalesce("true_size", "group_size")
    return (
        rows.join(state, ["digest", "salt"])
        .join(mended, "at", "left")
        .select(
            "doc_id",
            "at",
            keep["doc_id"].alias("keep_id"),
            size.alias("group_size"),
            (F.col("at") == keep["at"]).alias("kept"),
            "text_sha256",
        )
    )


def deduplicate_frame(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    ``docs`` is written to the shared folder first: the stream reads files, and the
    locators must name them.
    """
    spark = docs.sparkSession
    path = staging_path(spark, "landed")
    docs.write.parquet(path)
    landed = spark.read.schema(docs.schema).parquet(path)
    found = deduplicate(spark, path, doc_id=doc_id, text=text)
    file, row = fresh(docs.columns, "_kept_file", "_kept_row")
    kept = found.where("kept").select(F.col("at.file").alias(file), F.col("at.row").alias(row))
    at = (F.col("_metadata.file_path") == F.col(file)) & (
        F.col("_metadata.row_index") == F.col(row)
    )
    return landed.join(kept, at, "left_semi")
