"""Filter interaction audit over a folder of document files, by streaming.

Two streams process all files there are in micro-batches. The first reads each
text once and marks which of the filters A to D it fails; of the copies of one
text in a batch of rows only the smallest id can still be the first, so all
others are marked as copies (E) at once. The second keeps by the text's SHA-256
the smallest id so far and who holds it: when a smaller id arrives, the earlier
holder's mask is retracted from its part's counters and counted again with E.
Marks and retractions add up to the counters, from which every order of the
filters is read off.

A state holds the texts whose hashes begin with the same bits, TEXTS_A_STATE on
average however many texts there are: calling Python for every text would cost
more than the rest of the job.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from outletlab.llm.common import text_parts
from outletlab.session import scratch_path

FILTERS = "ABCDE"
COPY = 16  # the mask's bit of filter E; A to D have 1, 2, 4 and 8
TEXTS_A_STATE = 32
KNOWN_TEXTS = 50_000  # texts whose smallest id a marking task remembers
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE,
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
              "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # it would reserve megabytes for every small store
              "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
              "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200"}

SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(65, 91))
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that don't begin a code point


def failed_filters(text: bytes) -> int:
    """Mask of the filters A to D that a text fails."""
    n, distinct = 0, set()
    for part in text_parts(text):
        words = part.split()
        n += len(words)
        distinct.update(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUATION))
    return ((n < 200) | (100 * len(distinct) < 50 * n) << 1 | (100 * capitals > 2 * points) << 2
            | (SYMBOLS.search(text) is not None) << 3)


def _mark_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, part, mask, text_key, n, first): rows of one id, part and text are
    counted in n; first says that no smaller id is known for the text. A null
    id counts as larger than any."""
    smallest: dict = {}
    for batch in batches:
        kind = batch.schema.field(0).type
        rows: Counter = Counter()
        masks: dict = {}
        for ident, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            text = text.as_py()
            key = hashlib.sha256(text).digest()
            if key not in masks:
                masks[key] = failed_filters(text)
            rows[(ident, part, key)] += 1
            if ident is not None and (key not in smallest or ident < smallest[key]):
                smallest[key] = ident
        ids, parts, keys = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [])
        first = [key not in smallest or ident == smallest[key] for ident, key in zip(ids, keys, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array(parts, pa.string()), pa.array([masks[k] for k in keys], pa.int32()),
             pa.array(keys, pa.binary()), pa.array(rows.values(), pa.int64()), pa.array(first, pa.bool_())],
            names=["id", "part", "mask", "text_key", "n", "first"])
        if len(smallest) > KNOWN_TEXTS:
            smallest.clear()


def _retractions(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Changes of counters (id, part, mask, n) that new rows of texts bring.
    The state is, row by row, each text's smallest id (a null is larger than
    any) and a part and number of its rows; all its rows were counted without E."""
    best: dict = {}  # by text
    held: dict = {}  # by text: rows of the smallest id, by part
    gone = []
    if state.exists:
        for text, ident, part, n in zip(*state.get, strict=True):
            best[text] = ident
            held.setdefault(text, Counter())[part] += n
    for frame in frames:
        for text, ident, null, part, mask, n in zip(*(frame[c] for c in ("text_key", "id", "null", "part", "mask", "n")), strict=True):
            text, ident, mask, n = bytes(text), None if null else ident, int(mask), int(n)
            own, least = held.get(text), best.get(text)
            if own and ident != least and (ident is None or (least is not None and ident > least)):
                gone.append((ident, part, mask, n))
                continue
            if not own or ident != least:
                gone += [(least, p, mask, k) for p, k in (own or {}).items()]
                best[text], own = ident, Counter()
                held[text] = own
            own[part] += n
    rows = [(text, best[text], part, n) for text, own in held.items() for part, n in own.items()]
    state.update(tuple(list(c) for c in zip(*rows, strict=True)))
    if gone:
        rows = [row for ident, part, mask, n in gone for row in ((ident, part, mask, -n), (ident, part, mask | COPY, n))]
        yield pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=t) for i, (c, t) in enumerate(
            (("id", object), ("part", object), ("mask", "int32"), ("n", "int64")))})


def _source_path(spark: SparkSession, path: str) -> str:
    """A file stream reads folders; a single file is named by a pattern."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isFile():
        return path
    folder, _, name = path.rpartition("/")
    return f"{folder}/[{name[0]}]{name[1:]}"


def _run(stream: DataFrame, root: str, name: str) -> DataFrame:
    """All that the stream's source holds, in micro-batches, as stored rows."""
    spark, path = stream.sparkSession, f"{root}/{name}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)  # a source without files starts no batch
    query = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{root}/{name}_progress")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def failure_changes(spark: SparkSession, documents_path: str, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", files_per_batch: int | None = None, mark_files_per_batch: int | None = None) -> DataFrame:
    """(id, part, mask, n): changes whose sum over n says how many rows of a
    document fail just the filters of a mask. A micro-batch takes as many files
    as the cluster has cores, of the smaller mark files four times as many."""
    cores = spark.sparkContext.defaultParallelism
    schema = spark.read.parquet(documents_path).schema
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch or cores).parquet(_source_path(spark, documents_path))
              .select(F.col(id_col).alias("id"), plain(source_col).alias("part"), plain(text_col).cast("binary").alias("text")))
    ident = StructField("id", schema[id_col].dataType)
    change = StructType([ident, StructField("part", StringType()), StructField("mask", IntegerType()), StructField("n", LongType())])
    mark = StructType([*change.fields[:3], StructField("text_key", BinaryType()), change["n"], StructField("first", BooleanType())])
    holder = StructType([StructField(c, ArrayType(t)) for c, t in (("text_keys", BinaryType()), ("ids", ident.dataType),
                                                                   ("parts", StringType()), ("numbers", LongType()))])
    root = scratch_path(spark, "filter_audit")
    marks = _run(source.mapInArrow(_mark_batches, mark), root, "marks")
    firsts = (spark.readStream.schema(mark).option("maxFilesPerTrigger", mark_files_per_batch or 4 * cores).parquet(f"{root}/marks")
              .filter("first"))
    bits = max(0, (marks.filter("first").count() // TEXTS_A_STATE).bit_length())
    prefix = F.shiftright(F.conv(F.hex(F.substring("text_key", 1, 4)), 16, 10).cast("long"), max(0, 32 - bits)).alias("prefix")
    # pandas has no integers beside nulls
    null, filled = F.col("id").isNull().alias("null"), F.coalesce("id", F.lit(0).cast(ident.dataType)).alias("id")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        retracted = _run(firsts.select(prefix, "text_key", filled, null, "part", "mask", "n").groupBy("prefix").applyInPandasWithState(
            _retractions, change, holder, "append", GroupStateTimeout.NoTimeout), root, "retractions")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    copies = F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask").bitwiseOR(F.lit(COPY))).alias("mask")
    return marks.select("id", "part", copies, "n").unionByName(retracted)


def filter_audit(spark: SparkSession, documents_path: str, labels: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """One row a (part, filter_order, step) with the counts of what its filter
    removes and what else happens to these rows; see ``failure_changes``.

    A part is a source value, null as ''. Null text is empty. Rows repeating a
    document are rows of their own, copies only of smaller ids; a null id is
    larger than any. Of repeated labels of a document one that says 1 is enough.
    An empty folder gives no rows; other columns are not read.
    """
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                                          F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    changes = failure_changes(spark, documents_path, id_col, **names).join(known, "id", "left")
    total = lambda flag: F.sum(F.col("n") * F.coalesce(F.col(flag), F.lit(0)))
    counters = (changes.groupBy("part", "mask").agg(F.sum("n").alias("n"), total("good").alias("good"), total("toxic").alias("toxic"))
                .filter("n <> 0").groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")))  # 32 at most
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = (counters.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.array(*[F.lit(i + 1) for i in range(len(FILTERS))])))
            .withColumn("own", F.lit(0)).withColumn("earlier", F.lit(0)))
    for i, name in enumerate(FILTERS):
        place = F.instr("filter_order", name)
        rows = rows.withColumn("own", F.col("own") + F.when(place == F.col("step"), 1 << i).otherwise(0))
        rows = rows.withColumn("earlier", F.col("earlier") + F.when(place < F.col("step"), 1 << i).otherwise(0))
    pick = lambda test, value="x.n": F.expr(
        f"aggregate(filter(masks, x -> {test}), 0L, (total, x) -> total + {value})")
    removed = "(x.mask & own) <> 0 AND (x.mask & earlier) = 0"
    return rows.select(
        "part", "filter_order", "step", pick("(x.mask & (own | earlier)) = 0").alias("kept"), pick(removed).alias("removed"),
        pick("(x.mask & own) <> 0 AND (x.mask & earlier) <> 0").alias("redundant"), pick("x.mask = own").alias("unique_fails"),
        pick(removed, "x.good").alias("good_lost"), pick(removed, "x.toxic").alias("toxic_lost"),
        # of all orders the filter comes before the others that a row fails in one of as many as it fails
        pick("(x.mask & own) <> 0", "x.n * (120 div bit_count(x.mask))").alias("shapley"))
