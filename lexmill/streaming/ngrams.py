"""n-grams of a stream of documents, with those of earlier batches in a keyed state that forgets.

Each batch is combined in its tasks as a table is (:func:`~..operators.grams.gram_rows`);
what is left goes to buckets of n-grams, packed: Spark hands rows to a processor one by
one in Python, so that a task sends one row for all that it has for a bucket. A bucket's state is a list of runs, each the
n-grams of a batch in order and when they were met, packed. A batch reads the runs one
by one and adds its own; what it had before is not written again. Where many short runs
have come together, they are merged. N-grams that were not met for the time to live are
forgotten when their bucket is touched next; time is that of the batch, which is the
same when it is done again. (Spark's own time to live would need processing time, with
which a stream over what is available now never ends.)

A task holds the rows that one batch has for a bucket, and a run, so that the number of
buckets must follow the size of batches (:func:`buckets_for`). The stores of all tasks
of an executor share one bounded cache.

Defined cases: documents of fewer words, or without an id, have no row; an id that
comes again in a later batch is judged anew, and has met its own n-grams; a batch that
is done again after a failure has the state from before it, and replaces its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.grams import gram_rows

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # a store that stays open keeps some 10 MB outside the heap, and a stream that starts again has others
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: Buckets at least, and bytes of Parquet files for each, some 500,000 n-grams.
BUCKETS, BUCKET_BYTES = 256, 1 << 21
#: Short runs of a bucket that are merged, and n-grams from which a run is not short.
RUNS, RUN = 8, 1 << 18


def buckets_for(size: int) -> int:
    """Buckets for a stream whose batches together are Parquet files of so many bytes."""
    return max(BUCKETS, -(-size // BUCKET_BYTES))


def judged(rows: pd.DataFrame, known: np.ndarray) -> pd.DataFrame:
    """id, n_ngrams and met of a bucket's rows: an n-gram was met if it is known, or a lower id of the batch has it. Rows that hold none carry totals."""
    ids, names = pd.factorize(rows["id"], sort=True)
    at = np.flatnonzero(rows["held"].to_numpy())
    gram, own = rows["gram"].to_numpy()[at], ids[at]
    order = np.lexsort((own, gram))
    ordered = gram[order]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(at) else at
    seen = np.zeros(len(at), bool)
    seen[order] = own[order] > np.repeat(own[order][head], np.diff(np.r_[head, len(at)]))
    if len(known):  # in order
        seen |= known[np.minimum(np.searchsorted(known, gram), len(known) - 1)] == gram
    met = rows["met"].to_numpy().copy()
    met[at] += rows["many"].to_numpy()[at] * seen
    sums = [np.zeros(len(names), np.int64) for _ in range(2)]
    for total, values in zip(sums, (rows["n_ngrams"].to_numpy(), met), strict=True):
        np.add.at(total, ids, values)
    return pd.DataFrame({"id": names, "n_ngrams": sums[0], "met": sums[1]})


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of runs in order, and when each was last met."""
    grams, times = np.concatenate([g for g, _ in runs]), np.concatenate([np.broadcast_to(t, g.shape) for g, t in runs])
    by = np.lexsort((times, grams))
    grams, times = grams[by], times[by]
    kept = np.r_[grams[1:] != grams[:-1], True]
    return grams[kept], times[kept]


#: Rows of n-grams that a task puts by before it packs and sends them.
SENT = 1 << 18
#: What of the rows of n-grams is packed; rows without an n-gram carry totals.
PACKED = ("id", "gram", "many", "n_ngrams", "met")


def packed(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of n-grams as a row for each bucket and some SENT of them; totals without an n-gram may go to any bucket."""
    held: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        rows = pa.Table.from_batches(held)
        held.clear()
        own = np.where(rows["gram"].is_valid().to_numpy(), rows["gram"].fill_null(0).to_numpy().view(np.uint64), np.arange(len(rows), dtype=np.uint64))
        bucket = (own % np.uint64(buckets)).astype(np.int32)
        by = np.argsort(bucket, kind="stable")
        batch, bucket = rows.take(pa.array(by)).combine_chunks().to_batches()[0], bucket[by]
        del rows, own, by
        heads = np.flatnonzero(np.diff(bucket, prepend=-1))
        payloads = [batch.slice(a, z - a).serialize().to_pybytes() for a, z in zip(heads, [*heads[1:], len(bucket)])]
        yield from pa.Table.from_arrays([pa.array(bucket[heads]), pa.array(payloads, pa.binary())], names=["bucket", "rows"]).to_batches(max_chunksize=1000)

    many = 0
    for batch in batches:
        if len(batch):
            held.append(batch.select(list(PACKED)))
            many += len(batch)
        if many >= SENT:
            yield from flush()
            many = 0
    yield from flush()


def unpacked(payloads: Iterable[bytes], schema: pa.Schema) -> pd.DataFrame:
    """The rows of one bucket, with ``held``: whether a row has an n-gram."""
    rows = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(bytes(x)), schema) for x in payloads])
    held = rows["gram"].is_valid()
    gram = rows["gram"].fill_null(0)  # no nulls: pandas would make floats of the numbers, which can't hold them
    return rows.set_column(1, "gram", gram).append_column("held", held).to_pandas()


class MetGrams(StatefulProcessor):
    """Judge the n-grams of a bucket, and remember them."""

    def __init__(self, live_ms: int, schema: pa.Schema):
        self.live_ms, self.schema = live_ms, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("grams", T.BinaryType()), T.StructField("times", T.BinaryType())])
        self.state = handle.getMapState("runs", T.StructType([T.StructField("run", T.IntegerType())]), schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        payloads: list[bytes] = []
        for part in rows:
            payloads += part["rows"].tolist()
            now = int(part["now"].iloc[0])
        batch = unpacked(payloads, self.schema)
        own = np.unique(batch["gram"].to_numpy()[batch["held"].to_numpy()])
        met, short, last = np.zeros(len(own), bool), [], -1
        for (run,) in sorted(self.state.keys()):
            last = run
            grams, times = (np.frombuffer(x, np.int64) for x in self.state.getValue((run,)))
            alive = np.flatnonzero(np.broadcast_to(times, grams.shape) > now - self.live_ms)  # a run of one batch has one time
            if not len(alive):
                self.state.removeKey((run,))
                continue
            if len(alive) < len(grams):
                grams, times = grams[alive], times[alive]
            if len(own):
                met |= grams[np.minimum(np.searchsorted(grams, own), len(grams) - 1)] == own
            if len(grams) < RUN:
                short.append((run, grams, times))
        found = judged(batch, own[met])
        if len(own):
            times = np.array([now])
            if len(short) >= RUNS:
                own, times = merged([*((g, t) for _, g, t in short), (own, times)])
                for run, _, _ in short:
                    self.state.removeKey((run,))
            self.state.updateValue((last + 1,), (own.tobytes(), times.tobytes()))
        yield found

    def close(self) -> None:
        pass


def ngram_overlap_stream(docs: DataFrame, target: str, checkpoint: str, n: int = 20, live: str = "30 days", buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> StreamingQuery:
    """Write id, n_ngrams and overlap of each batch's documents to a folder of ``target``: the share of n-grams that an earlier batch holds, or a lower id of the same one."""
    spark = docs.sparkSession
    live_ms = int(pd.Timedelta(live).total_seconds() * 1000)
    kind = docs.schema[id_col].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("n_ngrams", T.LongType()), T.StructField("met", T.LongType())])
    schema = pa.schema([("id", to_arrow_type(kind)), *((c, pa.int64()) for c in PACKED[1:])])
    rows = gram_rows(docs.filter(F.col(id_col).isNotNull()), n, False, id_col, text_col, then=(lambda batches: packed(batches, buckets), "bucket int, rows binary"))
    keyed = rows.withColumn("now", F.unix_millis(F.current_timestamp()))
    judged_rows = keyed.groupBy("bucket").transformWithStateInPandas(MetGrams(live_ms, schema), out, "append", "none")

    def write(batch: DataFrame, number: int) -> None:
        totals = batch.groupBy("id").agg(F.sum("n_ngrams").alias("n_ngrams"), F.sum("met").alias("met"))
        totals.select(F.col("id").alias(id_col), "n_ngrams", (F.col("met") / F.col("n_ngrams")).alias("overlap")).write.mode("overwrite").parquet(f"{target}/batch={number}")

    with _store(spark):
        return judged_rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


class _store:
    """The state store that such states need, for the queries started inside."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = {k: self.spark.conf.get(k, None) for k in STORE}
        for k, v in STORE.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_) -> None:
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
