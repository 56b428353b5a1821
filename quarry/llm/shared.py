"""Tables written to the cluster's shared folder, grouped streams and connected components."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir

#: Rows and bytes of a batch on its way to a Python worker; the JVM and the worker hold a few at a time.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session (lower limits of the user's own stay)."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0)
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path below ``spark.checkpoint.dir``."""
    small_batches(spark)
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    Unlike an RDD checkpoint the copy is columnar (later reads take the columns they need) and its
    size is known to the planner, so small tables are broadcast on evidence.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_tidy(df: DataFrame, name: str) -> DataFrame:
    """``stored``, after which the shuffle files of this one write are removed (they are of no other use)."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(key, before)


class Remembered(dict):
    """A bounded cache of ``made(key)``: two generations, of which the older is dropped when the newer
    is full, so what is asked for often stays.  Keys of over 64 characters are not kept."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size // 2, {}

    def made(self, key: str):
        raise NotImplementedError

    def __missing__(self, key: str):
        found = self.older.get(key)
        if found is None:
            found = self.made(key)
        self.keep(key, found)
        return found

    def forget(self) -> None:
        """At the end of a task: workers live on, and others need the memory."""
        self.clear()
        self.older = {}
        pa.default_memory_pool().release_unused()

    def keep(self, key: str, found) -> None:
        if len(key) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = found


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
         "string": pa.string(), "binary": pa.binary()}


def grouped(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table | None],
            schema: str) -> DataFrame:
    """Apply ``fn`` to the rows of each key, streaming through key-sorted partitions.

    Like ``applyInArrow``, without its cost per group: tens of thousands of two-row groups share an
    Arrow batch.  Callers see to it that a single group is bounded.
    """
    names = [f.name for f in df.schema.fields]
    fields = [c.rsplit(" ", 1) for c in schema.split(", ")]
    arrow_schema = pa.schema([(name, ARROW[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush(parts: list[pa.Table]):
            table = fn(pa.concat_tables(parts).combine_chunks() if len(parts) > 1 else parts[0])
            if table is not None and table.num_rows:
                yield from table.cast(arrow_schema).combine_chunks().to_batches()

        last = None
        for batch in batches:
            table = pa.Table.from_batches([batch]).select(names)
            if not table.num_rows:
                continue
            change = np.zeros(table.num_rows - 1, bool)
            for k in keys:
                v = table[k].to_numpy()
                change |= v[1:] != v[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                part = table.slice(a, b - a)
                key = tuple(part[k][0].as_py() for k in keys) if a == 0 else None
                if a == 0 and key == last:
                    held.append(part)
                else:
                    if held:
                        yield from flush(held)
                    held = [part]
            last = tuple(table[k][table.num_rows - 1].as_py() for k in keys)
        if held:
            yield from flush(held)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def in_blocks(rows: DataFrame, member: str, count: Column) -> DataFrame:
    """Split each group into ``count`` blocks by a hash of the member, and send a row to every pair of
    blocks its own is in (column ``part``): any two members meet, in tasks of bounded size."""
    block = F.pmod(F.xxhash64(member), F.col("_n")).alias("_b")
    meet = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1),
                       lambda o: F.least(o, F.col("_b")) * F.col("_n") + F.greatest(o, F.col("_b")))
    alone = F.array(F.lit(0).cast("long"))
    return (rows.withColumn("_n", count.cast("long")).select("*", block)
            .withColumn("part", F.explode(F.when(F.col("_n") == 1, alone).otherwise(meet))).drop("_n", "_b"))


# --- membership bitmap ---------------------------------------------------------------------------

#: Bits of a membership bitmap: 2^26 = 8 MB, whatever the data (the proven bound of its broadcast).
BITMAP_BITS = 26


def bitmap_of(hashes: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap (bytes) of the top ``bits`` of 64-bit ``column``: one-sided, false positives only.

    Aggregated to at most 2^(bits-6) words before it reaches the driver, so at most 2^bits / 8
    bytes of payload; a fuller bitmap only filters less.
    """
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = (hashes.select(F.shiftright(slot, 6).alias("w"),
                           F.call_function("shiftleft", F.lit(1).cast("long"),
                                           slot.bitwiseAND(63).cast("int")).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    table = words.toArrow()
    out = np.zeros(1 << max(bits - 6, 0), np.int64)
    out[table["w"].to_numpy()] = table["b"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray, bits: int = BITMAP_BITS) -> np.ndarray:
    slot = hashes.astype(np.uint64, copy=False) >> np.uint64(64 - bits)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


# --- connected components ------------------------------------------------------------------------


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) for the edges (a, b) of one batch."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(flat[: len(a)].tolist(), flat[len(a) :].tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return nodes, nodes[[find(x) for x in range(len(nodes))]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            u, v = roots(batch["u"].to_numpy(), batch["v"].to_numpy())
            keep = u != v
            yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], ["u", "v"])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of the undirected edges: component = smallest node reachable.

    Each Arrow batch is first contracted to stars, then large-star and small-star rounds
    (a logarithmic number) join every node with the least of its neighbours; every round is a
    stored table.  Nodes without an edge do not appear.
    """
    kind = "u long, v long"
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = stored(e.mapInArrow(_contract, kind).distinct(), "edges")
    while True:
        many = e.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        chained = e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if not many.limit(1).count() and not chained.limit(1).count():
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(least.select("u", F.col("m").alias("v")))
                   .mapInArrow(_contract, kind).distinct(), "edges")
