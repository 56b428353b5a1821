"""Approximate nearest neighbours by an adaptive dimension scan (operator 1).

Vectors are scaled to unit length and multiplied by a random rotation, which spreads their energy
evenly over the dimensions.  Lists come from k-means over a bounded sample; every vector is put into
the list of its nearest centroid.  Lists are gathered in buckets of about ``PART`` vectors (a longer
list is several buckets), and a query goes once to each bucket that holds lists it probes.  A bucket
is laid out in column blocks.  Distances to the vectors of the probed lists grow block by block;
after d of D dimensions a candidate is abandoned when its partial distance, scaled by D/d, exceeds
the query's threshold by (1 + EPS / sqrt(d))^2 - the test that a whole distance below the threshold is
unlikely.  Survivors are scored exactly, by cosine of the original vectors in double precision.

How many lists a query probes is measured, not set: the least number that finds ``RECALL`` of the true
neighbours inside the sample (in the whole table they are nearer, so easier to find).

Equal vectors are searched once: only the ``k + 1`` smallest ids of a vector can be among anyone's k
nearest (ties go to the smaller id), so a vector that fills a third of the table is a few rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import stored

#: The fit sees so many numbers at most (rows = this / dimensions), the rows with the least id hashes.
FIT_NUMBERS = 1 << 21
PART, MOST_LISTS, BLOCK, EPS = 8192, 1024, 16, 2.1
RECALL, TRIALS = 0.97, 400


def _unit(rows: np.ndarray) -> np.ndarray:
    """Unit rows; scaling by a power of two first keeps huge and tiny numbers in range."""
    _, power = np.frexp(np.abs(rows).max(1, keepdims=True))
    rows = np.ldexp(rows, -power)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def cosines(one: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector to rows, in double precision; both scaled by powers of two (exact)."""
    one = np.ldexp(one, -np.frexp(np.abs(one).max())[1])
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])
    return (rows @ one) / (np.sqrt((rows * rows).sum(1)) * math.sqrt(float(one @ one)))


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def fit_lists(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centroids of unit rows by Lloyd's rounds on their directions."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(lists, len(sample)))
    centres = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x @ centres.T).argmax(1) for x in np.array_split(sample, max(1, len(sample) // 4096))])
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        size = np.sqrt((total * total).sum(1, keepdims=True))
        centres = np.where(size > 0, total / np.where(size > 0, size, 1), centres)
    return centres


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int) -> int:
    """Lists to probe so that ``RECALL`` of the sample's own ``k`` nearest are found."""
    n = len(sample)
    if n <= k + 1 or len(centres) == 1:
        return len(centres)
    home = np.concatenate([(x @ centres.T).argmax(1) for x in np.array_split(sample, max(1, n // 4096))])
    asks = np.linspace(0, n - 1, min(n, TRIALS)).astype(int)
    near = sample[asks] @ sample.T
    near[np.arange(len(asks)), asks] = -2
    true = np.argpartition(-near, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(sample[asks] @ centres.T), axis=1), axis=1)
    need = np.sort(np.take_along_axis(place, home[true], 1).ravel())
    return int(need[math.ceil(RECALL * len(need)) - 1]) + 1


def pack(sizes: dict[int, int], centres: np.ndarray) -> dict[int, tuple[int, int]]:
    """list -> (first bucket, buckets): lists side by side (along the centroids' main direction) share
    buckets of about ``PART`` vectors."""
    main = centres @ np.linalg.svd(centres - centres.mean(0), full_matrices=False)[2][0]
    out, bucket, room = {}, -1, 0
    for i in np.argsort(main, kind="stable").tolist():
        n = sizes.get(i, 0)
        if n > PART:
            parts = -(-n // PART)
            out[i] = (bucket + 1, parts)
            bucket, room = bucket + parts, 0
        else:
            if n > room or bucket < 0:
                bucket, room = bucket + 1, PART
            out[i], room = (bucket, 1), room - n
    return out


class Bucket:
    """The vectors of some lists, rotated, in column blocks."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, lists: np.ndarray, rotation: np.ndarray):
        order = np.argsort(lists, kind="stable")
        self.ids, self.rows, rows = ids[order], rows[order], rows[order]
        self.lists = lists[order]
        turned = _unit(rows) @ rotation
        width = turned.shape[1]
        self.cuts = [*range(0, width, BLOCK), width]
        self.blocks = [np.ascontiguousarray(turned[:, a:b].T) for a, b in zip(self.cuts, self.cuts[1:])]
        self.width = width

    def search(self, query: np.ndarray, turned: np.ndarray, lists: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the query's k nearest in ``lists`` that survive the scan."""
        a, b = np.searchsorted(self.lists, lists), np.searchsorted(self.lists, lists, "right")
        alive = np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist())])
        near = ((self.blocks[0][:, alive] - turned[: self.cuts[1], None]) ** 2).sum(0)
        if len(alive) > k:
            # threshold: the k-th distance of those that look nearest after one block
            first = np.argpartition(near, k - 1)[:k]
            limit, first = near[first], alive[first]
            for block, a, b in zip(self.blocks[1:], self.cuts[1:], self.cuts[2:]):
                limit += ((block[:, first] - turned[a:b, None]) ** 2).sum(0)
            limit = limit.max() * (1 + 1e-9) + 1e-12
            for block, a, b in zip(self.blocks[1:], self.cuts[1:], self.cuts[2:]):
                keep = near * (self.width / a) <= limit * (1 + EPS / math.sqrt(a)) ** 2
                alive, near = alive[keep], near[keep]
                near = near + ((block[:, alive] - turned[a:b, None]) ** 2).sum(0)
            alive = alive[near <= limit]
        score = cosines(query, self.rows[alive])
        best = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive][best], score[best]


def _scan(rotation: np.ndarray, k: int):
    """Rows sorted by (bucket, kind): a bucket's vectors (kind 0), then the queries that probe it."""
    width = len(rotation)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, bucket = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            where = np.stack([batch["bucket"].to_numpy(), batch["kind"].to_numpy()], 1)
            ids, rows = batch["id"].to_numpy(), _matrix(batch["vec"], width)
            lists, ends = batch["lists"].flatten().to_numpy(), np.cumsum(batch["lists"].value_lengths().to_numpy())
            cuts = [0, *(np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if key != where[a, 0]:
                    key, held, bucket = where[a, 0], [], None
                own = np.split(lists[ends[a - 1] if a else 0 : ends[b - 1]], ends[a : b - 1] - (ends[a - 1] if a else 0))
                if where[a, 1] == 0:
                    held.append((ids[a:b], rows[a:b], np.concatenate(own)))
                    continue
                if not held:
                    continue
                if bucket is None:
                    bucket = Bucket(*(np.concatenate(x) for x in zip(*held)), rotation)
                found = [bucket.search(q, t, x, k) for q, t, x in zip(rows[a:b], _unit(rows[a:b]) @ rotation, own)]
                sizes = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[a:b], sizes)), pa.array(np.concatenate([f[0] for f in found])),
                     pa.array(np.concatenate([f[1] for f in found]))], ["query", "id", "score"])
    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): vectors of the commonest length (the longer on a tie) that are neither null nor zero
    and hold only finite numbers; rows without an id take no part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull())
    rows = rows.where(F.forall("vec", finite) & F.exists("vec", lambda x: x != 0))
    common = (rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("c"))
              .orderBy(F.desc("c"), F.desc("n")).limit(1).collect())
    return rows.where(F.size("vec") == (common[0]["n"] if common else 0))


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            probes: int | None = None, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest by cosine of each row that meets ``queries``.

    Candidates are all other rows; largest cosine first, ties to the smaller id.  Null, zero and
    non-finite vectors, and those of an uncommon length, neither ask nor answer.  Repeated rows of an
    id are that one row (never its own answer).  Fewer candidates give fewer answers, an empty table
    an empty result.  ``probes``: lists a query probes; measured on the sample unless given.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    asks = stored(rows.where(queries).distinct(), "asks")
    # of equal vectors the k + 1 smallest ids; the limit is applied before the shuffle
    order = Window.partitionBy("vec").orderBy("id")
    few = rows.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    few = stored(few, "vectors")
    base = few.where("n = 1").select("id", "vec")
    total = base.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = len(base.first()["vec"])
    sample = base.orderBy(F.xxhash64("id"), "id").limit(max(256, FIT_NUMBERS // width))
    sample = _unit(_matrix(sample.select("vec").toArrow()["vec"], width))
    centres = fit_lists(sample, min(MOST_LISTS, max(1, math.isqrt(total))), seed=seed)
    probes = probes or probes_needed(sample, centres, k)
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))[0]
    # lists x dimensions and dimensions squared: bounded by MOST_LISTS and the width, not by the rows
    shared = spark.sparkContext.broadcast((centres, rotation))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                piece = batch.slice(at, 2048)
                best = (_unit(_matrix(piece["vec"], width)) @ shared.value[0].T).argmax(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(best), piece["id"], piece["vec"]], ["list", "id", "vec"])

    lists = stored(base.mapInArrow(home, "list int, id long, vec array<double>"), "lists")
    sizes = {r["list"]: r["n"] for r in lists.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= MOST_LISTS
    packed = pack(sizes, centres)
    places = F.broadcast(spark.createDataFrame([(i, *x) for i, x in packed.items()], "list int, start int, parts int"))
    held = lists.join(places, "list").select(
        (F.col("start") + F.pmod(F.xxhash64("id"), "parts")).cast("int").alias("bucket"), F.lit(0).alias("kind"), "id", "vec",
        F.array("list").alias("lists"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, n = shared.value[0], min(probes, len(shared.value[0]))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                near = -(_unit(_matrix(piece["vec"], width)) @ centres.T)
                best = np.argpartition(near, n - 1, axis=1)[:, :n]
                bucket, row, own = [], [], []
                for i, chosen in enumerate(best.tolist()):
                    goes: dict[int, list[int]] = {}
                    for x in chosen:
                        start, parts = packed[x]
                        for k in range(start, start + parts):
                            goes.setdefault(k, []).append(x)
                    bucket += goes
                    own += goes.values()
                    row += [i] * len(goes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int32()), pa.array(np.ones(len(row), np.int32)), piece["id"].take(pa.array(row)),
                     piece["vec"].take(pa.array(row)), pa.array(own, pa.list_(pa.int32()))],
                    ["bucket", "kind", "id", "vec", "lists"])

    # equal query vectors ask once, under their smallest id
    same = Window.partitionBy("vec").orderBy("id")
    asking = asks.withColumn("n", F.row_number().over(same)).where("n = 1").select("id", "vec")
    asking = asking.mapInArrow(route, "bucket int, kind int, id long, vec array<double>, lists array<int>")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scan(shared.value[1], k + 1)(batches)

    found = (held.unionByName(asking).repartition("bucket").sortWithinPartitions("bucket", "kind")
             .mapInArrow(scan, "query long, id long, score double"))
    top = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = stored(found.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1).drop("r"), "found")

    # back from distinct vectors to ids: those that stand for the answers, then those that asked
    first = few.where("n = 1").select(F.col("id").alias("first"), "vec")
    owners = few.where("n > 1").select("id", "vec").join(first, "vec").select("first", "id")
    answers = found.unionByName(found.join(owners.withColumnRenamed("id", "other"), F.col("id") == F.col("first"))
                                .select("query", F.col("other").alias("id"), "score"))
    head = asks.withColumn("n", F.row_number().over(same)).where("n = 1").select(F.col("id").alias("query"), "vec")
    top = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    answers = answers.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1).drop("r")
    # an answer set is k + 1 rows at most; equal askers get a copy each
    packed = answers.groupBy("query").agg(F.collect_list(F.struct(F.col("score"), F.col("id"))).alias("all"))
    asked = asks.join(head.join(packed, "query"), "vec").select(F.col("id").alias("query_id"), "all")
    ranked = F.slice(F.array_sort(F.filter("all", lambda x: x["id"] != F.col("query_id")),
                                  lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1)
                                  .when(x["id"] < y["id"], -1).when(x["id"] > y["id"], 1).otherwise(0)), 1, k)
    out = asked.select("query_id", F.posexplode(ranked).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"),
                      F.col("x.score").alias("score"))
