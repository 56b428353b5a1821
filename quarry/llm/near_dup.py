"""Near-duplicate documents by an LSH forest over MinHash signatures (operator 9).

1. One pass over the texts gives each document's shingle count, a 128-bit key of its shingle set and
   96 minima.  Documents with the same set collapse to their smallest doc_id (the *representative*).
2. Forest: 24 trees, each ordering the signatures by its own sequence of minima.  Representatives
   that share a prefix of ``BASE`` minima in a tree form a region; a region of over ``REGION`` rows
   is entered deeper on ``PATHS`` ways, each with minima of its own, minimum by minimum, until it is
   small enough or ``DEEP`` is reached; what is still larger is split into blocks that meet pairwise,
   so nothing is dropped.  Inside a region the
   signatures are compared and a spanning forest of the pairs estimated at ``THRESHOLD - margin``
   or more goes on.
3. Connected components of those pairs are small clusters of likely near-copies.  Each cluster gets the
   whole texts of its representatives once, compares full shingle sets exactly and emits a spanning
   forest of the true links.  A large cluster is dealt into slices, each of which is compared with the
   cluster's ``PIVOTS`` members of most partners: linear in its size.  Only what these leave outside the
   largest component is then compared with all the rest, in block pairs.
4. Components of the true links, brought back to all documents.

Chance that a pair shares no region: (1 - 0.85^4)^24 = 1e-8 at similarity 0.85 and 3e-6 at 0.8; where all
its regions went to the greatest depth 3e-5 at 0.8 and under
1e-6 at 0.85 (a million simulated pairs each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import kernels as K
from quarry.llm.shared import bitmap_of, components, grouped, in_bitmap, in_blocks, roots, stored

TREES, BASE, DEEP = 24, 4, 8
#: Ways on which a crowded region is entered deeper: a true pair inside it shares one of them.
PATHS = 8
HASHES = TREES * BASE
REGION = 1024
#: Members of a large cluster that all its others are compared with first.
PIVOTS = 8
#: A block of a cluster: so many documents, or so many shingles, at most (one document may exceed it).
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 500_000
#: So many ids (8 MB) are broadcast, more are joined.
FEW_IDS = 1 << 20
#: Estimates of 96 minima scatter by 0.036 at 0.85; 0.17 is over four deviations.
MARGIN = 0.17

_SETS = "doc_id long, n_shingles long, h1 long, h2 long, sig binary"


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = K.MinHash(HASHES)
        for batch in batches:
            for i, j, buf, offsets in K.slices(batch["text"]):
                sets, cut = K.shingle_sets(buf, offsets, size)
                sums = []
                for salt in (0x1234567890ABCDEF, 0x0FEDCBA987654321):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(K.mix(sets ^ K.U64(salt)))])
                    sums.append((total[cut[1:]] - total[cut[:-1]]).view(np.int64))
                sig = minhash(sets, cut)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][i:j].cast(pa.int64()), pa.array(np.diff(cut)), pa.array(sums[0]), pa.array(sums[1]),
                     pa.array([row.tobytes() for row in sig], pa.binary())],
                    ["doc_id", "n_shingles", "h1", "h2", "sig"])
    return run


def _orders() -> np.ndarray:
    """Minima of each (tree, path): the tree's own, then others that no other path of the tree has."""
    rng = np.random.default_rng(17)
    out = np.empty((TREES, PATHS, DEEP), np.int64)
    for t in range(TREES):
        own = np.arange(t * BASE, (t + 1) * BASE)
        others = rng.permutation(np.setdiff1d(np.arange(HASHES), own))[: PATHS * (DEEP - BASE)]
        out[t, :, :BASE], out[t, :, BASE:] = own, others.reshape(PATHS, DEEP - BASE)
    return out


_ORDERS = _orders()


def _prefix_keys(sig: np.ndarray, tree: int, depth: int, path: int = 0) -> np.ndarray:
    """Key of the first ``depth`` minima on a path of a tree."""
    key = np.full(len(sig), K.U64((path * TREES + tree) * 1000 + depth))
    for d in _ORDERS[tree, path, :depth]:
        key = K.mix(key ^ sig[:, d].astype(np.uint64))
    return key.view(np.int64)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(n, HASHES)


def _base_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = _matrix(batch["sig"])
        keys = np.concatenate([_prefix_keys(sig, t, BASE) for t in range(TREES)])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.tile(batch["rep"].to_numpy(), TREES)),
                                          pa.array(np.repeat(np.arange(TREES, dtype=np.int32), batch.num_rows))],
                                         ["key", "rep", "tree"])


def _deep_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig, trees, reps = _matrix(batch["sig"]), batch["tree"].to_numpy(), batch["rep"].to_numpy()
        for t in np.unique(trees).tolist():
            rows = np.flatnonzero(trees == t)
            n, own = len(rows), sig[rows]
            for path in range(PATHS):
                for depth in range(BASE + 1, DEEP + 1):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_prefix_keys(own, t, depth, path)), pa.array(reps[rows]),
                         pa.array(np.full(n, path * TREES + t, np.int32)), pa.array(np.full(n, depth, np.int32))],
                        ["key", "rep", "tree", "depth"])


def _similar(least: float):
    """Spanning forest of the pairs of one region whose signatures agree in ``least`` or more."""
    need = int(np.ceil(least * HASHES))

    def run(table: pa.Table) -> pa.Table | None:
        reps, first = np.unique(table["rep"].to_numpy(), return_index=True)
        if len(reps) < 2:
            return None
        sig = _matrix(table["sig"])[first]
        if len(reps) == 2:
            a, b = (reps[:1], reps[1:]) if np.count_nonzero(sig[0] == sig[1]) >= need else (reps[:0], reps[:0])
        else:
            left, right = [], []
            for i in range(len(reps) - 1):
                near = np.flatnonzero((sig[i + 1 :] == sig[i]).sum(1) >= need)
                left.append(np.full(len(near), reps[i]))
                right.append(reps[i + 1 + near])
            a, b = np.concatenate(left), np.concatenate(right)
        if not len(a):
            return None
        # stars around the member with most partners: it is the likeliest to link to the others
        nodes, root = roots(a, b)
        partners = np.bincount(np.searchsorted(nodes, np.concatenate([a, b])))
        order = np.lexsort((nodes, -partners, root))
        first = np.flatnonzero(np.concatenate([[True], root[order][1:] != root[order][:-1]]))
        centre = np.repeat(nodes[order][first], np.diff(np.append(first, len(nodes))))
        keep = centre != nodes[order]
        return pa.table({"a": centre[keep], "b": nodes[order][keep]})
    return run


def _links(size: int, percent: int):
    """Spanning forest of the true links of one part, from full shingle sets: those of which an end is
    marked in column ``asks``."""
    def run(table: pa.Table) -> pa.Table | None:
        reps, first = np.unique(table["rep"].to_numpy(), return_index=True)
        if len(reps) < 2:
            return None
        sets = []
        for i, j, buf, offsets in K.slices(table["text"].combine_chunks()):
            flat, cut = K.shingle_sets(buf, offsets, size)
            sets += [flat[cut[k] : cut[k + 1]] for k in range(j - i)]
        sets, asks = [sets[i] for i in first], table["asks"].to_numpy()[first]
        flat = np.concatenate(sets)
        sizes = np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        distinct, flat = np.unique(flat, return_inverse=True)
        mark, a, b = np.zeros(len(distinct), bool), [], []
        order = np.argsort(sizes, kind="stable")
        for at, i in enumerate(order.tolist()):
            later = order[at + 1 :]  # no smaller than this one; beyond size / share none can be linked
            later = later[: np.searchsorted(sizes[later], sizes[i] * 100 // percent, "right")]
            later = later if asks[i] else later[asks[later]]
            if not len(later):
                continue
            own = flat[starts[i] : starts[i] + sizes[i]]
            mark[own] = True
            for j in np.array_split(later, max(1, int(sizes[later].sum()) >> 20)):
                ends = np.cumsum(sizes[j])
                where = np.arange(ends[-1]) - np.repeat(ends - sizes[j] - starts[j], sizes[j])
                common = np.add.reduceat(mark[flat[where]].astype(np.int64), ends - sizes[j])
                hit = j[100 * common >= percent * (sizes[i] + sizes[j] - common)]
                a.append(np.full(len(hit), reps[i]))
                b.append(reps[hit])
            mark[own] = False
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        if not len(a):
            return None
        nodes, root = roots(a, b)
        keep = nodes != root
        return pa.table({"a": nodes[keep], "b": root[keep]})
    return run


def _chosen(deep: DataFrame) -> DataFrame:
    """(key, rep, n): of each row's regions on a path the shallowest that is small enough, else the deepest.

    A window counts a region's rows where they meet: no join brings all the depths' rows together with their counts.
    """
    sized = deep.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    best = F.when(F.col("n") <= REGION, F.col("depth")).otherwise(100 - F.col("depth"))
    return sized.groupBy("rep", "tree").agg(F.min_by(F.struct("key", "n"), best).alias("x")).select("x.key", "rep", "x.n")


def _likely_pairs(reps: DataFrame, least: float) -> DataFrame:
    """(a, b): spanning pairs of representatives whose signatures nearly agree in a region."""
    rows = stored(reps.select("rep", "sig").mapInArrow(_base_rows, "key long, rep long, tree int"), "forest")
    regions = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stored(rows.join(regions, "key"), "regions")
    big = met.where(F.col("n") > REGION).select("rep", "tree")
    deep = big.join(reps.select("rep", "sig"), "rep").mapInArrow(_deep_rows, "key long, rep long, tree int, depth int")
    if not big.limit(1).count():
        settled = met.select("key", "rep", "n")
    else:
        deep = stored(deep, "deeper")
        settled = met.where(F.col("n") <= REGION).select("key", "rep", "n").unionByName(_chosen(deep)).where("n > 1")
    settled = settled.join(reps.select("rep", "sig"), "rep")
    settled = in_blocks(settled, "rep", F.ceil(F.col("n") / REGION))
    return grouped(settled.select("key", "part", "rep", "sig"), ["key", "part"], _similar(least), "a long, b long")


def _blocks():
    """Blocks that hold so many documents and shingles."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))


def _left_over(members: DataFrame, linked: DataFrame) -> DataFrame:
    """What remains to compare in clusters of several slices: (cluster, part, rep, asks).

    Most of a cluster is linked by now; what is not in its largest component (column ``asks``) meets all
    others, block by block, and the members of that component do not meet each other again.
    """
    own = members.join(linked.withColumnRenamed("node", "rep"), "rep", "left").withColumn("g", F.coalesce("component", "rep"))
    own = stored(own.select("cluster", "rep", "n_shingles", "g"), "own")
    counts = own.groupBy("cluster", "g").agg(F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("s"))
    main = counts.groupBy("cluster").agg(F.max_by("g", F.struct("c", -F.col("g"))).alias("main"))
    rows = own.join(main, "cluster").withColumn("asks", F.col("g") != F.col("main"))
    size = rows.groupBy("cluster").agg(*[F.greatest(F.ceil(F.count_if(which) / BLOCK_DOCS), F.ceil(F.sum(F.when(which, F.col("n_shingles")))
                                                                                            / BLOCK_SHINGLES)).alias(name)
                                         for name, which in (("rest", F.col("asks")), ("done", ~F.col("asks")))]).where("rest > 0")
    rows = rows.join(size, "cluster")
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("asks"), F.col("rest")).otherwise(F.col("done")))
    rows = rows.withColumn("b", mine)
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    # parts 0 .. rest^2 - 1 are pairs of blocks left over, those after them one such block and one done
    among = F.transform(upto("rest"), lambda o: F.least(o, F.col("b")) * F.col("rest") + F.greatest(o, F.col("b")))
    first = F.col("rest") * F.col("rest")
    outward = F.transform(upto("done"), lambda o: first + F.col("b") * F.col("done") + o)
    inward = F.transform(upto("rest"), lambda o: first + o * F.col("done") + F.col("b"))
    parts = F.when(F.col("asks"), F.concat(among, outward)).otherwise(inward)
    return rows.select("cluster", F.explode(parts).alias("part"), "rep", "asks")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    percent: int = 85) -> DataFrame:
    """Groups of near-copies: (doc_id, n_shingles, component_id, kept).

    Two documents are linked when 100 * |A & B| >= percent * |A | B| of their shingle sets; a
    component is what links reach.  Null and empty texts have no shingles and stand alone; exact
    copies share a set, ties go to the smallest doc_id.  Repeated rows of one doc_id come back each
    (all of them, as one document; with different texts they count as one).  A null doc_id has a null
    component and is kept.  An empty table gives an empty result; other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = stored(source.mapInArrow(_signatures(size), _SETS), "sets")
    owners = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    keys = ["h1", "h2", "n_shingles"]
    reps = stored(owners.groupBy(*keys).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "reps")
    pairs = stored(_likely_pairs(reps, percent / 100 - MARGIN), "pairs")
    clusters = components(pairs, "a", "b").withColumnsRenamed({"node": "rep", "component": "cluster"})
    clusters = stored(clusters.join(reps.select("rep", "n_shingles"), "rep"), "clusters")

    # whole texts of the clustered representatives only: the bitmap spares the rest the shuffle
    bitmap = bitmap_of(clusters.select(F.xxhash64("rep").alias("h")), "h")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(wanted.value, batch["h"].to_numpy()))).select(["rep", "text"])

    texts = (source.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), "text", F.xxhash64("doc_id").alias("h"))
             .mapInArrow(likely, "rep long, text string"))
    sizes = clusters.groupBy("cluster").agg(_blocks().alias("n"))
    slices = stored(clusters.join(sizes, "cluster").select("cluster", "rep", "n_shingles", "n"), "slices")
    own = F.pmod(F.xxhash64("rep"), F.col("n"))
    # a cluster of one slice is compared whole, a larger one with its pivots first
    once = slices.select("cluster", own.alias("part"), "rep", (F.col("n") == 1).alias("asks"))
    votes = pairs.groupBy(F.col("a").alias("rep")).agg(F.count(F.lit(1)).alias("votes"))
    pivots = (slices.where("n > 1").join(votes, "rep").groupBy("cluster", "n", F.pmod(F.xxhash64("rep"), F.lit(PIVOTS)).alias("turn"))
              .agg(F.max_by("rep", F.struct("votes", -F.col("rep"))).alias("rep")))
    pivots = pivots.select("cluster", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("part"), "rep", F.lit(True).alias("asks"))
    rows = once.unionByName(pivots).groupBy("cluster", "part", "rep").agg(F.bool_or("asks").alias("asks"))

    def verified(rows: DataFrame) -> DataFrame:
        part = rows.join(texts, "rep").select("cluster", "part", "rep", "asks", "text")
        return grouped(part, ["cluster", "part"], _links(size, percent), "a long, b long")

    links = stored(verified(rows), "links")
    if slices.where("n > 1").limit(1).count():
        links = links.unionByName(verified(_left_over(slices.where("n > 1"), components(links, "a", "b"))))
    linked = components(links, "a", "b").withColumnsRenamed({"node": "rep"})

    found = (reps.select(*keys, "rep").join(linked, "rep", "left")
             .select(*keys, F.coalesce("component", "rep").alias("component_id")))
    out = (sets.drop("sig").join(found, keys, "left")
           .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
           .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))))
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                            percent: int = 85) -> DataFrame:
    """The documents with the smallest id of each group of near-copies, with their columns.  Of rows
    that repeat an id and a text one stays, of other texts under the id one each; rows with a null id stay."""
    found = stored(near_duplicates(docs, id_col, text_col, size, percent).select("doc_id", "kept"), "kept")
    gone = stored(found.where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    few = gone.count() <= FEW_IDS  # then whole texts need not be shuffled to leave some out
    left = docs.join(F.broadcast(gone) if few else gone, F.col(id_col) == F.col("__gone"), "left_anti")
    again = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = stored(again.where("n > 1").select(F.col("doc_id").alias("__again")), "again")
    if again.limit(1).count():
        met = F.col(id_col) == F.col("__again")
        left = left.join(again, met, "left_anti").unionByName(left.join(again, met, "left_semi").dropDuplicates([id_col, text_col]))
    return left
