"""Quality by importance resampling (operator 3).

Two generative models over hashed n-grams - words, word pairs, word shapes and their runs, repeats -
give each document the log ratio log p_target(text) / p_raw(text): the target model is counted on a
bounded sample of documents labelled good, the raw model on all documents.  Documents are then sampled
without replacement by Gumbel top-k: of ``log ratio + Gumbel noise`` the k largest keys stay.

k is the number of documents whose log ratio is at least a cut fitted on the labelled sample: the
log ratio that best parts good from bad, moved down until at most ``MOST_LOST`` of the good ones lie
below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import kernels as K
from quarry.llm.shared import stored
from quarry.operators.order_stats import kth_smallest

#: Buckets: word n-grams in the lower half, shapes and repeats in the upper.
BITS = 15
HALF = 1 << (BITS - 1)
#: Labelled documents that the target model and the cut may see, of each label, by hash of the id.
FIT_DOCS = 20_000
MOST_LOST = 0.002
SMOOTH = 0.5

_kind = np.zeros((256, 4), np.int32)  # lower case or multi-byte, upper case, digit, other but . and ,
_kind[[*range(97, 123), *range(128, 256)], 0] = 1
_kind[range(65, 91), 1] = 1
_kind[range(48, 58), 2] = 1
_kind[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,"], 3] = 1


def _shapes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Small code of a word's form: cases, digits, symbols, length."""
    code = np.zeros(len(starts), np.uint64)
    for k in range(4):
        total = np.concatenate([[0], np.cumsum(_kind[buf, k], dtype=np.int64)])
        code = code * K.U64(3) + np.minimum(total[ends] - total[starts], 2).astype(np.uint64)
    return code * K.U64(8) + np.digitize(ends - starts, [2, 4, 7, 11, 16, 32]).astype(np.uint64)


def ngrams(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram of the texts of a slice."""
    starts, ends, word = K.words(buf, offsets)
    spans = np.searchsorted(starts, offsets)
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(spans))
    shape = K.mix(_shapes(buf, starts, ends))
    texts, buckets = [text], [word >> K.U64(65 - BITS)]
    texts.append(text)
    buckets.append((shape >> K.U64(65 - BITS)) + K.U64(HALF))
    for source, sizes, base in ((word, (2,), 0), (shape, (2, 3), HALF)):
        for n in sizes:
            grams, at = K.windows(source, spans, n)
            texts.append(text[at])
            buckets.append((grams >> K.U64(65 - BITS)) + K.U64(base))
    for gap in (1, 2):  # a word again: one bucket whatever the word, and one for the first time
        if len(word) > gap:
            here = np.flatnonzero(text[gap:] == text[:-gap])
            again = (word[here + gap] == word[here]).astype(np.uint64)
            texts.append(text[here])
            buckets.append(K.mix(again + K.U64(10 * gap)) % K.U64(HALF) + K.U64(HALF))
    return np.concatenate(texts), np.concatenate(buckets).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BITS, np.int64)  # all of a task's counts: one row a bucket at most
    for batch in batches:
        for _, _, buf, offsets in K.slices(batch["text"]):
            total += np.bincount(ngrams(buf, offsets)[1], minlength=1 << BITS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def _model(texts: DataFrame) -> np.ndarray:
    """Log probability of each bucket."""
    counts = texts.mapInArrow(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.full(1 << BITS, SMOOTH)
    total[counts["bucket"].to_numpy()] += counts["n"].to_numpy()
    for half in (slice(0, HALF), slice(HALF, None)):
        total[half] /= total[half].sum()
    return np.log(total)


def _cut(good: np.ndarray, bad: np.ndarray) -> float:
    """Log ratio that parts good from bad, losing at most MOST_LOST of the good."""
    good, bad = np.sort(good), np.sort(bad)
    if not len(good) or not len(bad):
        return -np.inf
    at = np.unique(np.concatenate([good, bad]))
    lost = np.searchsorted(good, at) / len(good)
    passed = 1 - np.searchsorted(bad, at) / len(bad)
    cost = np.where(lost <= MOST_LOST, lost + passed, np.inf)
    best = int(np.argmin(cost))
    return float(at[best] if best == 0 else (at[best] + at[best - 1]) / 2)


class Resampler:
    """The fitted ratio and cut; ``scored`` gives any documents their log weight and key."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, seed: int):
        self.id_col, self.text_col, self.seed = id_col, text_col, seed
        text = F.col(text_col).cast("string").alias("text")
        marked = (labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("__good"))
                  .where("__id IS NOT NULL AND __good IN (0, 1)").groupBy("__id").agg(F.min("__good").alias("__good")))
        # at most 2 * FIT_DOCS ids: small enough to broadcast
        few = [marked.where(F.col("__good") == v).orderBy(F.xxhash64("__id"), "__id").limit(FIT_DOCS) for v in (0, 1)]
        fit = stored(docs.join(F.broadcast(few[0].unionByName(few[1])), F.col(id_col) == F.col("__id"))
                     .select(text, F.col("__good").alias("good")), "labelled")
        target, raw = _model(fit.where("good = 1").select("text")), _model(docs.select(text))
        self.ratio = docs.sparkSession.sparkContext.broadcast((target - raw).astype(np.float64))
        seen = fit.select("good", self.log_weight(F.col("text")).alias("w")).toArrow()  # two numbers a labelled row
        good, w = seen["good"].to_numpy(), seen["w"].to_numpy()
        self.cut = _cut(w[good == 1], w[good == 0])

    def log_weight(self, text):
        ratio = self.ratio

        @F.arrow_udf("double")
        def weigh(column: pa.Array) -> pa.Array:
            out = []
            for i, j, buf, offsets in K.slices(column):
                text, bucket = ngrams(buf, offsets)
                out.append(np.bincount(text, weights=ratio.value[bucket], minlength=j - i))
            return pa.array(np.concatenate(out) if out else np.zeros(0))
        return weigh(text)

    def scored(self, docs: DataFrame) -> DataFrame:
        """``docs`` with __log_weight and __key (log weight plus Gumbel noise seeded by the id)."""
        draw = F.shiftrightunsigned(F.xxhash64(F.lit(self.seed), F.col(self.id_col)), 11).cast("double")
        gumbel = -F.log(-F.log((draw + 0.5) / float(1 << 53)))
        return (docs.withColumn("__log_weight", self.log_weight(F.col(self.text_col).cast("string")))
                .withColumn("__key", F.col("__log_weight") + gumbel))

    def least_key(self, keys: DataFrame) -> float:
        """The k-th largest key, k as the module says; rows (log_weight, key)."""
        total, k = keys.agg(F.count(F.lit(1)), F.count_if(F.col("log_weight") >= self.cut)).first()
        if k in (0, total):
            return float("inf") if k < total else float("-inf")
        asks = keys.sparkSession.createDataFrame([(1, total - k + 1)], "req int, k long")
        return kth_smallest(keys, "key", asks).first()["kth"]


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             seed: int = 3) -> DataFrame:
    """(doc_id, log_weight, key, kept) of every document.

    A null or empty text has log weight 0.  Documents with equal keys at the cut all stay; rows that
    repeat an id and text share key and fate; a null id draws its own noise.  Labels that are null or
    other than 0 and 1 are left out, an id labelled twice counts as its lesser label; without labels
    of both kinds everything is kept.  An empty table gives an empty result.
    """
    model = Resampler(docs, labels, id_col, text_col, seed)
    keys = model.scored(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col("__log_weight").alias("log_weight"),
                                     F.col("__key").alias("key"))
    keys = stored(keys, "keys")
    return keys.withColumn("kept", F.col("key") >= F.lit(model.least_key(keys)))


def keep_sampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = 3) -> DataFrame:
    """The documents that ``resample`` keeps, with their columns.  Keys are worked out again
    instead of joined, so no text is shuffled."""
    model = Resampler(docs, labels, id_col, text_col, seed)
    scored = model.scored(docs)
    keys = stored(scored.select(F.col("__log_weight").alias("log_weight"), F.col("__key").alias("key")), "keys")
    return scored.where(F.col("__key") >= F.lit(model.least_key(keys))).drop("__log_weight", "__key")
