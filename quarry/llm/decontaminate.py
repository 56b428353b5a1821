"""Benchmark decontamination by template canonicalisation (operator 5).

Texts become templates: words of letters and digits, lower-cased, where numbers (digits or number
words; runs of them are one), units after a number, and names (capitalised words inside a sentence,
or several that open one; runs of them are one) are typed placeholders.  Windows of ``SIZE`` template words are hashed and joined
with those of the benchmark, so a question asked again with other numbers or names still matches.
A match at one alignment counts only if its slots are consistent: wherever the item repeats a value,
the document repeats the value it put there.

A window of ``SIZE`` plain words (case-folded, nothing replaced) is matched beside it, for copies whose
names are in another case and for items dense in numbers or names.  What is too short for a window is
one window of all it has.

An item has leaked into a document when, of one kind, the consistent windows cover ``SHARE`` of the item's windows
or ``LONG`` of them.  The benchmark's window hashes reach the tasks as a bitmap of fixed size that lets
through nearly nothing else; the join itself is an ordinary hash join of what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import kernels as K
from quarry.llm.shared import bitmap_of, in_bitmap, stored

#: Template words a window, and how many of them must be words: a window of slots proves nothing.
SIZE, LITERALS = 8, 5
SHARE, LONG = 0.4, 20

#: Number words and units.
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
billion dozen half""".split()
UNITS = """mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet ft yard
yards mile miles mi mg g kg gram grams kilogram kilograms ton tons tonne tonnes ounce ounces oz pound pounds lb lbs ml
l liter liters litre litres gallon gallons cup cups second seconds s sec minute minutes min hour hours h hr day days
week weeks month months year years cent cents dollar dollars usd euro euros eur gbp percent degree degrees celsius
fahrenheit mph kph km/h volt volts watt watts kw joule joules""".split()


def _hash_of(words: list[str]) -> np.ndarray:
    data = "\n".join(words).encode()
    return np.unique(K.words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), K.LETTERS)[2])


_NUMBERS, _UNITS = _hash_of(NUMBER_WORDS), _hash_of([u for u in UNITS if u.isalpha()])
_SLOT = [K.mix(np.array([n], np.uint64))[0] for n in (101, 102, 103)]  # number, unit, name
_digit = np.zeros(256, bool)
_digit[48:58] = True
_upper = np.zeros(256, bool)
_upper[65:91] = True
_small = np.zeros(256, bool)
_small[[*range(97, 123), *range(128, 256)]] = True
_stop = np.zeros(256, np.int64)
_stop[[ord(c) for c in ".!?\n:"]] = 1


def _known(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return table[at] == hashes


def template(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(template hashes, original hashes, is-slot, template offsets of the texts, plain words, their offsets)."""
    starts, ends, word = K.words(buf, offsets, K.LETTERS)
    spans = np.searchsorted(starts, offsets)
    n = len(word)
    if not n:
        return word, word, np.zeros(0, bool), spans, word, spans
    opening = np.zeros(n, bool)  # first of its text
    opening[spans[:-1][spans[:-1] < n]] = True
    head = buf[starts]
    number = _digit[head] | _known(word, _NUMBERS)
    after = np.concatenate([[False], number[:-1]]) & ~opening
    unit = after & _known(word, _UNITS)
    # capital first letter (A-Z, or a two-byte letter U+00C0-U+00DE) before a small one: not all capitals
    def wide(at):
        return (buf[np.minimum(at, len(buf) - 1)] == 0xC3) & (buf[np.minimum(at + 1, len(buf) - 1)] < 0x9F)
    second = starts + 1 + wide(starts)
    small = (second < ends) & _small[buf[np.minimum(second, len(buf) - 1)]] & ~wide(second)
    capital = (_upper[head] | wide(starts)) & small
    stops = np.concatenate([[0], np.cumsum(_stop[buf])])
    follows = np.concatenate([[True], stops[starts[1:]] > stops[ends[:-1]]]) | opening
    name = capital & ~follows & ~number & ~unit
    # a sentence that opens with a name of several words
    name |= capital & follows & np.append(name[1:] & ~opening[1:], False)
    kind = np.where(number, 1, np.where(unit, 2, np.where(name, 3, 0)))
    same = np.concatenate([[False], (kind[1:] == kind[:-1]) & (kind[1:] != 2) & (kind[1:] > 0)]) & ~opening
    keep = np.flatnonzero(~same)
    # a run of numbers or names is one slot, its value the run
    value = K.run_hashes(word, np.append(keep, n))
    kind = kind[keep]
    slots = np.where(kind > 0, np.array([0, *_SLOT], np.uint64)[kind], word[keep])
    return slots, value, kind > 0, np.searchsorted(keep, spans), word, spans


def _runs(words: np.ndarray, spans: np.ndarray, size: int, plain: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of ``size`` words; runs of another kind or length never agree."""
    hashes, at = K.windows(words, spans, size)
    return K.mix(hashes ^ K.U64(2 * size + plain)), at


def _all_windows(buf: np.ndarray, offsets: np.ndarray, lengths: list[tuple[int, int]] | None):
    """(plain, words, text, place, hash, at, is-slot, values) of each kind and length of window: those in
    ``lengths``, or for items (None) the windows of ``SIZE`` and else one of all the text has."""
    slots, value, slot, spans, word, word_spans = template(buf, offsets)
    known = np.concatenate([[0], np.cumsum(~slot)])
    for plain, words, cut in ((0, slots, spans), (1, word, word_spans)):
        sizes = np.diff(cut)
        # a template needs so many literal words: what has fewer is compared by its plain words
        for size in [n for k, n in lengths if k == plain] if lengths is not None else range(1 if plain else LITERALS, SIZE + 1):
            hashes, at = _runs(words, cut, size, bool(plain))
            text = np.searchsorted(cut, at, "right") - 1
            keep = np.ones(len(at), bool) if plain else known[at + size] - known[at] >= LITERALS
            if lengths is None and size < SIZE:
                keep &= sizes[text] == size
            yield plain, size, text[keep], (at - cut[text])[keep], hashes[keep], at[keep], slot, value


def _slot_values(at: int, size: int, slot: np.ndarray, value: np.ndarray) -> bytes:
    """Value of each template word of a window if it is a slot, else 0."""
    values = np.zeros(SIZE, np.uint64)
    values[:size] = np.where(slot[at : at + size], value[at : at + size], K.U64(0))
    return values.tobytes()


def _windows(wanted, key: str, lengths: list[tuple[int, int]] | None = None):
    """Rows (key, plain, size, place, h, slots) of the windows; of documents only those the bitmap lets through."""
    nothing = bytes(8 * SIZE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in K.slices(batch["text"]):
                for plain, size, text, place, hashes, at, slot, value in _all_windows(buf, offsets, lengths):
                    if wanted is not None:
                        hit = in_bitmap(wanted.value, hashes)
                        text, place, hashes, at = text[hit], place[hit], hashes[hit], at[hit]
                    n = len(at)
                    values = [nothing] * n if plain else [_slot_values(a, size, slot, value) for a in at.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [batch[key][i:j].take(pa.array(text)), pa.array(np.full(n, plain, np.int64)),
                         pa.array(np.full(n, size, np.int64)), pa.array(place), pa.array(hashes.view(np.int64)),
                         pa.array(values, pa.binary())], [key, "plain", "size", "place", "h", "slots"])
    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, item_id, plain, shift, item place, item value, document value) of each window match: a row a
    slot, and one without values for the window itself."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        doc, item = (np.frombuffer(b"".join(batch[c].to_pylist()), np.int64).reshape(n, SIZE) for c in ("slots", "item_slots"))
        row, slot = np.nonzero(item)
        rows = np.concatenate([np.arange(n), row])
        nothing = np.zeros(n, bool)
        values = [pa.array(np.concatenate([np.zeros(n, np.int64), x[row, slot]]),
                           mask=np.concatenate([~nothing, np.zeros(len(row), bool)])) for x in (item, doc)]
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays([batch[c].take(take) for c in ("doc_id", "item_id", "plain", "shift", "place")] + values,
                                         ["doc_id", "item_id", "plain", "shift", "place", "item_value", "doc_value"])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, windows, item_windows): documents that hold a benchmark item, maybe with other
    numbers, names or units.

    ``windows`` counts template windows, or plain ones where the template alone does not tell.  An item
    of fewer than ``SIZE`` words is found where all of it stands in one run, be it a single word.  Null
    texts and texts without words leak nothing; rows with a null id take no part; rows that repeat an id are read as one document,
    repeated items as one.  Empty tables give an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    kind = "{} long, plain long, size long, place long, h long, slots binary"
    theirs = stored(items.where("item_id IS NOT NULL").mapInArrow(_windows(None, "item_id"), kind.format("item_id"))
                    .distinct(), "items")
    wanted = spark.sparkContext.broadcast(bitmap_of(theirs, "h"))
    lengths = sorted((r["plain"], r["size"]) for r in theirs.select("plain", "size").distinct().collect())  # 2 x SIZE at most
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ours = rows.where("doc_id IS NOT NULL").mapInArrow(_windows(wanted, "doc_id", lengths), kind.format("doc_id"))
    met = ours.select("doc_id", "h", "slots", F.col("place").alias("at")).join(theirs.withColumnRenamed("slots", "item_slots"), "h")
    met = met.select("doc_id", "item_id", "plain", (F.col("at") - F.col("place")).alias("shift"), "place", "slots", "item_slots")
    seen = stored(met.mapInArrow(_pairs, "doc_id long, item_id long, plain long, shift long, place long, item_value long, doc_value long"),
                  "matches")
    spot = ["doc_id", "item_id", "plain", "shift"]
    broken = (seen.where("item_value IS NOT NULL").groupBy(*spot, "item_value")
              .agg(F.min("doc_value").alias("a"), F.max("doc_value").alias("b")).where("a <> b").select(*spot).distinct())
    covered = (seen.where("item_value IS NULL").select(*spot, "place").join(broken, spot, "left_anti")
               .groupBy("doc_id", "item_id", "plain").agg(F.count_distinct("place").alias("windows")))
    sizes = theirs.groupBy("item_id", "plain").agg(F.count_distinct("place").alias("item_windows"))
    enough = F.col("windows") >= F.least(F.lit(LONG), F.ceil(F.col("item_windows") * SHARE))
    found = covered.join(sizes, ["item_id", "plain"]).where(enough)
    first = F.min(F.struct("plain", "windows", "item_windows")).alias("x")
    return found.groupBy("doc_id", "item_id").agg(first).select("doc_id", "item_id", "x.windows", "x.item_windows")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with their columns; rows with a null id stay."""
    found = leaks(docs, benchmark, id_col, text_col).select("doc_id").distinct()
    found = stored(found.withColumnRenamed("doc_id", "__leaked"), "leaked")
    return docs.join(found, F.col(id_col) == F.col("__leaked"), "left_anti")
