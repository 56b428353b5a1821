"""Packing documents into sequences of fixed length (operator 13).

Documents become pieces of at most ``capacity`` tokens.  What is solved is the configuration linear
program over the histogram of piece lengths (at most ``capacity`` numbers, whatever the data): how many
sequences to fill in which way, a way being a multiset of lengths that fits.  Multiplicative weights
give each length a price, which falls as its pieces are placed; the dearest way at these prices is
found by dynamic programming over the capacity and taken for a ``1 / STEPS`` share of all sequences, or
less where a length runs out.  The solution is rounded down to whole sequences; the pieces left over
go, longest first, where they fit best.

The plan says which slots there are for each length.  A piece finds its slot by its number among all
pieces of its length: its number within its partition plus those of the partitions before, a prefix
sum over (partition, length) counts.  So no length is gathered in one task, hot or not.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.shared import small_batches, stored
from quarry.llm.token_count import byte_symbols

#: The largest share of all sequences filled in one way is 1 / STEPS.
STEPS = 200
#: How much dearer longer pieces are per token, and how prices fall with the share already placed.
LONG, RATE = 1.1, 0.5
#: Share of the tokens left to the rounding.
REST = 0.03
#: Characters of a text handled at once.
STEP = 1 << 17

# --- token ids ------------------------------------------------------------------------------------

#: Where a byte-level piece surely starts: a single space or line break between two other characters.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Fixed value: the pieces of the byte-level pre-tokeniser.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TextIds:
    """Ids of whole texts, as little-endian unsigned 32-bit numbers, as the tokenizers library has them.

    Where the vocabulary is a plain byte-level one whose ids rise with the rank of their merge, tiktoken
    merges by the same ranks at a quarter of the cost.  Texts with a special token's string, stretches of
    over ``2 * STEP`` characters without a cut and vocabularies of another kind go to the library.
    """

    def __init__(self, vocabulary: bytes):
        self.library = Tokenizer.from_buffer(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.quick = self._ranked(json.loads(vocabulary))

    def _ranked(self, spec: dict) -> tiktoken.Encoding | None:
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
                 and spec.get("normalizer") is None and model.get("type", "BPE") == "BPE" and not model.get("dropout")
                 and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        if not plain:
            return None
        octet = {s: b for b, s in enumerate(byte_symbols())}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(pair)] for pair in pairs]
        base = [model["vocab"].get(s, -1) for s in octet]
        if min(base) < 0 or made != sorted(set(made)) or (made and max(base) > made[0]):
            return None
        ranks = {bytes(octet[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        return tiktoken.Encoding("vocabulary", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not self.quick or any(s in text for s in self.special):
            return self.whole(text)
        found, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + STEP) if len(text) - at > STEP else None
            some = text[at : cut.start()] if cut else text[at:]
            found.append(np.array(self.quick.encode_ordinary(some), "<u4").tobytes() if len(some) <= 2 * STEP else self.whole(some))
            at += len(some)
        return b"".join(found)


@lru_cache(maxsize=1)
def encoder(vocabulary: bytes) -> TextIds:
    return TextIds(vocabulary)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of all documents, with partition and number among the partition's pieces of that length."""
    small_batches(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, part = encoder(vocabulary.value), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        met: Counter[int] = Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                data = memoryview(ids.encode(text.as_py() or "") + end)
                n = len(data) // 4
                cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(data[4 * a : 4 * b]), part, met[b - a]))
                    met[b - a] += 1
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in PIECES.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


# --- the configuration program --------------------------------------------------------------------


def dearest(lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths of highest price that fits, no length more than ``most`` times: the
    knapsack's dynamic program, one numpy step for each power of two copies of a length."""
    best = np.zeros(capacity + 1)
    steps = []
    for length, price, copies in zip(lengths.tolist(), prices.tolist(), most.tolist()):
        some = 1
        while copies > 0:
            some = min(some, copies)
            size = some * length
            if size <= capacity:
                other = best[: capacity + 1 - size] + some * price
                better = other > best[size:]
                np.copyto(best[size:], other, where=better)
                steps.append((length, some, better))
            copies -= some
            some *= 2
    taken: dict[int, int] = {}
    room = capacity
    for length, some, better in reversed(steps):
        size = some * length
        if room >= size and better[room - size]:
            taken[length] = taken.get(length, 0) + some
            room -= size
    return taken


def configurations(counts: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[dict[int, int], float]]:
    """Ways to fill a sequence and how many sequences (a fraction too) to fill so, by multiplicative
    weights; together they place at most ``counts`` pieces, and all but ``REST`` of the tokens."""
    sizes = np.arange(capacity + 1)
    left = counts.astype(float)
    tokens = float(sizes @ left)
    share = tokens / capacity / steps
    total = np.maximum(left, 1)
    found = []
    while sizes @ left > REST * tokens:
        lengths = np.flatnonzero(left > 1e-9)[::-1]
        now = left[lengths]
        prices = lengths**LONG * np.exp(RATE * now / total[lengths])
        most = np.minimum(np.maximum(now / share, 1), capacity // lengths).astype(int)
        way = dearest(lengths, prices, most, capacity)
        amount = min([share, *(left[n] / k for n, k in way.items())])
        for n, k in way.items():
            left[n] -= amount * k
        found.append((way, amount))
    return found


def whole_plan(counts: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[dict[int, int], int]]:
    """Ways and whole numbers of sequences that place exactly ``counts[n]`` pieces of each length n."""
    left = counts.astype(np.int64)
    done = [({capacity: 1}, int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    room: list[list[tuple[dict[int, int], int]]] = [[] for _ in range(capacity + 1)]
    free = np.zeros(capacity + 1, bool)

    def put(way: dict[int, int], n: int) -> None:
        space = capacity - sum(a * b for a, b in way.items())
        if space:
            room[space].append((way, n))
            free[space] = True
        else:
            done.append((way, n))

    for way, amount in configurations(left, capacity, steps):
        if n := int(amount + 1e-9):
            for length, k in way.items():
                left[length] -= n * k
            put(way, n)
    for length in range(capacity, 0, -1):
        while k := int(left[length]):
            spaces = np.flatnonzero(free[length:])
            if len(spaces):
                space = int(spaces[0]) + length
                way, n = room[space].pop()
                free[space] = bool(room[space])
                put({**way, length: way.get(length, 0) + 1}, min(k, n))
                if n > k:
                    put(way, n - k)
                left[length] -= min(k, n)
            else:
                each = min(capacity // length, k)
                put({length: each}, k // each)
                left[length] -= k // each * each
    return done + [entry for some in room for entry in some]


class Slots:
    """For each length, where its pieces go: runs of slots, looked up by a piece's number."""

    def __init__(self, plan: list[tuple[dict[int, int], int]]):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for way, n in plan:
            at = 0
            for length, k in sorted(way.items(), reverse=True):
                runs.setdefault(length, []).append((n * k, sequence, k, at))
                at += length * k
            sequence += n
        self.runs = {n: np.array(r, np.int64).T for n, r in runs.items()}
        self.first = {n: np.cumsum(r[0]) - r[0] for n, r in self.runs.items()}

    def __call__(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for rows in np.split(order, cuts) if len(order) else ():
            length = int(lengths[rows[0]])
            _, base, each, at = self.runs[length]
            run = np.searchsorted(self.first[length], numbers[rows], "right") - 1
            inside = numbers[rows] - self.first[length][run]
            sequence[rows] = base[run] + inside // each[run]
            offset[rows] = at[run] + inside % each[run] * length
        return sequence, offset


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pack all documents: (doc_id, piece, start, length, ids_crc32, sequence_id, offset) of each piece.

    A document is the ids of its whole text and ``end_id``; one of more than ``capacity`` ids is cut into
    pieces of ``capacity``, the first of which may be shorter.  A null text is empty (one id); repeated
    rows and null ids are packed like others; an empty table gives none; other columns are not read.
    Which of the pieces of one length goes where follows the partitions of the input.  The driver holds
    the histogram and the plan; both are bounded by ``capacity``, as is the time to solve it
    (capacity squared; for sequences far beyond ten thousand tokens, merge lengths first).
    """
    pieces = stored(pieces_of(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    spark = pieces.sparkSession
    blocks = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "blocks")
    histogram = blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["n"]
    slots = spark.sparkContext.broadcast(Slots(whole_plan(counts, capacity)))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.value(batch["length"].to_numpy(), batch["number"].to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             [c.split(" ")[0] for c in schema.split(", ")])

    numbered = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("number"))
    return numbered.mapInArrow(place, schema)
