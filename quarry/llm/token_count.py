"""Token counts by byte-pair merging (operator 4): initial symbols minus merges, no ids made.

The texts go through one Arrow pass.  A text is cut at single spaces between two non-space
characters, where the byte-level pre-tokeniser always starts a new piece, and the count of every such
stretch is remembered per worker (bounded), so the merging runs once per distinct word.
"""

from __future__ import annotations

import heapq
import json
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import Remembered, small_batches

#: Fixed value: the byte-level pre-tokeniser's pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                       r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: A space where a piece surely starts: white space on neither side.
_CLEAN = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s | \s")
#: Characters of a text handled at once, and stretches remembered.
STEP, REMEMBERED = 1 << 20, 400_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if visible, else the next of U+0100, U+0101, ..."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        out.append(chr(b if b in visible else spare))
        spare += b not in visible
    return out


class PairMerger(Remembered):
    """Token counts of stretches (each with a space before it), worked out when first asked for."""

    def __init__(self, vocabulary: bytes):
        super().__init__(REMEMBERED)
        spec = json.loads(vocabulary)
        ids = spec["model"]["vocab"]
        self.first = [ids[s] for s in byte_symbols()]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.marks = lru_cache(10_000)(self.stretch)
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.quick = special

    def merged(self, piece: bytes) -> int:
        """Symbols left of one piece: pop the lowest-ranked adjacent pair (leftmost first) from a
        heap, join it in the linked list, push its two new neighbours; stale entries are skipped."""
        n = left = len(piece)
        if n < 2:
            return n
        symbol = [self.first[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        heap = [(*m, i) for i in range(n - 1) if (m := merges.get((symbol[i], symbol[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, made, i = heapq.heappop(heap)
            j = after[i]
            if symbol[i] is None or j >= n or merges.get((symbol[i], symbol[j])) != (rank, made):
                continue
            symbol[i], symbol[j], left = made, None, left - 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((made, symbol[k])):
                    heapq.heappush(heap, (*m, i))
            if (h := before[i]) >= 0 and (m := merges.get((symbol[h], made))):
                heapq.heappush(heap, (*m, h))
        return left

    def stretch(self, text: str) -> int:
        return sum(self.merged(p.encode()) for p in PIECES.findall(text))

    def made(self, part: str) -> int:
        head = part.rstrip(string.punctuation)
        if head != part and head.isalpha():  # letters, then one piece of marks
            return self[head] + self.marks(part[len(head) :])
        return self.stretch(f" {part}")

    def plain(self, text: str) -> int:
        total, at = 0, 0
        while at < len(text):
            cut = _CLEAN.search(text, at + STEP) if len(text) - at > STEP else None
            piece = text[at : cut.start()] if cut else text[at:]
            parts = _CLEAN.split(piece) if _ODD.search(piece) else piece.split(" ")
            # the first stretch of the text has no space before it, those of later cuts have
            total += sum(map(self.__getitem__, parts[1:])) + (self[parts[0]] if at else self.stretch(parts[0]))
            at = cut.end() if cut else len(text)
        return total

    def count(self, text: str) -> int:
        if self.special and any(s in text for s in self.quick):
            pieces = self.special.split(text)
            return len(pieces) - 1 + sum(map(self.plain, pieces))
        return self.plain(text)


@lru_cache(maxsize=2)
def merger(vocabulary: bytes) -> PairMerger:
    return PairMerger(vocabulary)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text.

    A null text counts as empty: 0 bytes, 0 tokens.  One row per input row, repeated rows and null
    ids included; an empty table gives none; other columns are not read.  A special token's string
    inside a text counts as one token, as the library has it by default.
    """
    small_batches(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: a few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merger(vocabulary.value)
        for batch in batches:
            counts = [counter.count(t.as_py() or "") for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
