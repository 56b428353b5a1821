"""Spelling variants of words (operator 12).

Words are counted in one pass and a shuffle.  Two words one edit apart (a code point inserted, deleted
or replaced) have lengths that differ by one at most and letter counts at a squared distance of two at
most.  Squared distances of whole blocks of words come from one matrix product each, the block's Gram
matrix of letter counts; pairs within two are then verified, edit by edit.

A block holds words of one length and of the next.  As such a pair differs in the counts of two letters
at most, of ``GROUPS`` groups of letters it has equal counts in all but two; a block is therefore the
words that agree in all groups but two, once for each choice of the two, and no pair is lost.  A block
of more than ``TILE`` words is cut into tiles by word hash, and each pair of tiles is a task of its own.
A pair is reported by the first choice of groups it agrees on, so once.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import small_batches, stored

#: Letters are counted by code point modulo SLOTS: letters that share a slot only bring words nearer.
SLOTS = 96
#: Groups of letters, and words of a block compared in one matrix product.
GROUPS, TILE = 4, 2048
#: Distinct words counted in a task before they are passed on; bytes of a long text handled at once.
HELD, STEP = 100_000, 4 << 20

# --- counting -------------------------------------------------------------------------------------

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Runs of a-z and U+00C0-U+00FF in UTF-8, and a byte that is surely outside one.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_OUTSIDE = re.compile(rb"[^a-z\x80-\xff]")


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        cut = _OUTSIDE.search(text, at + STEP) if len(text) - at > STEP else None
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def word_counts(docs: DataFrame, least_letters: int = 6, least_count: int = 5, typos: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the runs of ``[A-Za-z\\u00C0-\\u00FF]`` of all texts, A-Z as a-z, of at least
    ``least_letters`` code points and ``least_count`` occurrences.

    ``typos`` plants variants: a run whose ``h`` = crc32 of ``<doc_id>:<run>`` it divides loses the code
    point ``h % length`` (runs of a null id stay as they are).  Null and empty texts have no runs;
    repeated rows count each; other columns are not read.
    """
    small_batches(docs.sparkSession)

    def changed(run: bytes, h: int) -> bytes:
        letters = run.decode()
        at = h % len(letters)
        return (letters[:at] + letters[at + 1 :]).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) - w.count(b"\xc3") >= least_letters]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in kept], pa.string()),
                                               pa.array([n for _, n in kept], pa.int64())], ["word", "n"])
        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                start = zlib.crc32(f"{doc_id}:".encode()) if typos and doc_id is not None else None
                for text in _pieces((value.as_py() or "").encode().translate(_LOWER)):
                    found = Counter(_RUN.findall(text))
                    if start is not None:
                        hit = [(w, h) for w in found if (h := zlib.crc32(w, start)) % typos == 0]
                        for w, n in [(changed(w, h), found.pop(w)) for w, h in hit]:
                            held[w] += n
                    held.update(found)
                    if len(held) >= HELD:
                        yield out()
        yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# --- near words -----------------------------------------------------------------------------------


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (code points, one word a row; ``b`` as long or longer by one) are
    one edit apart: what they share at the front and at the back leaves one code point."""
    n, m = a.shape[1], b.shape[1]
    if not n:
        return np.full(len(a), m == 1)

    def shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        other = x != y
        return np.where(other.any(1), other.argmax(1), n)
    front, back = shared(a, b[:, :n]), shared(a[:, ::-1], b[:, ::-1][:, :n])
    return (front + back == n - 1) if n == m else (front + back >= n)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def _counts(codes: np.ndarray) -> np.ndarray:
    slot = codes % SLOTS + np.arange(len(codes))[:, None] * SLOTS
    exact = np.float32 if codes.shape[1] <= 4096 else np.float64  # its squares stay whole numbers
    return np.bincount(slot.ravel(), minlength=len(codes) * SLOTS).reshape(-1, SLOTS).astype(exact)


class Blocks:
    """Which block a word belongs to for each choice of groups, and the near pairs inside a block."""

    def __init__(self, group: np.ndarray):
        self.choices = list(itertools.combinations(range(GROUPS), GROUPS - 2))
        # which choice reports a pair that differs in the groups of a bit mask
        self.first = np.array([next((c for c, some in enumerate(self.choices) if not any(m >> g & 1 for g in some)), -1)
                               for m in range(1 << GROUPS)])
        rng = np.random.default_rng(12)
        weight = rng.integers(1, 1 << 62, SLOTS)
        self.weights = np.where(group[:, None] == np.arange(GROUPS), weight[:, None], 0)
        self.salt = rng.integers(0, 1 << 62, (len(self.choices), GROUPS)) | 1

    def group_hashes(self, codes: np.ndarray) -> np.ndarray:
        """One number per word and group, equal where the counts of the group's letters are."""
        return self.weights[codes % SLOTS].sum(1)

    def keys(self, words: list[str]) -> np.ndarray:
        """(words, choices) block numbers, lengths left out."""
        out = np.empty((len(words), len(self.choices)), np.int64)
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            own = self.group_hashes(_codes([words[i] for i in rows], int(size)))
            for c, some in enumerate(self.choices):
                out[rows, c] = (own[:, some] * self.salt[c, : len(some)]).sum(1) + c
        return out

    def near(self, left: list[str], right: list[str] | None, choice: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, j) of the near pairs of ``left`` with itself (i < j) or with ``right``, words all of one
        length each, that ``choice`` reports."""
        a = _codes(left, len(left[0]))
        b = a if right is None else _codes(right, len(right[0]))
        if a.shape[1] > b.shape[1]:
            yield from ((j, i) for i, j in self.near(right, left, choice))
            return
        x, y = _counts(a), _counts(b)
        distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
        i, j = np.nonzero(distance <= 2)
        if right is None:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 16):
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            differ = self.group_hashes(a[p]) != self.group_hashes(b[q])
            mine = self.first[differ @ (1 << np.arange(GROUPS))] == choice
            p, q = p[mine], q[mine]
            good = one_edit(a[p], b[q])
            yield p[good], q[good]


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each slot: slots dealt to and fro by how often their letters occur (``SLOTS`` rows)."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).select((F.ascii("c") % SLOTS).alias("s"))
    found = {r["s"]: r["n"] for r in letters.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(range(SLOTS), key=lambda s: (-found.get(s, 0), s))
    group = np.zeros(SLOTS, np.int64)
    for rank, s in enumerate(order):
        turn = rank % (2 * GROUPS)
        group[s] = min(turn, 2 * GROUPS - 1 - turn)
    return group


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, n): for each of the distinct ``words`` (word, n) those one edit apart, with their n."""
    blocks = Blocks(letter_groups(words))
    schema = "key long, choice int, size int, word string, n long"

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch["word"].to_pylist()
            keys = blocks.keys(texts)
            sizes = np.array([len(w) for w in texts], np.int32)
            for choice in range(len(blocks.choices)):
                for size in (sizes, sizes - 1):  # with words one longer, and with words one shorter
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[:, choice] + size * np.int64(0x9E3779B97F4A7C1)), pa.array(np.full(len(texts), choice, np.int32)),
                         pa.array(size), batch["word"], batch["n"]], ["key", "choice", "size", "word", "n"])

    rows = words.mapInArrow(block, schema)
    sizes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "blocks")
    tiles = F.ceil(F.col("m") / TILE)
    own = F.pmod(F.xxhash64("word"), F.col("tiles"))
    tiled = (rows.join(sizes, "key").withColumn("tiles", tiles).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
             .select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own",
                     "choice", "size", "word", "n"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(part: tuple, members: list[tuple]) -> Iterator[pa.RecordBatch]:
            _, x, y, choice, size = part
            # (tile, words of the block's length or one longer): only a pair with one of its length counts
            cells: dict[tuple[bool, bool], tuple[list[str], list[int]]] = {}
            for own, word, n in members:
                cell = cells.setdefault((own == y, len(word) > size), ([], []))
                cell[0].append(word)
                cell[1].append(n)
            if x == y:
                meet = [((True, False), None), ((True, False), (True, True))]
            else:
                meet = [((False, False), (True, False)), ((False, False), (True, True)), ((False, True), (True, False))]
            for left, right in meet:
                if left not in cells or (right or left) not in cells:
                    continue
                (a, an), (b, bn) = cells[left], cells[right or left]
                for i, j in blocks.near(a, b if right else None, choice):
                    if len(i):
                        i, j = i.tolist(), j.tolist()
                        one, two = [a[k] for k in i], [b[k] for k in j]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(one + two, pa.string()), pa.array(two + one, pa.string()),
                             pa.array([bn[k] for k in j] + [an[k] for k in i], pa.int64())], ["word", "near", "n"])

        part, members = None, []
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("key", "x", "y", "choice", "size", "own", "word", "n"))
            for *now, own, word, n in zip(*columns):
                if now != part:
                    if len(members) > 1:
                        yield from pairs(part, members)
                    part, members = now, []
                members.append((own, word, n))
        if len(members) > 1:
            yield from pairs(part, members)

    order = ["key", "x", "y", "choice", "size"]
    return tiled.repartition("key", "x", "y").sortWithinPartitions(*order).mapInArrow(compare, "word string, near string, n long")


# --- forms ----------------------------------------------------------------------------------------


def spelling_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with their counts (word, n).

    A word's form is its near word of greatest n (ties: first in code-point order) if that n is at least
    ``times`` its own, else null; the root follows forms to the last, the word itself if it has none.
    ``times`` is at least 2, so that counts rise along forms and there are no circles.  Null words and
    null counts are left out; an empty table gives none; other columns are not read.
    """
    if times < 2:
        raise ValueError("counts must rise from a word to its form")
    small_batches(words.sparkSession)
    words = stored(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n"))
                   .where("word IS NOT NULL AND n IS NOT NULL"), "words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near"))).alias("best"))
    takes = -F.col("best.less") >= times * F.col("n")
    forms = stored(words.join(best, "word", "left").select(
        "word", F.when(takes, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, -F.col("best.less")).alias("form_n")), "forms")
    # each round doubles the steps made; counts grow by `times` a step, so there are few
    step = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        after = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(step.join(after, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not step.where("moved").limit(1).count():
            break
        step = step.drop("moved")
    return forms.join(step.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
