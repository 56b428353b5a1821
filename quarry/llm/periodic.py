"""Periodic runs of words inside documents (operator 11).

A run of period q is a longest stretch in which every word equals the word q before it, q the smallest
such number, of at least ``least_words`` words and ``least_repeats`` periods.  On the diagonal of lag
q it is an unbroken series of matches, and those are followed online: at each word its earlier
occurrences add one to the match length of their lag, and a lag that gets none ends; if its diagonal
was long enough the run is emitted there and then.

Only occurrences that can belong to a run are looked at.  A run of period q holds at least
``least_match(q)`` matches in a row, so the word and the next k - 1 words must recur together, k being
the largest power of two up to that number; for such a k >= q the smallest period is the distance to the
*nearest* earlier occurrence of those k words (Fine and Wilf: a nearer one inside the run would give it
a smaller period).  So each word has one occurrence per k to follow, however often it is repeated.  The
k words are numbered by doubling, two numbers of k words making one of 2k, in which only words met
again at k take part; numbers are exact ranks, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import small_batches

#: Bytes of text whose words are numbered together; a longer text is handled by itself.
SLICE = 1 << 20


def least_match(period: int, least_words: int, least_repeats: int) -> int:
    """Matches in a row on the diagonal of a run: its words but for the first period."""
    return max(least_words - period, (least_repeats - 1) * period)


def occurrences(words: np.ndarray, texts: np.ndarray, least_words: int, least_repeats: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, lag, k) of the occurrences to follow, by word; ``words`` are numbers and ``texts`` the
    number of the text each is in."""
    n = len(words)
    number = texts * (int(words.max(initial=0)) + 1) + words
    alive = np.arange(n)
    k, followed = 1, []
    longest = int(np.bincount(texts).max(initial=0)) // least_repeats
    below = 0  # lags up to here have been followed
    while len(alive):
        order = np.argsort(number[alive], kind="stable")
        at, value = alive[order], number[alive][order]
        again = value[1:] == value[:-1]
        # lags whose runs hold k matches in a row, but not 2k
        if 2 * k > min(least_match(q, least_words, least_repeats) for q in range(below + 1, k + 1)):
            lag = (at[1:] - at[:-1])[again]
            fits = (lag > below) & (lag <= k)
            followed.append((at[1:][again][fits], lag[fits], np.full(int(fits.sum()), k)))
            below = k
        if below >= longest:
            break
        member = np.zeros(len(at), bool)
        member[1:] |= again
        member[:-1] |= again
        rank = np.cumsum(np.concatenate([[True], ~again]))
        met = np.full(n + k, -1)
        met[at[member]] = rank[member]
        left = np.sort(at[member])
        left = left[left + k < n]
        left = left[(met[left + k] >= 0) & (texts[left] == texts[left + k])]
        number = np.zeros(n, np.int64)
        number[left] = met[left] * (len(at) + 1) + met[left + k]
        alive, k = left, 2 * k
    if not followed:
        return (np.zeros(0, np.int64),) * 3
    word, lag, size = (np.concatenate(x) for x in zip(*followed))
    order = np.lexsort((lag, word))
    return word[order], lag[order], size[order]


def runs_of(words: np.ndarray, texts: np.ndarray, least_words: int = 24, least_repeats: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, as they end; starts count over all texts.

    ``active`` maps a lag to its match length so far and the k its matches were made with.
    """
    active: dict[int, tuple[int, int]] = {}
    runs: list[tuple[int, int, int]] = []

    def end(lag: int, last: int) -> None:
        matches, k = active.pop(lag)
        length = matches + k - 1 + lag
        if length >= max(least_words, least_repeats * lag):
            runs.append((last + k - length, length, lag))

    now, here = -1, {}
    for word, lag, k in zip(*(x.tolist() for x in occurrences(words, texts, least_words, least_repeats))):
        if word != now:
            for ended in [x for x in active if x not in here] if now >= 0 else ():
                end(ended, now - 1)
            if word != now + 1:
                for ended in list(active):
                    end(ended, now)
            now, here = word, {}
        here[lag] = True
        active[lag] = (active[lag][0] + 1 if lag in active else 1, k)
    for ended in list(active):
        end(ended, now if ended in here else now - 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


RUN = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 24,
                  least_repeats: int = 3) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text: words are ``[^\\x20\\x09-\\x0D]+``, ``runs``
    an array of (start, length, period) by start and period, ``collapsed`` the words that no run
    contains after its first period, joined by one space.

    A null or empty text has no words, no runs and an empty collapsed text.  One row per input row,
    repeated rows and null ids included; an empty table gives none; other columns are not read.
    Memory: the words of about 1 MB of text, or of one longer text (some 150 bytes a word).
    """
    if least_repeats < 3:
        raise ValueError("runs of fewer than three periods are not unique by their nearest occurrences")
    small_batches(docs.sparkSession)

    def solve(texts: list[bytes]) -> Iterator[tuple[int, list, str]]:
        split = [t.split() for t in texts]  # bytes split at 0x20 and 0x09-0x0D
        sizes = np.array([len(w) for w in split], np.int64)
        ids: dict[bytes, int] = {}
        numbers = np.fromiter((ids.setdefault(w, len(ids)) for some in split for w in some), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(split)), sizes)
        first = np.cumsum(sizes) - sizes
        found: dict[int, list[tuple[int, int, int]]] = {}
        for start, length, period in runs_of(numbers, owner, least_words, least_repeats):
            text = int(owner[start])
            found.setdefault(text, []).append((start - int(first[text]), length, period))
        for text, some in enumerate(split):
            runs = found.get(text, [])
            if runs:
                edge = np.zeros(len(some) + 1, np.int64)
                for start, length, period in runs:
                    edge[start + period] += 1
                    edge[start + length] -= 1
                some = [some[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            yield int(sizes[text]), [dict(zip(("start", "length", "period"), r)) for r in runs], b" ".join(some).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(ids: list, rows: list) -> pa.RecordBatch:
            n, runs, collapsed = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(runs, _RUNS),
                                               pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
        for batch in batches:
            held, ids, size = [], [], 0
            for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = (value.as_py() or "").encode()
                if held and size + len(text) > SLICE:
                    yield out(ids, list(solve(held)))
                    held, ids, size = [], [], 0
                held.append(text)
                ids.append(doc_id)
                size += len(text)
            if held:
                yield out(ids, list(solve(held)))

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", RUN), T.StructField("collapsed", T.StringType())])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)
