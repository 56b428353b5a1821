"""Records of delimited text whose quoted fields hold line breaks, read in many tasks.

Whether a line begins inside quotes depends on all lines before it, so a first pass follows each block of a
file (an input split) from both states and keeps one short row per block: the state it ends in either way.
Composed in order, these tell the state every block begins in.  The next pass starts each block in that
state and gives the records that lie within it; the one record that runs over a border is put together
from the pieces its blocks leave.  No line is shuffled but those pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import materialize, ship_package


def state_after(sep: str):
    """``f(inside, line) -> inside`` for lines with quotes.  A quote opens a text only at the beginning of a
    field; inside, a doubled quote is a character and any other ends the text."""
    s = re.escape(sep.encode())
    text = rb'[^"]*+(?:""[^"]*+)*+'
    rest = rb"[^" + s + rb"]*+"
    field = rb'(?:"' + text + rb'"' + rest + rb'|(?!")' + rest + rb")"
    opens = re.compile(rb"(?:" + field + s + rb')*+"' + text + rb"\Z")
    closes = re.compile(text + rb'"' + rest)

    def after(inside: int, line: bytes) -> int:
        if not inside:
            return int(opens.match(line) is not None)
        end = closes.match(line)
        return int(end is None or (end.end() < len(line) and opens.match(line, end.end() + 1) is not None))
    return after


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Slices of one block each, and whether it is the first of its block."""
    last = None
    for batch in batches:
        part = batch["part"].to_numpy()
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                yield batch.slice(i, j - i), part[i] != last
                last = part[i]


def _ends(sep: str):
    """A row per block: its lines, the state it ends in and whether a record starts in it, from either state."""
    names = ["part", "file", "block", "n", "end0", "end1", "starts0", "starts1", "returns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, row = state_after(sep), None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], pa.schema([(c, pa.int64()) for c in names]))
        for lines, first in _runs(batches):
            values = lines["value"].to_pylist()
            if first:
                if row:
                    yield out()
                row = [*(lines[c][0].as_py() for c in ("part", "file", "block")), 0, 0, 1, 0, 0, int(values[0].endswith(b"\r"))]
            row[3] += len(values)
            s0, s1, starts0, starts1 = row[4:8]
            for v in values:
                if v and v != b"\r":
                    starts0 |= not s0
                    starts1 |= not s1
                    if b'"' in v:
                        s0, s1 = after(s0, v), after(s1, v)
            row[4:8] = s0, s1, int(starts0), int(starts1)
        if row:
            yield out()
    return run, ", ".join(f"{c} long" for c in names)


#: What is known of a block before it is read, found by its number in ``part``.
BLOCK = np.dtype([("part", "i8"), ("n", "i8"), ("open", "i8"), ("inside", "i1"), ("header", "i1"), ("returns", "i1")])


def _composed(ends: list) -> np.ndarray:
    """``BLOCK`` rows, sorted by part; ``open`` is the block in which the record that runs into this one starts."""
    out = []
    for _, blocks in groupby(sorted(ends, key=lambda r: (r["file"], r["block"])), key=lambda r: r["file"]):
        inside, open_, header, returns = 0, 0, False, None
        for r in blocks:
            returns = r["returns"] if returns is None else returns
            starts = r["starts1"] if inside else r["starts0"]
            out.append((r["part"], r["n"], open_, inside, bool(starts) and not header, returns))
            if starts:
                open_, header = r["part"], True
            inside = r["end1"] if inside else r["end0"]
    return np.sort(np.array(out, BLOCK), order="part")


def _within(sep: str, known, border: bool):
    """The records that lie within one block (value), or, with ``border``, the pieces of those that do not:
    (record, block, header, value), a record being known by the block in which it starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, table = state_after(sep), known.value
        info, held, out = None, [], []  # held: lines of the record that is open

        def piece(record: int, header: bool) -> None:
            if border:
                out.append((record, block, header, b"\n".join(held)))

        def close() -> None:
            if info is None:
                return
            if read != info["n"]:  # a file split otherwise than in the first pass
                raise RuntimeError("the blocks of a file changed while it was read")
            if inside and held:
                piece(int(info["open"]) if earlier else int(info["part"]), not earlier and header)

        def batch_of() -> pa.RecordBatch:
            if border:
                columns = list(zip(*out)) or [[]] * 4
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.binary()))],
                                                  ["record", "block", "header", "value"])
            return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
        for lines, first in _runs(batches):
            if first:
                close()
                part = lines["part"][0].as_py()
                at = int(np.searchsorted(table["part"], part))
                if at == len(table) or table["part"][at] != part:
                    raise RuntimeError("the blocks of a file changed while it was read")
                info, held, read, block = table[at], [], 0, lines["block"][0].as_py()
                inside, returns, header = int(info["inside"]), bool(info["returns"]), bool(info["header"])
                earlier = bool(inside)  # the open record started in an earlier block
            values = lines["value"].to_pylist()
            read += len(values)
            for v in values:
                if inside:
                    held.append(v.rstrip(b"\r") if returns else v)
                    if b'"' in v and not (inside := after(1, v)):
                        if earlier:
                            piece(int(info["open"]), False)
                        elif not header and not border:
                            out.append(b"\n".join(held))
                        header = header and earlier
                        earlier, held = False, []
                elif v and v != b"\r":
                    if b'"' in v and (inside := after(0, v)):
                        held = [v.rstrip(b"\r") if returns else v]
                    else:
                        if not header and not border:
                            out.append(v)
                        header = False
            if out:
                yield batch_of()
                out = []
        close()
        if out:
            yield batch_of()
    return run


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(value): every record below the header of each file, its bytes as they stand; line breaks inside
    quotes belong to it.

    Lines end with a line feed, with or without a carriage return before it; in a file whose first line has
    both, the carriage returns at line ends inside quotes go too.  Empty lines between records are left out.
    A quote that is never closed makes one record of the rest of its file.  One row
    of nine numbers per input split reaches the driver, and 27 bytes of it are broadcast (800,000 rows and
    22 MB at 100 TB in splits of 128 MB).
    """
    ship_package(spark)
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"), *place)
    lines = lines.select("value", "block", F.xxhash64("path", "block").alias("part"), F.xxhash64("path").alias("file"))
    known = spark.sparkContext.broadcast(_composed(lines.mapInArrow(*_ends(sep)).collect()))
    lines = lines.select("value", "block", "part")
    whole = lines.mapInArrow(_within(sep, known, False), "value binary")
    pieces = lines.mapInArrow(_within(sep, known, True), "record long, block long, header boolean, value binary")
    parts = F.array_sort(F.collect_list(F.struct("block", F.col("value").cast("string").alias("value"))))  # of one record
    joined = pieces.groupBy("record").agg(F.max("header").alias("header"),
                                          F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    border = materialize(joined.where(~F.col("header")).select("value"))  # a record per block at most
    return whole.select(F.col("value").cast("string").alias("value")).unionByName(border)
