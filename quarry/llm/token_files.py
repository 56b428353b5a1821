"""Token ids in flat binary files (operator 6).

Format, per partition of the id order: ``.ids`` holds the ids of all its documents end to end as
unsigned little-endian integers (16 bits where the vocabulary allows, else 32), ``.off`` the 64-bit
offsets (count + 1) of the documents inside that file, ``.doc`` their 64-bit ids.  The manifest, a
Parquet table beside them, names the files of each partition with its totals and its base, the
prefix sum of the totals before it; a document starts at base + offset.  Readers map the files.

Documents are range-partitioned by id and sorted inside the partition.  A task writes under a name
of its own, and only names that tasks have returned are in the manifest, so a repeated task after a
lost executor leaves an unused file, never a wrong one.  Memory is one Arrow batch, and the word cache
where a text is not in Latin letters.
"""

from __future__ import annotations

import json
import re
import string
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.shared import Remembered, fresh_folder, stored
from quarry.llm.token_count import byte_symbols

MARKS = string.punctuation
#: Stands for a null doc_id in ``.doc`` files.
NO_ID = -(1 << 63)
#: Distinct words a task remembers (some 200 bytes each); ids read back at once.
REMEMBERED, READ_IDS = 150_000, 1 << 20


#: Normaliser and pre-tokeniser of the vocabularies that :func:`ranked` takes.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same on lower-cased texts in Latin letters.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_\u00B2\u00B3\u00B9\u00BC-\u00BE]+|[\\d\u00B2\u00B3\u00B9\u00BC-\u00BE]"
                     "|[!-/:-@\\[-`{-~\u00A1-\u00A9\u00AB-\u00B1\u00B4\u00B6-\u00B8\u00BB\u00BF\u00D7\u00F7]+")
#: Texts for which NFC changes nothing, and white space, letters and lower case are the same everywhere.
_LATIN = re.compile("[\t\n\r\x20-\x7E\u00A1-\u012F\u0131-\u024F]*")


def ranked(spec: dict) -> tuple[tiktoken.Encoding, np.ndarray] | None:
    """tiktoken's merger of a vocabulary with end-of-word symbols, and the id of each of its ranks.

    A piece is followed by a space, which stands for the end of a word: it joins the byte before it
    first, then pairs are merged by rank.  None for vocabularies of another kind.
    """
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers") or [{}]
    first = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
    plain = ((spec.get("normalizer") or {}).get("normalizers") == _NORMAL and steps[0] == first and len(steps) == 2
             and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex", True)
             and model.get("type", "BPE") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix")
             and not model.get("ignore_merges"))
    end = model.get("end_of_word_suffix")
    if not plain or not end:
        return None
    octets = {s: b for b, s in enumerate(byte_symbols())}

    def octet_string(symbol: str) -> bytes:
        last = symbol.endswith(end)
        return bytes(octets[c] for c in (symbol[: -len(end)] if last else symbol)) + b" " * last
    ids = model["vocab"]
    try:
        base = [*(s + end for s in octets), *octets]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        symbols = [*base, *merged]
        numbers = np.array([ids[s] for s in symbols], np.uint32)
        ranks = {octet_string(s): i for i, s in enumerate(symbols)}
    except KeyError:
        return None
    if len(ranks) != len(symbols):
        return None
    return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}), numbers


class WordEncoder(Remembered):
    """Ids (as bytes) of texts as the tokenizers library has them.

    Texts in Latin letters are cut into pieces here and merged by tiktoken, by the same ranks, where the
    vocabulary allows (:func:`ranked`).  For all others the words go to the library, each once.
    The vocabulary's pieces never cross white space, so a text's ids are those of its words end to
    end; a text that holds the string of a special token goes to the library as a whole.  Letters and
    the marks after them are separate pieces, and A-Z is folded, so such words are put together from
    words already met.
    """

    def __init__(self, vocabulary: bytes):
        super().__init__(REMEMBERED)
        self.library = Tokenizer.from_buffer(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.quick = ranked(json.loads(vocabulary))

    def merged(self, text: str) -> bytes:
        """Ids of a text in Latin letters."""
        merger, numbers = self.quick
        pieces = _PIECES.findall(text.lower())
        found = np.array(merger.encode_ordinary(" ".join(pieces) + " ") if pieces else [], np.int64)
        return numbers[found].astype(self.kind).tobytes()

    def ids(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def made(self, word: str) -> bytes:
        head = word.rstrip(MARKS)
        if head != word and head.isalpha():
            return self[head] + self[word[len(head) :]]
        if word.isascii() and word.isalpha() and not word.islower():
            return self[word.lower()]
        return self.ids(word) if word else b""

    def learn(self, words: set[str]) -> None:
        """Encode the unseen letter-only words of many texts in a few calls: each is one piece."""
        new = set()
        for word in words:
            word = "" if word in self else word.rstrip(MARKS)
            if word.isalpha() and len(word) <= 64:
                word = word.lower() if word.isascii() else word
                if word not in self and word not in self.older:
                    new.add(word)
        new = sorted(new)
        for at in range(0, len(new), 500):
            part = new[at : at + 500]
            found = self.library.encode(" ".join(part), add_special_tokens=False)
            piece = np.array(found.word_ids)
            if len(piece) and piece[-1] == len(part) - 1:  # as many pieces as words
                cuts = (np.searchsorted(piece, np.arange(len(part) + 1)) * self.kind.itemsize).tolist()
                data = np.array(found.ids, self.kind).tobytes()
                for word, a, b in zip(part, cuts, cuts[1:]):
                    self.keep(word, data[a:b])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        # U+0130 becomes a letter and a mark, which joins the marks after it
        whole = ["\u0130" in t or any(s in t for s in self.special) for t in texts]
        split = [None if w or self.quick and _LATIN.fullmatch(t) else t.replace("\n", " ").split(" ") for w, t in zip(whole, texts)]
        self.learn(set().union(*filter(None, split)))
        for text, w, words in zip(texts, whole, split):
            yield self.ids(text) if w else self.merged(text) if words is None else b"".join(map(self.__getitem__, words))

    def runs(self, column: pa.Array, limit: int = 1 << 20) -> Iterator[bytes]:
        """The ids of each text of a column, encoded in runs of about ``limit`` characters; a longer
        text goes in pieces cut at spaces."""
        held, size = [], 0
        for value in column:
            text = value.as_py() or ""
            if size + len(text) > limit and held:
                yield from self.encode(held)
                held, size = [], 0
            if len(text) > 4 * limit and not any(s in text for s in self.special):
                pieces, at = [], 0
                while at < len(text):
                    cut = text.find(" ", at + limit)
                    cut = len(text) if cut < 0 else cut
                    pieces += self.encode([text[at:cut]])
                    at = cut + 1
                yield b"".join(pieces)
                continue
            held.append(text)
            size += len(text)
        yield from self.encode(held)


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes) -> WordEncoder:
    return WordEncoder(vocabulary)


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; the shared folder may be a local mount or a store."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return (pafs.LocalFileSystem(), uri) if "://" not in uri else pafs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write in ascending id order; returns the manifest
    (partition, file, docs, tokens, base).

    A null text is empty (its only id is ``end_id``).  Null ids come first; rows with equal ids follow
    each other, by text hash; repeated rows are all written.  An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "tokens")
    with open(tokenizer_path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (fs, path) = encoder(vocabulary.value), place(folder)
        end = np.array([end_id], words.kind).tobytes()
        name, n, at, streams = f"part-{uuid.uuid4().hex}", 0, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            if not streams:
                fs.create_dir(path, recursive=True)
                streams = [fs.open_output_stream(f"{path}/{name}.{x}") for x in ("ids", "off", "doc")]
                streams[1].write(np.zeros(1, "<u8").tobytes())
            sizes = []
            for data in words.runs(batch["text"]):
                data += end
                streams[0].write(data)
                sizes.append(len(data) // words.kind.itemsize)
            ends = at + np.cumsum(np.array(sizes, np.uint64))
            streams[1].write(ends.astype("<u8").tobytes())
            streams[2].write(batch["doc_id"].fill_null(NO_ID).to_numpy().astype("<i8").tobytes())
            n, at = n + len(sizes), int(ends[-1])
        for s in streams:
            s.close()
        words.forget()
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([f"{folder}/{name}"]),
                 pa.array([words.kind.itemsize], pa.int32()), pa.array([n]), pa.array([at])],
                ["partition", "file", "width", "docs", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "partition int, file string, width int, docs long, tokens long")
    parts = stored(parts, "written")  # the files exist from here on; never written twice
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    bases.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _mapped(fs: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A whole small file, or the map of a local one."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = place(row["file"])
            offsets, ids = _mapped(fs, f"{path}.off", "<u8"), _mapped(fs, f"{path}.doc", "<i8")
            tokens = _mapped(fs, f"{path}.ids", f"<u{row['width']}")
            a, n = 0, len(ids)
            while a < n:  # runs of documents of about READ_IDS ids
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + np.uint64(READ_IDS), "right")) - 1)
                cut = offsets[a : b + 1].astype(np.int64)
                data = tokens[cut[0] : cut[-1]].astype("<u4").view(np.uint8)
                spans = ((cut - cut[0]) * 4).tolist()
                sums = [zlib.crc32(data[x:y]) for x, y in zip(spans, spans[1:])]
                own = np.array(ids[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, mask=own == NO_ID), pa.array(cut[:-1] + row["base"]), pa.array(np.diff(cut)),
                     pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                a = b


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    files = manifest.count()
    return manifest.repartition(max(1, files)).mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
