"""Toxicity by a weighted finite-state pattern grammar (operator 2).

Every word of a text is mapped to a symbol: target, negation, reported speech, intent, threat, insult
(in three strengths) or other.  Five small transducers read the symbols of a clause and add weights:

* insult: each insult adds its strength;
* target: an insult within four words after a target, or a target within two after an insult, adds more;
* threat: a threatening verb adds more after an intent ("will", "gonna") and before a target;
* negation: an insult or threat within three words after a negation loses most of its weight;
* reported speech: so does one after a verb of saying, until the clause ends.

They are composed into one table (a state is a tuple of theirs); clauses without an insult or threat
are not run.  A document's score is a logistic function of its clause weights and length.

Insults are learned: words and word stems (first 4 to 7 letters) that labelled toxic documents hold far
more often, on a bounded sample of the labelled training rows.  The logistic part is fitted on clause
weights from lexicons that have not seen the document (two folds).
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import Remembered, stored

#: Labelled training documents used, of each label (bounded sample, by hash of the id).
FIT_DOCS = 3000
#: A learned entry is in so many toxic documents at least, and this many times likelier there.
LEAST_DOCS, LEAST_RATIO, LEXICON = 3, 4.0, 20_000

#: Closed word classes of the grammar (English, French, German, Spanish).
TARGETS = """you your yours u ur he him his she her they them their we us tu te toi vous votre ton du dich dir ihr euch
dein deine sie er usted ustedes él ella ellos ellas""".split()
NEGATIONS = """not no never isn't aren't wasn't don't doesn't didn't nobody nothing pas jamais non nicht kein keine nie
nunca jamás""".split()
REPORTS = """said says say told tells called calls wrote writes quote quoted quoting claimed claims alleged accused dit
écrit sagte sagt schrieb dijo dice escribió""".split()
INTENTS = "will gonna going i'll we'll should must shall vais werde werden voy vamos".split()
THREATS = """kill kills murder hurt destroy beat stab shoot burn punch tuer frapper töten schlagen umbringen matar
golpear""".split()

OTHER, TARGET, NEGATION, REPORT, INTENT, THREAT, WEAK, MIDDLE, STRONG = range(9)
STRENGTH = {WEAK: 1.0, MIDDLE: 2.0, STRONG: 3.0, THREAT: 1.0}
ENDS = 16  # added to a symbol when its word ends a clause
#: Letters (and marks) of scripts that set no spaces between words.
_DENSE = "\u0e00-\u0e4e\u0e80-\u0ece\u1000-\u103f\u1780-\u17d3\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
#: Marks that end a clause.
_MARKS = ".!?;:。！？；：｡"
_PIECE = re.compile(rf"([{_DENSE}]+)|((?:(?![{_DENSE}])[^\W\d_])+(?:'(?:(?![{_DENSE}])[^\W\d_])+)*)|([{_MARKS}])")
_HIT = re.compile(b"[" + b"".join(re.escape(bytes([s + e])) for s in STRENGTH for e in (0, ENDS)) + b"]")


def _insult(state, symbol):
    return 0, STRENGTH.get(symbol, 0.0)


def _target(state, symbol):
    near, hit = state  # words since a target, words since an insult (0: too long ago)
    gain = 0.5 * (symbol in STRENGTH and near > 0) + 0.5 * (symbol == TARGET and hit > 0)
    return (4 if symbol == TARGET else max(near - 1, 0), 2 if symbol in STRENGTH else max(hit - 1, 0)), gain


def _threat(state, symbol):
    meant, verb = state
    gain = 1.0 * (symbol == THREAT and meant > 0) + 1.0 * (symbol == TARGET and verb > 0)
    return (4 if symbol == INTENT else max(meant - 1, 0), 3 if symbol == THREAT else max(verb - 1, 0)), gain


def _negation(state, symbol):
    loss = 0.7 * STRENGTH[symbol] if symbol in STRENGTH and state else 0.0
    return (3 if symbol == NEGATION else max(state - 1, 0)), -loss


def _report(state, symbol):
    loss = 0.5 * STRENGTH[symbol] if symbol in STRENGTH and state else 0.0
    return state or int(symbol == REPORT), -loss


@lru_cache(maxsize=1)
def composed() -> tuple[list[list[int]], list[list[float]]]:
    """Next state and weight by (state, symbol) of all transducers run side by side."""
    machines = (_insult, _target, _threat, _negation, _report)
    start = (0, (0, 0), (0, 0), 0, 0)
    number, todo, step, weight = {start: 0}, deque([start]), [], []
    while todo:
        state = todo.popleft()
        step.append([])
        weight.append([])
        for symbol in range(9):
            moves = [m(s, symbol) for m, s in zip(machines, state, strict=True)]
            after = tuple(m[0] for m in moves)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            step[-1].append(number[after])
            weight[-1].append(sum(m[1] for m in moves))
    return step, weight


def stems(word: str) -> Iterator[str]:
    """The lexicon entries a word may match: itself, then its stems, longest first (marked by *)."""
    yield word
    for n in range(min(7, len(word) - 1), 3, -1):
        yield f"{word[:n]}*"


def pieces(text: str) -> Iterator[str]:
    """Words and clause marks of a text in small letters; a run of a script without spaces gives its pairs of letters."""
    for run, word, mark in _PIECE.findall(text):
        if run:
            yield from (run[i : i + 2] for i in range(max(1, len(run) - 1)))
        else:
            yield word or mark


def small(text: str) -> str:
    return text.lower().replace("’", "'")


class Symbols(Remembered):
    """Symbols of the words of each white-space token as it stands, worked out when first met."""

    def __init__(self, lexicon: dict[str, int]):
        super().__init__(400_000)
        self.known = dict.fromkeys(TARGETS, TARGET) | dict.fromkeys(NEGATIONS, NEGATION) | dict.fromkeys(REPORTS, REPORT)
        self.known |= dict.fromkeys(INTENTS, INTENT) | dict.fromkeys(THREATS, THREAT)
        self.known = lexicon | self.known

    def made(self, token: str) -> bytes:
        out = bytearray()
        for piece in pieces(small(token)):
            if piece in _MARKS:
                if out:
                    out[-1] |= ENDS
            else:
                out.append(next((self.known[s] for s in stems(piece) if s in self.known), OTHER))
        # a token without words counts as one
        return bytes(out) or bytes([OTHER + ENDS * (token[-1:] in _MARKS)])


#: Characters of text worked on at once.
RUN = 1 << 20


def _tokens(text: str) -> Iterator[list[str]]:
    """White-space tokens, a bounded run of text at a time."""
    at, step = 0, RUN
    while at < len(text):
        end = len(text)
        if end - at > step:
            space = re.compile(r"\s").search(text, at + step)
            end = space.start() if space else end
        if tokens := text[at:end].split():
            yield tokens
        at = end


def clauses(text: str, symbols: Symbols) -> tuple[float, float, int, int]:
    """(sum and maximum of the clause weights, insults and threats, words) of a whole text."""
    step, weight = composed()
    total = most = 0.0
    hits = words = 0
    state, clause, held = 0, 0.0, False  # of a clause that the last run of text left open
    goes_on = len(text) > RUN
    for tokens in _tokens(text):
        code = b"".join(map(symbols.__getitem__, tokens))
        words += len(code)
        starts = [hit.start() for hit in _HIT.finditer(code)]
        if held:
            starts.insert(0, 0)
        if goes_on:
            starts.append(len(code) - 1)
        done = 0
        for at in starts:
            if at < done:
                continue
            while at > done and code[at - 1] < ENDS:  # to the start of the clause
                at -= 1
            if not held:
                state, clause = 0, 0.0
            held = True
            while at < len(code):
                symbol = code[at] & 15
                hits += symbol in STRENGTH
                clause += weight[state][symbol]
                state = step[state][symbol]
                at += 1
                if code[at - 1] >= ENDS:
                    held = False
                    break
            done = at
            if not held:
                total, most = total + max(clause, 0.0), max(most, clause)
    if held:
        total, most = total + max(clause, 0.0), max(most, clause)
    return total, most, hits, words


def features(text: str, symbols: Symbols) -> list[float]:
    total, most, hits, words = clauses(text, symbols)
    share = total / (words + 5)
    return [math.log1p(total), min(most, 6.0) / 3, min(30 * share, 4.0), math.sqrt(min(30 * share, 4.0)),
            float(hits > 0), math.log1p(words) / 5]


def _lexicon(rows: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, int]:
    """Symbols of entries by their log ratio of document shares."""
    found = []
    for entry, a, b in rows:
        ratio = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if a >= LEAST_DOCS and ratio >= math.log(LEAST_RATIO):
            found.append((ratio, entry))
    found = sorted(found, reverse=True)[:LEXICON]
    return {e: STRONG if r > 4 else MIDDLE if r > 2.5 else WEAK for r, e in found}


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.02, rounds: int = 30) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_column: Column) -> Column:
    """True for the ids no label is learned from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, fold, toxic, clean): documents of a task that hold an entry."""
    counts: Counter = Counter()  # the fitted sample is bounded, and so is this
    for batch in batches:
        for text, fold, toxic in zip(batch["text"], batch["fold"].to_pylist(), batch["toxic"].to_pylist()):
            words = {w for tokens in _tokens(small(text.as_py() or "")) for w in pieces(" ".join(tokens)) if w not in _MARKS}
            counts.update((e, fold, toxic) for e in {e for w in words if len(w) <= 40 for e in stems(w)})
    rows = list(counts.items())
    for at in range(0, len(rows), 50_000):
        part = rows[at : at + 50_000]
        n = np.array([c for _, c in part])
        toxic = np.array([k[2] for k, _ in part])
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in part]), pa.array([k[1] for k, _ in part], pa.int32()),
             pa.array(n * toxic), pa.array(n * (1 - toxic))], ["entry", "fold", "toxic", "clean"])


class Grammar:
    """Lexicon and logistic weights fitted on labelled rows (id, text, toxic)."""

    def __init__(self, labelled: DataFrame):
        fit = stored(labelled.select("text", "toxic", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int").alias("fold")), "fit")
        sizes = {(r["fold"], r["toxic"]): r["n"] for r in fit.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        counts = (fit.mapInArrow(_entries, "entry string, fold int, toxic long, clean long").groupBy("entry", "fold")
                  .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
        # the sample bounds the entries; only those likely in toxic documents reach the driver
        table = (counts.groupBy("entry").agg(*[F.coalesce(F.sum(F.when(F.col("fold") == f, F.col(c))), F.lit(0)).alias(f"{c}{f}")
                                               for f in (0, 1) for c in ("toxic", "clean")])
                 .where((F.col("toxic0") + F.col("toxic1") >= LEAST_DOCS)
                        & ((F.col("toxic0") + F.col("toxic1")) * 20 >= F.col("clean0") + F.col("clean1"))))
        rows = [tuple(r) for r in table.select("entry", "toxic0", "clean0", "toxic1", "clean1").collect()]

        def size(toxic: int, *folds: int) -> int:
            return sum(sizes.get((f, toxic), 0) for f in folds)
        self.lexicon = _lexicon([(e, a + c, b + d) for e, a, b, c, d in rows], size(1, 0, 1), size(0, 0, 1))
        others = [_lexicon([(r[0], r[1 + 2 * f], r[2 + 2 * f]) for r in rows], size(1, f), size(0, f)) for f in (0, 1)]
        seen = fit.sparkSession.sparkContext.broadcast(others)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            symbols = [Symbols(x) for x in seen.value]
            for batch in batches:
                x = [features(t.as_py() or "", symbols[1 - f]) for t, f in zip(batch["text"], batch["fold"].to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch["toxic"]], ["x", "toxic"])
        table = fit.mapInArrow(measure, "x array<double>, toxic int").toArrow()  # bounded by the sample
        y = table["toxic"].to_numpy().astype(float)
        if 0 < y.sum() < len(y):
            self.weights = _logistic(np.array(table["x"].to_pylist()), y)
        else:  # nothing to learn from: two weak insults or one strong one make a text toxic
            self.weights = np.array([0.0, 9.0, 0.0, 0.0, 0.0, 0.0, -5.0])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from its whole text alone.

    Null and empty texts get the score of a text without words.  One row per input row, repeated rows
    alike; a null id counts as the empty id and is held out.  Labels other than 0 and 1 are left out;
    an id labelled twice counts as toxic if either says so.  Without labels of both kinds fixed
    weights apply.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       held_out(F.col(id_col)).alias("held_out"))
    marked = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
              .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
              .groupBy("id").agg(F.max("toxic").alias("toxic")))
    few = [marked.where(F.col("toxic") == v).orderBy(F.xxhash64("id"), "id").limit(n)
           for v, n in ((1, FIT_DOCS), (0, 2 * FIT_DOCS))]
    labelled = rows.join(F.broadcast(few[0].unionByName(few[1])), F.col("doc_id") == F.col("id")).select("id", "text", "toxic")
    grammar = Grammar(labelled)
    shared = docs.sparkSession.sparkContext.broadcast((grammar.lexicon, grammar.weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = shared.value
        symbols = Symbols(lexicon)
        for batch in batches:
            x = np.array([features(t.as_py() or "", symbols) for t in batch["text"]]).reshape(batch.num_rows, len(weights) - 1)
            out = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(out)], ["doc_id", "held_out", "score"])

    out = rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
