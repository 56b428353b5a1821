"""Periodic runs, spelling variants and packing against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import queries, variants
from quarry.llm.packing import TextIds, pack, whole_plan
from quarry.llm.periodic import periodic_runs, runs_of
from quarry.llm.variants import one_edit, spelling_variants, word_counts
from tests.llm.test_operators import BYTES, DOCS, SF, WORDS, awkward, empty


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet'").df()


# --- 11 periodic runs -----------------------------------------------------------------------------


def brute_runs(w, least=24, times=3):
    """Straight from the definition: every lag, every longest stretch, its smallest period."""
    found = set()
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            s, n = i - q, j - i + q
            if n >= max(least, times * q) and not any(all(w[x] == w[x - p] for x in range(s + p, s + n)) for p in range(1, q)):
                found.add((s, n, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_match_the_definition():
    rng = random.Random(1)
    for least, times in [(24, 3)] * 150 + [(5, 3), (1, 3), (10, 4), (40, 5)] * 40:
        texts = []
        for _ in range(rng.randrange(1, 4)):
            w, size = [], rng.randrange(0, 150)
            while len(w) < size:
                block = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(1, 14))]
                w += block if rng.random() < 0.4 else (block * 12)[: rng.randrange(1, len(block) * 7 + 2)]
            texts.append(w)
        flat = np.array([x for w in texts for x in w], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        true, first = [], 0
        for w in texts:
            true += [(s + first, n, q) for s, n, q in brute_runs(w, least, times)]
            first += len(w)
        assert runs_of(flat, owner, least, times) == sorted(true, key=lambda r: (r[0], r[2]))


def test_long_texts_and_frequent_words_stay_cheap():
    assert runs_of(np.zeros(200_000, np.int64), np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert runs_of(np.tile(np.arange(7000), 20), np.zeros(140_000, np.int64)) == [(0, 140_000, 7000)]
    assert runs_of(np.tile(np.arange(7000), 3)[:-1], np.zeros(20_999, np.int64)) == []


def test_run_digests_match_brute_force(spark, docs):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    some = [r for r in docs.itertuples() if r.doc_id % 7 == 0 or zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert len(got) == len(docs) and any(got[r.doc_id]["n_runs"] for r in some)
    for r in some:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        if len(w) > 1500:
            continue  # the definition is cubic
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        row = got[r.doc_id]
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
        if runs:
            s, n, q = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (s, n, q, 1000 * n // q)
        else:
            assert row["start"] is row["length"] is row["period"] is row["exponent_milli"] is None


def test_runs_of_awkward_rows(spark):
    found = periodic_runs(awkward(spark)).collect()
    assert len(found) == 14
    by = defaultdict(list)
    for r in found:
        by[r["doc_id"]].append(r)
    assert by[3][0]["n_words"] == by[4][0]["n_words"] == by[5][0]["n_words"] == 0 and by[3][0]["collapsed"] == ""
    assert by[9][0]["collapsed"] == "one TWO" and by[2][0]["collapsed"] == "A B c d e f g"
    assert by[6][0]["n_words"] == 300_001 and by[6][0]["runs"] == by[7][0]["runs"] != []
    assert len(by[8]) == 2 and len(by[None]) == 2
    assert periodic_runs(empty(spark)).count() == 0
    assert queries.run_digests(periodic_runs(queries.with_repeats(awkward(spark)))).count() == 14
    text = " ".join(["a"] * 24)
    rows = spark.createDataFrame([(1, text), (2, text[:-2]), (3, "x " + text.replace("a a", "a b"))], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs(rows).collect()}
    assert got == {1: [(0, 24, 1)], 2: [], 3: [(1, 24, 2)]}
    with pytest.raises(ValueError):
        periodic_runs(rows, least_repeats=2)


# --- 12 spelling variants -------------------------------------------------------------------------


def brute_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_table(spark, seed=3, n=700, letters="abcdeéñ", low=3, high=9):
    rng = random.Random(seed)
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(low, high)))
        words[w] = rng.choice([1, 2, 3, 5, 10, 26, 130, 700])
    return words, spark.createDataFrame([(w, k, "clash", 1) for w, k in words.items()], "word string, n long, near string, size int")


def brute_variants(words, times=5):
    out = {}
    for w, n in words.items():
        near = [(-m, v) for v, m in words.items() if brute_near(v, w)]
        best = min(near, default=None)
        takes = best is not None and -best[0] >= times * n
        out[w] = (best[1] if takes else None, n, len(near), -best[0] if takes else None)
    root = {}
    for w in words:
        r = w
        while out[r][0] is not None:
            r = out[r][0]
        root[w] = r
    return {w: (f, root[w], n, k, m) for w, (f, n, k, m) in out.items()}


@pytest.mark.parametrize("tile", [variants.TILE, 8])
def test_variants_match_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(variants, "TILE", tile)
    words, table = words_table(spark, n=500, letters="abcé" if tile == 8 else "abcdeéñ")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_variants(table).collect()}
    assert got == brute_variants(words)
    assert any(w[1] != w[0] and w[0] for w in got.values())


def test_one_edit_is_the_edit_distance():
    rng = random.Random(5)
    for n, m in ((4, 4), (4, 5), (1, 1), (1, 2), (0, 1), (7, 8)):
        a = np.array([[rng.randrange(3) for _ in range(n)] for _ in range(500)], np.int64).reshape(500, n)
        b = np.array([[rng.randrange(3) for _ in range(m)] for _ in range(500)], np.int64).reshape(500, m)
        assert one_edit(a, b).tolist() == [brute_near(x, y) for x, y in zip(a.tolist(), b.tolist())]


def test_word_counts_plant_typos_and_take_awkward_rows(spark):
    texts = [(i, "Éclair éclair strawberry strawbérry abcdef ABCDEF xyz", None) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string, n string")
    true = Counter()
    for i, t, _ in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t):
            run = re.sub("[A-Z]", lambda c: c.group().lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode())
            true[run if h % 7 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    got = {r["word"]: r["n"] for r in word_counts(df, typos=7).collect()}
    assert got == {w: n for w, n in true.items() if len(w) >= 6 and n >= 5} and len(got) > 6
    assert word_counts(empty(spark)).count() == 0 and spelling_variants(word_counts(empty(spark))).count() == 0
    assert {r["word"] for r in word_counts(awkward(spark), 1, 1).collect()} >= {"word", "other", "é", "ü"}
    rows = spark.createDataFrame([(None, 5), ("a", 7), ("", 40), ("ab", None), ("x" * 5000, 2), ("x" * 5001, 20)], "word string, n long")
    got = {r["word"]: (r["form"], r["n_near"]) for r in spelling_variants(rows).collect()}
    assert got == {"a": ("", 1), "": (None, 1), "x" * 5000: ("x" * 5001, 1), "x" * 5001: (None, 1)}


def test_long_texts_are_counted_in_pieces(spark, monkeypatch):
    text = "éclair strawberry " * 50_000 + "y" * 60_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    monkeypatch.setattr(variants, "STEP", 1000)
    assert {r["word"]: r["n"] for r in word_counts(df).collect()} == {"éclair": 50_000, "strawberry": 50_000}


# --- 13 packing -----------------------------------------------------------------------------------


def test_plans_place_every_piece():
    rng = np.random.default_rng(4)
    for capacity, n in [(50, 200), (64, 5), (100, 2000), (2048, 3000), (7, 40)]:
        counts = np.bincount(rng.integers(1, capacity + 1, n), minlength=capacity + 1)
        if capacity == 100:
            counts[33] += 100_000  # a hot length
        plan = whole_plan(counts, capacity)
        placed = np.zeros(capacity + 1, np.int64)
        for way, k in plan:
            assert k > 0 and sum(a * b for a, b in way.items()) <= capacity
            for length, c in way.items():
                placed[length] += c * k
        assert (placed == counts).all()
        # never more than an eighth above what no packing can beat: the tokens, and the pieces over half
        least = max(-(-int(np.arange(capacity + 1) @ counts) // capacity), int(counts[capacity // 2 + 1 :].sum()),
                    -(-int(counts[33]) // 3) if capacity == 100 else 0)
        assert sum(k for _, k in plan) <= least * 1.125 + 1
    assert whole_plan(np.zeros(11, np.int64), 10) == []


def test_ids_are_the_library_s():
    rng = random.Random(0)
    for path in (BYTES, WORDS):
        with open(path, "rb") as f:
            ids = TextIds(f.read())
        library = Tokenizer.from_file(path)
        odd = ["", " ", "\n", "x ", "\nx", "it's  don't\n 's", "<|endoftext|> hi <|endoftext|>", "1234 5678\n90.", "\r\n a\r\nb", "漢字 🙂\n漢"]
        odd += ["".join(rng.choice("ab A\n \t'.,1é漢 \x1c\x85") for _ in range(rng.randrange(0, 40))) for _ in range(500)]
        odd += ["z" * 300_000, " " * 300_000 + "x", "ab cd\n" * 60_000]
        for text in odd:
            assert np.frombuffer(ids.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, capacity, end_id):
    library = Tokenizer.from_file(BYTES)
    want = Counter()
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end_id]
        head = len(ids) % capacity or capacity
        cuts = [0, *range(head, len(ids), capacity), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in rows)


def test_packing_of_the_table(spark, docs):
    rows = queries.op13_packing(spark, SF).collect()
    n, tokens = check_packing(rows, zip(docs.doc_id.tolist(), docs.text.tolist()), 2048, 0)
    assert n <= -(-tokens // 2048) * 1.01 + 1


def test_packing_of_awkward_rows(spark, monkeypatch):
    texts = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    check_packing(pack(awkward(spark).repartition(5), BYTES, capacity=100, end_id=7).collect(), texts, 100, 7)
    assert pack(empty(spark), BYTES).count() == 0
    assert {c for c, _ in pack(empty(spark), BYTES).dtypes} >= {"doc_id", "sequence_id", "offset"}
    hot = spark.createDataFrame([(i, "same text") for i in range(3000)] + [(-1, "a b " * 30)], DOCS.split(", source")[0])
    rows = pack(hot.repartition(6), BYTES, capacity=64).collect()
    n, tokens = check_packing(rows, [(r["doc_id"], r["text"]) for r in hot.collect()], 64, 0)
    assert n <= -(-tokens // 63) + 1


def test_ranked_word_pieces_equal_the_library_s():
    """Latin texts go to the ranked merger, others to the library; both give the library's ids."""
    import pyarrow as pa
    from quarry.llm.token_files import WordEncoder

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        words = WordEncoder(f.read())
    rng = random.Random(5)
    letters = "abcdefgxyzABXYZ0123456789 .,!?'\"-()\n\t\réÀßñĀƀɏªº²¼¡«¿­×İıΣ中́ "
    texts = ["", " ", "you're IT'S 'S x's", "a" * 3000, "end<|endoftext|> of", "İ, x", "naive-1234 café"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1000)]
    want = [words.library.encode(t, add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(b, words.kind).tolist() for b in words.runs(pa.array(texts))]
    assert got == want
    met = len(words)
    list(words.runs(pa.array([f"w{i}" for i in range(500)])))
    assert len(words) == met  # nothing is remembered for texts in Latin letters
