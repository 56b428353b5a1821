"""Training-data operators against brute force, and on awkward rows."""

import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import ann, mixing, queries, shared
from quarry.llm import kernels as K
from quarry.llm.decontaminate import leaks, without_leaks
from quarry.llm.html_text import page_texts, places, render
from quarry.llm.line_dedup import edit_distance, normal, repeated_lines, without_repeated_lines
from quarry.llm.near_dup import near_duplicates, without_near_duplicates
from quarry.llm.quality import resample
from quarry.llm.token_count import PairMerger, token_counts
from quarry.llm.token_files import WordEncoder, read_token_files, write_token_files
from quarry.llm.toxicity import Symbols, clauses, composed, toxicity

SF = "/root/testdata/sf0.01"
BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
#: Extra columns whose names the operators use themselves.
CLASH = "size, target, kept, component_id, n, key, score, rep, h, cluster, part, copies, label, item_id, line".split(", ")
DOCS = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASH)


def awkward(spark, texts=None):
    long = " ".join(f"word{i % 977} other{i % 31}" for i in range(150_000)) + " " + "x" * 50_000
    texts = texts or [(1, "a b c d e f g"), (2, "A B c d e f g"), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, long),
                      (8, "one two"), (8, "one two"), (9, "one  TWO"), (None, "one two"), (None, None), (10, "é ü 漢字 🙂"),
                      (11, "z" * 70_000)]
    rows = [(i, t, None if i is None else f"s{i % 2}", *["clash"] * len(CLASH)) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet'").df()


# --- kernels and components -----------------------------------------------------------------------


def test_words_and_shingles_match_python():
    rng = random.Random(0)
    alphabet = "ab AB\t\n\x0b\x0c\r é漢,."
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    sets = {}
    for i, j, buf, offsets in K.slices(pa.array(texts), 200):
        flat, cut = K.shingle_sets(buf, offsets)
        assert K.word_counts(buf, offsets).tolist() == [len(t.encode().split()) for t in texts[i:j]]
        for k in range(j - i):
            sets[i + k] = tuple(flat[cut[k] : cut[k + 1]].tolist())
    true = []
    for t in texts:
        w = t.encode().lower().split()
        true.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    assert [len(sets[i]) for i in range(300)] == [len(s) for s in true]
    for a in range(300):
        for b in range(a):
            assert (sets[a] == sets[b]) == (true[a] == true[b])


def test_long_words_cross_slices(monkeypatch):
    monkeypatch.setattr(K, "SLICE", 64)
    text = " ".join("w" * n for n in (1, 30, 70, 200, 3, 64, 65, 2))
    buf = np.frombuffer(text.encode(), np.uint8)
    small = K.words(buf, np.array([0, len(buf)]))
    monkeypatch.setattr(K, "SLICE", 1 << 20)
    whole = K.words(buf, np.array([0, len(buf)]))
    assert all((a == b).all() for a, b in zip(small, whole))


def test_components_match_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(1000, 1300)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in shared.components(df, "a", "b").collect()}
    nodes, root = shared.roots(*np.array(edges).T)
    true = {n: r for n, r in zip(nodes.tolist(), root.tolist()) if any(n in e for e in edges if e[0] != e[1])}
    assert got == true
    assert shared.components(df.limit(0), "a", "b").count() == 0


# --- 1 nearest neighbours -------------------------------------------------------------------------


def brute_nearest(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == 8 and None not in v
            and np.isfinite(v).all() and any(v) and i is not None]
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % 50 == 0:
            score = ann.cosines(v, m)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_nearest_matches_brute_force_on_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=8).tolist()) for i in range(400)]
    rows += [(i, rows[50][1]) for i in range(400, 460)]  # one vector very often, some of them asking
    rows += [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [None] * 8), (504, [float("inf")] * 8),
             (505, [1.0] * 3), (None, [1.0] * 8), (550, [1e300] * 8), (551, [1e-300] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    true = brute_nearest(rows)
    assert set(got) == set(true)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in true[q]}) for q in true)
    assert found >= 0.95 * sum(map(len, true.values()))
    assert [i for i, _ in got[50]] == [400, 401, 402, 403, 404]
    for q in got:
        for i, s in got[q]:
            assert s == pytest.approx(dict(true[q]).get(i, s), abs=1e-12)
    assert ann.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0
    three = df.where("vec_id IN (0, 1, 2)")
    assert [r["rank"] for r in ann.nearest(three, F.col("id") % 50 == 0).orderBy("rank").collect()] == [1, 2]


def test_recall_on_the_table(spark):
    e = duckdb.sql("SELECT * FROM '/root/testdata/sf0.1/embeddings.parquet' ORDER BY vec_id").df()
    m = np.stack(e["embedding"].to_numpy()).astype(float)
    ids = e["vec_id"].to_numpy()
    got = queries.op1_ann(spark, "/root/testdata/sf0.1").toPandas().groupby("query_id")["vec_id"].agg(set)
    hits = 0
    for a in np.flatnonzero(ids % 50 == 0):
        score = ann.cosines(m[a], m)
        score[a] = -2
        hits += len(got[ids[a]] & set(ids[np.argsort(-score)[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(got)


# --- 2 toxicity -----------------------------------------------------------------------------------


def test_grammar_weighs_clauses():
    symbols = Symbols({"moron": 8})

    def weight(text):
        return clauses(text, symbols)[0]
    plain = weight("what a moron that was")
    assert weight("you are a moron") > plain > weight("they said he was called a moron") - 0.6
    assert weight("he is not a moron") < plain and weight("she said it was a moron") < plain
    assert weight("i will kill you") > weight("kill it") > 0 == weight("nothing here. at all")
    assert weight("not here. moron there") == plain  # negation ends with its clause
    step, out = composed()
    assert len(step) == len(out) and all(len(r) == 9 for r in step)


def test_joined_words_and_long_clauses_are_scored(spark, monkeypatch):
    from quarry.llm import toxicity as module
    symbols = Symbols({"moron": 8, "笨蛋": 8})

    def weight(text):
        return clauses(text, symbols)[0]
    for text in ("you,idle/moron", "so...moron", "well--moron", "x\u2014moron", "a(moron)b"):
        assert clauses(text, symbols)[2] == 1 and weight(text) == weight(re.sub(r"[^a-z.]+", " ", text.replace(".", ". "))) > 0
    assert clauses("他真是个笨蛋。你好", symbols)[2] == 1
    assert weight("he is not here.moron there") == weight("moron there") == weight("not here! moron there")
    far = "someone said " + "and so on " * 60 + "a moron"
    assert weight(far) == weight("someone said a moron") < weight("a moron")
    texts = [far, "he is not. " * 9 + far, far + ". you moron", "plain words " * 50, far + ".  "]
    whole = [clauses(t, symbols) for t in texts]
    monkeypatch.setattr(module, "RUN", 40)
    assert [clauses(t, symbols) for t in texts] == whole
    insults = ["zarg", "blorf"]
    texts = [(n, f"well,{insults[n % 2]} number{n}" if n % 3 == 0 else f"some kind words{n}") for n in range(300)]
    labels = spark.createDataFrame([(n, int(n % 3 == 0)) for n in range(300)], "doc_id long, toxic int")
    got = toxicity(awkward(spark, texts), labels).collect()
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in got)


def test_toxicity_held_out_accuracy_and_awkward_rows(spark, docs):
    r = queries.op2_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").df()
    assert len(r) == 10_000 and r["score"].between(0, 1).all() and (r["predicted"] == (r["score"] >= 0.5)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(r["doc_id"], r["held_out"]))
    held = r[r["held_out"]].merge(labels, on="doc_id")
    assert held[held.toxic == 1].predicted.mean() > 0.85 and held[held.toxic == 0].predicted.mean() < 0.02
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity(awkward(spark), labels).collect()
    assert len(got) == 14 and len({x["score"] for x in got if x["doc_id"] in (3, 4, 5)}) == 1
    assert toxicity(empty(spark), labels).count() == 0 and toxicity(awkward(spark), labels.limit(0)).count() == 14


# --- 3 quality ------------------------------------------------------------------------------------


def test_quality_keeps_the_good_and_is_top_k(spark, docs):
    r = queries.op3_quality(spark, SF).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").df()
    seen = r.merge(labels, on="doc_id")
    assert seen[seen.quality == 1].kept.mean() > 0.99 and seen[seen.quality == 0].kept.mean() < 0.05
    k = int(r["kept"].sum())
    assert set(r.nlargest(k, "key")["doc_id"]) == set(r[r["kept"]]["doc_id"])
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (6, 1), (8, None), (None, 1), (9, 7)], "doc_id long, quality int")
    got = resample(awkward(spark), labels).collect()
    assert len(got) == 14 and all(x["log_weight"] == 0 for x in got if x["doc_id"] in (3, 4, 5))
    assert all(x["kept"] for x in resample(awkward(spark), labels.limit(0)).collect())
    assert resample(empty(spark), labels).count() == 0


# --- 4 token counts, 6 token files -----------------------------------------------------------------


def odd_texts(n):
    rng = random.Random(4)
    parts = list("ab cdE'st  \n\t\r12٣½²é́ ßşΣς漢字🙂!?.,-  　\x1c\x1f\x85\x0b_<|>’") + [
        "<|endoftext|>", "<|startoftext|>", " the", " don't", "I'LL", "  \n", "%%%", "word,", "Word."]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def test_counts_and_ids_match_the_library_on_odd_texts(docs):
    texts = odd_texts(1500) + docs["text"][:40].tolist() + ["x" * 5000, "ab" * 3000, "a " * 5000]
    library, words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    counter, encoder = (c(open(f, "rb").read()) for c, f in ((PairMerger, BYTES), (WordEncoder, WORDS)))
    assert [counter.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    ids = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.runs(pa.array(texts), 300)]
    assert ids == [words.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_counts_of_awkward_rows(spark):
    library = Tokenizer.from_file(BYTES)
    rows = awkward(spark)
    got = Counter(tuple(r) for r in token_counts(rows, BYTES).collect())
    true = Counter()
    for r in rows.collect():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        true[r["doc_id"], len((r["text"] or "").encode()), n, n > 1024] += 1
    assert got == true and token_counts(empty(spark), BYTES).count() == 0


def test_token_files_round_trip(spark):
    library = Tokenizer.from_file(WORDS)
    rows = awkward(spark)
    manifest = write_token_files(rows.repartition(3), WORDS)
    got = read_token_files(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda i: (i is not None, i))
    true = Counter()
    for r in rows.collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        true[r["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == true
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert read_token_files(write_token_files(empty(spark), WORDS)).count() == 0


# --- 5 decontamination ----------------------------------------------------------------------------


def test_leaks_match_brute_force(spark, docs):
    items = {r.item_id: r.text.lower().split() for r in duckdb.sql(f"SELECT * FROM '{SF}/benchmark.parquet'").df().itertuples()}
    grams = defaultdict(set)
    for i, w in items.items():
        for k in range(len(w) - 7):
            grams[tuple(w[k : k + 8])].add((i, k))
    hits = defaultdict(set)
    for r in docs.itertuples():
        w = r.text.lower().split()
        for k in range(len(w) - 7):
            for i, p in grams.get(tuple(w[k : k + 8]), ()):
                hits[r.doc_id, i].add(p)
    true = {k for k, v in hits.items() if len(v) >= min(20, math.ceil(0.4 * (len(items[k[1]]) - 7)))}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op5_decontamination(spark, SF).collect()}
    assert got == true


def test_other_numbers_and_names_leak_only_when_consistent(spark):
    item = "{} bought {} apples and 3 pears at the old market, then {} gave {} apples away to people on the street today."
    texts = [(1, "We ask: " + item.format("John Smith", 12, "John Smith", 12)), (2, item.format("Mary Jones", 40, "Mary Jones", 40)),
             (3, "x " + item.format("Mary Jones", 40, "Tom Hill", 41)), (4, None), (5, ""), (6, "quite another text " * 20),
             (None, item.format("Al Bo", 1, "Al Bo", 1)), (2, "more")]
    bench = spark.createDataFrame([(7, item.format("Ann Lee", 9, "Ann Lee", 9), "x"), (8, None, "x"), (None, "a b", "x"), (7, item.format("Ann Lee", 9, "Ann Lee", 9), "x")],
                                  "item_id long, text string, doc_id string")
    rows = awkward(spark, texts)
    assert {(r["doc_id"], r["item_id"]) for r in leaks(rows, bench).collect()} == {(1, 7), (2, 7)}
    assert Counter(r["doc_id"] for r in without_leaks(rows, bench).collect()) == Counter([3, 4, 5, 6, None])
    assert leaks(empty(spark), bench).count() == leaks(rows, bench.limit(0)).count() == 0
    assert without_leaks(rows, bench).columns == rows.columns


def test_short_dense_and_recased_items_leak(spark):
    named = "Maria Lopez met Ivan Petrov and Anna Schmidt near Big Ben before Tom Hill left for New York"
    items = ["What is the capital of France?", "12 + 7 = 19", "3 1 4 1 5 9 2 6 5 3 5 8 9 7 9 3", "Name the longest river", named]
    bench = spark.createDataFrame([*enumerate(items), (9, "?!"), (10, None)], "item_id long, text string")
    texts = [(n, f"some words go here first, then {t} and more words follow") for n, t in enumerate(items)]
    texts += [(10 + n, f"SOME WORDS; {t.upper()} AND MORE") for n, t in enumerate(items)]
    texts += [(20, items[0]), (21, named.lower()), (22, "What is the capital of Spain?"), (23, "12 + 7 = 20"),
              (24, "3 1 4 1 5 9 9 9 9 9 9 9 9 9 9 9"), (25, "name the second longest river"), (26, "capital of France"),
              (27, "what is the"), (28, "capital of france?")]
    got = {(r["doc_id"], r["item_id"]) for r in leaks(awkward(spark, texts), bench).collect()}
    assert got == {(n, n) for n in range(5)} | {(10 + n, n) for n in range(5)} | {(20, 0), (21, 4), (22, 0)}  # 22: another name


# --- 7 HTML ---------------------------------------------------------------------------------------


def test_rendering():
    assert render("<p>Hello <b>wor</b>ld &amp; co<p>Second\n para<br>line") == "Hello world & co\n\nSecond para\nline"
    assert render("<ul><li>one<li>two<ol start=3><li>x<li>y</ol><li>three</ul>end") == "- one\n- two\n  3. x\n  4. y\n- three\n\nend"
    table = "<table><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td rowspan=2>a<td>b<tr><td>c</table>after"
    assert render(table) == "Name       Qty\nApple pie  3\na          b\n           c\n\nafter"
    assert render("<head><title>t</title></head><div hidden>a</div><p style='display: none'>b</p><script>c()</script>d") == "d"
    assert render("a<pre> x\n   y</pre>b") == "a\n\n x\n   y\n\nb"
    assert render("<details><summary>S</summary>no</details><details open>yes</details>") == "S\nyes"
    assert render("<dl><dt>T<dd>D</dl><blockquote>q</blockquote>") == "T\n  D\n\n  q"
    for broken in ("", "<", "<p", "<a href='", "<!-- x", "<script>x", "</div></p>", "<td>x", "&#xfffffff;", "<div>" * 3000 + "x"):
        render(broken)


def test_long_attribute_values():
    for n in (10, 5_000, 100_000):
        for quote, other in ("\"'", "'\""):
            value = "{it" + other + "s > 1," + "x" * n + "}"
            page = f"<div data-x={quote}{value}{quote}><p>First visible words.</p><p>It's here</p></div>"
            assert render(page) == "First visible words.\n\nIt's here"
    assert render("<p don't>one</p><p>it's</p>") == "one\n\nit's"
    assert render("<a href=/q?a=\"x>y</a> z") == "y z" and render("<p title=\"never closed>one</p>two") == "one\n\ntwo"
    assert render("<a href='x" * 20_000) is not None and render('<a b="' * 20_001 + "x>y") is not None


def test_only_hidden_and_style_hide():
    for shown in ('title="The hidden door"', 'data-t="see hidden files"', 'class="menu hidden md"', 'data-style="display:none"',
                  'onclick="x.style=\'display:none\'"', 'style="display:none; display: block"', 'style="--display:none"', "data-hidden",
                  'style="/* display:none */ color:red"', 'alt=hidden', 'style="visibility:visible"'):
        assert render(f"<div {shown}>a</div>b") == "a\nb", shown
    for gone in ("hidden", 'class="x" HIDDEN', "hidden=''", 'style="color:red;DISPLAY : none"', "style=visibility:hidden",
                 'style="display:none !important; display:block"', "title='a'hidden", "style='display&#58;none'", "hidden/x"):
        assert render(f"<div {gone}>a</div>b") == "b", gone
    assert render('<details title="to open it"><summary>S</summary>no</details>') == "S"
    assert render('<ol data-start=7 title="start=9"><li>x</ol>') == "1. x"


def test_cells_keep_their_blocks():
    assert render("<table><tr><td><p>First para</p><p>Second para</p><ul><li>b<li>c</ul></td></tr></table>") == "First para\n\nSecond para\n\n- b\n- c"
    assert render("<table><tr><td>nav<td><h1>T</h1><p>body<table><tr><td>x<td>y<tr><td>long<td>z</table></table>") == "nav\n\nT\n\nbody\n\nx     y\nlong  z"
    # lines of a cell stand one below the other in its column
    assert render("<table><tr><td>a<br>bb<td>c<tr><td><p>d</p><td>e</table>") == "a   c\nbb\nd   e"
    assert render("<table><tr><td>k<td><pre>x = 1\n  y = 2</pre></table>") == "k  x = 1\n     y = 2"
    assert render("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>") == "a  b\n   c"
    assert render("<table><tr><td colspan=2>wide one<td>z<tr><td>1<td>2<td>3</table>").split("\n")[1] == "1  2  3"
    assert render("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>") == "a  b\n   c\n   d"


def test_visible_text_is_not_lost():
    assert render("<svg><title>t</title><defs><text>no</text></defs><text>label</text><text>two</text></svg>") == "label\ntwo"
    assert render("a <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> b") == "a x=1 2 b"
    assert render('<div style="visibility:hidden">no<p style="visibility:visible">yes</p>no</div>z') == "yes\n\nz"
    assert render('<div style="display:none">no<p style="visibility:visible">no</p></div>z') == "z"
    assert render('<div hidden style="display:block">yes</div>') == "yes"
    assert render("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"
    assert render("<textarea>a &amp; b</textarea>") == "a & b"
    assert render("<p>a" + "<b>" * 20 + "b</p>c") == "a" + "b\n\nc"


def test_wide_tables_and_deep_pages_take_time_of_their_size():
    import time
    wide = "<table><tr>" + "<td colspan=100 rowspan=1000>x" * 2_000 + "<tr><td>y" * 500 + "</table>"
    big = "<table><tr>" + "<td colspan=1000 rowspan=60000>x" * 20_000 + "<tr><td>last" * 20_000 + "</table>"
    deep = "<div>" * 50_000 + "</i>" * 5_000 + "end"
    for page, words in ((wide, 2_500), (big, 40_000), (deep, 1)):
        start = time.process_time()
        assert len(render(page).split()) == words
        assert time.process_time() - start < 3


def test_aligned_columns_against_a_grid():
    """Columns of cells from a plain grid, filled cell by cell."""
    rng = random.Random(5)
    for _ in range(200):
        rows = [[(f"r{r}c{c}", False, rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 2, 3])) for c in range(rng.randint(1, 4))] for r in range(5)]
        used, want = set(), []
        for r, row in enumerate(rows):
            at, line = 0, []
            for text, _, across, down in row:
                while (r, at) in used:
                    at += 1
                line.append((at, text, across))
                used |= {(y, x) for y in range(r, r + down) for x in range(at, at + across)}
                at += across
            want.append(line)
        assert places(rows) == want


def test_pages_keep_all_visible_words(spark):
    import html as h
    import re
    pages = duckdb.sql(f"SELECT * FROM '{SF}/pages.parquet'").df().set_index("page_id")
    got = queries.op7_html_text(spark, SF).toPandas().set_index("page_id")["text"]
    assert len(got) == len(pages)
    for i, page in pages["html"].items():
        seen = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script>.*?</script>|<style>.*?</style>", "", page)
        words = h.unescape(re.sub(r"(?s)<[^>]*>", lambda m: "" if re.match(r"</?(b|a)\b", m[0]) else " ", seen)).split()
        assert [w for w in got[i].split() if w != "-"] == [w for w in words if w != "-"]
    rows = spark.createDataFrame([(1, None, "t"), (None, "<p>x", "t"), (1, "", "t"), (2, "y" * 10_000, "t")], "page_id long, html string, text string")
    assert sorted(len(r["text"]) for r in page_texts(rows).collect()) == [0, 0, 1, 10_000]
    assert page_texts(rows.limit(0)).count() == 0


# --- 8 lines --------------------------------------------------------------------------------------


def test_edit_distance():
    rng = random.Random(3)

    def table(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            new = [i]
            for j, d in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]
    for _ in range(800):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(0, 25))) for _ in range(2))
        d = table(a, b)
        assert edit_distance(a, b) == d
        for limit in range(0, 12):
            found = edit_distance(a, b, limit)
            assert found == d if d <= limit else found > limit


def test_lines_match_brute_force(spark, docs):
    got = {(r["doc_id"], r["line"]): (r["kept_doc_id"], r["kept_line"]) for r in queries.op8_line_dedup(spark, SF).collect()}
    lines = {(r.doc_id, n): normal(x) for r in docs.itertuples() for n, x in enumerate(r.text.split("\n"))}
    first = {}
    for spot in sorted(lines):
        if len(lines[spot].split()) >= 4:
            if lines[spot] in first:
                assert spot in got  # every exact repeat
            first.setdefault(lines[spot], spot)
    assert set(got.values()).isdisjoint(got)
    groups = defaultdict(set)
    for spot, kept in got.items():
        groups[kept] |= {lines[spot], lines[kept]}
    for forms in groups.values():  # links inside a group reach all its forms
        forms = sorted(forms)
        reached, todo = {forms[0]}, [forms[0]]
        while todo:
            a = todo.pop()
            for b in set(forms) - reached:
                if edit_distance(a, b) <= 0.1 * max(len(a), len(b)):
                    reached.add(b)
                    todo.append(b)
        assert reached == set(forms)


def test_cluster_links_match_all_pairs():
    """With sketches that let every pair pass, a cluster's links give the components of all pairs compared."""
    import pyarrow as pa

    from quarry.llm.line_dedup import _alike
    rng, texts = random.Random(1), set()
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    for size in (4, 8, 20, 40) * 8:
        base = " ".join(rng.choice(words) for _ in range(size))
        for _ in range(8):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 7)):
                k = rng.randrange(len(t))
                t[k : k + rng.randrange(2)] = rng.choice(["", "a", "\u00e9", " ", "b"])
            texts.add("".join(t))
    forms = [normal(t) for t in sorted(texts)]
    zero = np.zeros(len(forms), np.int64)
    links = _alike(0.9)(pa.table({"h": np.arange(len(forms)), "s1": zero, "s2": zero, "text": sorted(texts)}))

    def components_of(pairs):
        group = list(range(len(forms)))
        for a, b in pairs:
            x, y = group[a], group[b]
            group = [min(x, y) if g in (x, y) else g for g in group]
        return group
    every = [(i, j) for i in range(len(forms)) for j in range(i)
             if edit_distance(forms[i], forms[j]) <= 0.1 * max(len(forms[i]), len(forms[j])) + 1e-9]
    assert components_of(zip(links["a"].to_pylist(), links["b"].to_pylist())) == components_of(every) and len(every) > 100


def test_lines_of_the_same_words_in_another_order_are_told_apart_cheaply(monkeypatch):
    """Equal counts of letters and of their pairs: runs of 4 tell the lines apart, not a distance each."""
    import pyarrow as pa

    from quarry.llm import line_dedup
    asked, whole = [], line_dedup._distance
    monkeypatch.setattr(line_dedup, "_distance", lambda *x: asked.append(x) or whole(*x))
    rng = random.Random(4)
    words, texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2)) for _ in range(80)], []
    for _ in range(60):
        rng.shuffle(words)
        texts.append(" ".join(words))
    texts.append("zz " + texts[0])
    zero = np.zeros(len(texts), np.int64)
    links = line_dedup._alike(0.9)(pa.table({"h": np.arange(len(texts)), "s1": zero, "s2": zero, "text": texts}))
    assert [set(x.values()) for x in links.to_pylist()] == [{0, 60}] and len(asked) < 20


def test_edit_distance_of_long_lines_stops_at_the_limit():
    rng = random.Random(8)
    for size in (70, 130, 300, 900) * 12:
        a = [rng.choice("abcd") for _ in range(size)]
        b = list(a)
        for _ in range(rng.randrange(0, size // 3)):
            k = rng.randrange(len(b))
            b[k : k + rng.randrange(2)] = rng.choice(["", "a", "b", "xy"])
        a, b = "".join(a), "".join(b)
        d = edit_distance(a, b)
        for limit in (0, 1, d - 17, d - 1, d, d + 1, d + 40):
            found = edit_distance(a, b, limit) if limit >= 0 else limit + 1
            assert found == d if d <= limit else found > limit


def test_lines_of_awkward_rows(spark):
    same = "The quick brown fox jumps over 12 lazy dogs and runs away from the farm into the wide open field"
    texts = [(3, f"{same}\nunique line number one here\n\n{same}"), (2, f"x\n{same.replace('12', '77').upper()}"), (4, None), (5, ""),
             (None, same), (6, "short line\nshort line"), (6, "short line\nshort line"), (7, "\n".join([same] * 500)),
             (8, same.replace("farm", "fart"))]
    rows = awkward(spark, texts)
    got = {(r["doc_id"], r["line"]) for r in repeated_lines(rows).collect()}
    assert {(3, 0), (3, 3)} | {(7, n) for n in range(500)} <= got <= {(3, 0), (3, 3), (8, 0)} | {(7, n) for n in range(500)}
    left = {r["doc_id"]: r["text"] for r in without_repeated_lines(rows).collect()}
    assert left[3] == "unique line number one here\n" and left[7] == "" and left[6] == "short line\nshort line" and left[4] is None
    assert without_repeated_lines(rows).columns == rows.columns and repeated_lines(empty(spark)).count() == 0


def test_lines_that_differ_in_words_or_letters_are_found(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    texts, planted = [], []
    for n in (6, 10, 15, 25, 40, 80) * 60:
        w = [rng.choice(words) for _ in range(n)]
        v = list(w)
        if len(planted) % 3:  # words replaced
            for _ in range(rng.randrange(1, 1 + max(1, n // 15))):
                v[rng.randrange(n)] = rng.choice(words)
            b = " ".join(v)
        else:  # single letters
            b = list(" ".join(v))
            for _ in range(max(1, len(b) // 25)):
                b[rng.randrange(len(b))] = rng.choice("abcdefgh")
            b = "".join(b)
        a = " ".join(w)
        if a != b and edit_distance(a, b) <= 0.1 * max(len(a), len(b)):
            planted.append((2 * len(texts), a))
            texts += [(2 * len(texts), a), (2 * len(texts) + 1, b)]
        else:
            planted.append(None)
    texts = [(i, t) for i, (_, t) in enumerate(texts)]
    got = {r["doc_id"] for r in repeated_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert len(texts) > 400 and len(got & set(range(1, len(texts), 2))) >= 0.97 * len(texts) / 2


# --- 9 near-duplicates ----------------------------------------------------------------------------


def brute_groups(texts, percent=85):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    by = defaultdict(list)
    for i in ids:
        for s in sets[i]:
            by[s].append(i)
    for i in ids:
        for j, n in Counter(j for s in sets[i] for j in by[s] if j < i).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("region,block", [(1024, 1024), (8, 8)])
def test_groups_match_brute_force(spark, docs, region, block, monkeypatch):
    from quarry.llm import near_dup
    monkeypatch.setattr(near_dup, "REGION", region)
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", block)
    rng = random.Random(5)
    base = " ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(120)).split()
    texts = list(zip(docs["doc_id"].tolist()[:400], docs["text"].tolist()))
    for n in range(120):  # near copies at all similarities around the limit
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        texts.append((10_000 + n, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect()}
    assert got == brute_groups(texts)


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_pairs_in_a_crowd_share_a_deep_region(similarity):
    from quarry.llm import near_dup
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 32, (100_000, near_dup.HASHES), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < similarity, a, a + np.uint32(1))
    sets = pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary()) for x in (a, b)], ["a", "b"])
    met = np.zeros(len(a), bool)
    for t in range(near_dup.TREES):
        rows = [{(r, d): k for batch in near_dup._deep_rows([pa.record_batch(
                    [sets[c], pa.array(np.arange(len(a))), pa.array(np.full(len(a), t, np.int32))], ["sig", "rep", "tree"])])
                 for r, d, k in [(batch["tree"][0].as_py(), batch["depth"][0].as_py(), batch["key"].to_numpy())]} for c in "ab"]
        for (tree, depth), key in rows[0].items():
            if depth == near_dup.DEEP:
                met |= key == rows[1][tree, depth]
    assert (~met).mean() <= 1e-4


def test_separate_pairs_in_a_template_crowd(spark, monkeypatch):
    from quarry.llm import near_dup
    monkeypatch.setattr(near_dup, "REGION", 2)
    rng = random.Random(9)

    def some(n):
        return [f"w{rng.randrange(10**7)}" for _ in range(n)]
    template, texts = some(200), []
    for n in range(250):
        own = some(125)
        texts += [(2 * n, " ".join(template + own)), (2 * n + 1, " ".join(template + own[:92] + some(33)))]
    true = brute_groups(texts, 80)
    assert len({c for _, c in true.values()}) == 250
    got = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), percent=80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == true


def test_regions_of_a_crowd_are_chosen_without_a_join(spark, monkeypatch):
    from quarry.llm import near_dup
    monkeypatch.setattr(near_dup, "REGION", 3)
    rng = random.Random(3)
    # nested regions: keys of depths 5 to 8 on two paths; rows that repeat are not in the table
    rows = [(rep, tree, depth, hash((tree, paths[: depth - 4])))
            for rep in range(60) for tree in (24, 48) for paths in [tuple(rng.randrange(3) for _ in range(4))] for depth in range(5, 9)]
    sizes = Counter(key for *_, key in rows)
    want = {}
    for rep, tree, depth, key in rows:
        want.setdefault((rep, tree), (key, sizes[key]))
        if want[rep, tree][1] > 3:
            want[rep, tree] = (key, sizes[key])
    deep = spark.createDataFrame([(key, rep, tree, depth) for rep, tree, depth, key in rows], "key long, rep long, tree int, depth int")
    got = near_dup._chosen(deep)
    assert Counter((r["rep"], r["key"], r["n"]) for r in got.collect()) == Counter((rep, *x) for (rep, _), x in want.items())
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_groups_of_awkward_rows(spark):
    rows = awkward(spark)
    got = near_duplicates(rows).collect()
    assert len(got) == 14
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["component_id"], r["kept"]))
    assert by[2] == {(1, False)} and by[7] == {(6, False)} and by[9] == {(8, False)} and by[8] == {(8, True)}
    assert by[3] == {(3, True)} and by[4] == {(4, True)} and by[5] == {(5, True)} and by[None] == {(None, True)}
    left = without_near_duplicates(rows)
    assert left.columns == rows.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([1, 3, 4, 5, 6, 8, None, None, 10, 11])
    assert near_duplicates(empty(spark)).count() == 0
    twice = awkward(spark, [(1, "a b c d e f g"), (1, "h i j k l m n"), (1, "a b c d e f g"), (2, "a b c d e f g")])
    assert Counter(r["text"] for r in without_near_duplicates(twice).collect()) == Counter(["a b c d e f g", "h i j k l m n"])


# --- 10 mixing ------------------------------------------------------------------------------------


def test_mix_targets_and_awkward_rows(spark):
    sizes = spark.createDataFrame([("b", 10), ("a", 1000), (None, 400), ("c", 90), ("d", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], (3, 1, 2, 3, 1)))
    most = {"a": 2000, "b": 20, "c": 180, "d": 0, None: 800}
    target, stopped = dict.fromkeys(weights, 0.0), set()
    while True:  # the excess is shared again until none is above
        left = 2250 - sum(most[s] for s in stopped)
        rest = [s for s in weights if s not in stopped]
        target = {s: most[s] if s in stopped else weights[s] * left / sum(weights[r] for r in rest) for s in weights}
        over = {s for s in rest if target[s] > most[s]}
        if not over:
            break
        stopped |= over
    assert got == pytest.approx(target)
    rows = awkward(spark)
    counts = mixing.mix_counts(rows).collect()
    assert len(counts) == 14 and all(r["taken"] <= 2 * r["size"] for r in counts)
    mixed = mixing.mix(rows)
    assert mixed.columns == rows.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({k: v for k, v in Counter(
        x for r in counts for x in [r["doc_id"]] * r["copies"]).items()})
    assert mixing.mix_counts(empty(spark)).count() == mixing.mix(empty(spark)).count() == 0


def test_mix_matches_sql_and_its_targets(spark, docs):
    documents = docs  # noqa: F841 - read by duckdb
    true = duckdb.sql(mixing.ORACLE).df().sort_values("doc_id").reset_index(drop=True)
    got = queries.op10_mixing(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, true)
    per = got.merge(docs[["doc_id", "source"]]).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(per.taken - per.target) <= 0.25 * per.target).all()


# --- the pipeline ---------------------------------------------------------------------------------


def test_pipeline_is_its_operators_one_after_another(spark, docs):
    text = docs.set_index("doc_id")["text"]
    kept = queries.op3_quality(spark, SF).where("kept").toPandas()["doc_id"].tolist()
    groups = brute_groups([(i, text[i]) for i in kept], 80)
    kept = [i for i in kept if groups[i][1] == i]
    leaked = {r["doc_id"] for r in queries.op5_decontamination(spark, SF).collect()}
    kept = [i for i in kept if i not in leaked]
    documents = docs[docs.doc_id.isin(kept)]  # noqa: F841 - read by duckdb
    copies = duckdb.sql(mixing.ORACLE).df().set_index("doc_id")["copies"]
    library, at, true = Tokenizer.from_file(WORDS), 0, []
    for i in sorted(kept):
        ids = np.array(library.encode(text[i], add_special_tokens=False).ids + [2], "<u4")
        for _ in range(copies[i]):
            true.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).orderBy("start").collect()]
    assert got == true
    assert len(corpus_pipeline.STAGES) == 5 and json.dumps([n for n, _ in corpus_pipeline.STAGES])


def test_pipeline_stages_take_awkward_rows(spark, tmp_path):
    pd.DataFrame({"doc_id": [1, 2], "quality": [1, 0], "toxic": [0, 0]}).to_parquet(tmp_path / "labels.parquet")
    pd.DataFrame({"item_id": [1], "text": ["a b"]}).to_parquet(tmp_path / "benchmark.parquet")
    for rows in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = shared.stored(stage(spark, rows, str(tmp_path)), name)
            assert name == "token_files" or out.columns == rows.columns
            if name == "token_files":
                assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
