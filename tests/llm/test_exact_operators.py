"""Operators with one right answer, against brute force."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

import helpers as h
from reviewlab.llm import components, decontamination, jaccard_join, substring_dedup, token_files
from reviewlab.llm.words import Words, plain_words_of, words_of

PAIRS = ["doc_id", "text"]


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select(*PAIRS).collect()]


# -- words ---------------------------------------------------------------------------------------------------------

def test_words_split_and_hash_like_the_specification():
    texts = ["a b  c", None, "", " x y z", "a b c", "A B\x1cC", "tab\tnew\nline\x0bv\x0cf\rr"]
    w = words_of(pa.array(texts), False)
    got = [len(range(a, b)) for a, b in zip(w.first, w.first[1:])]
    assert got == [len(h.words(t)) for t in texts]
    assert list(w.hash[w.first[0]:w.first[1]]) == list(w.hash[w.first[4]:w.first[5]])
    lower = words_of(pa.array(["ABC É"]), True).hash
    assert lower[0] == words_of(pa.array(["abc"]), False).hash[0]
    assert lower[1] != words_of(pa.array(["é"]), False).hash[0]           # A-Z only


def test_short_texts_make_one_window():
    w = words_of(pa.array(["a b", "a b c d e", "a b", "", "b a"]), False)
    v, b = w.windows(5, short=True)
    assert np.diff(b).tolist() == [1, 1, 1, 0, 1]
    assert v[0] == v[2] and len(set(v.tolist())) == 3
    assert plain_words_of(pa.array(["Ab-c, É!"])).hash.tolist() == plain_words_of(pa.array(["ab c é"])).hash.tolist()


# -- op2 -----------------------------------------------------------------------------------------------------------

def brute_tokens(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_files.default_tokenizer())
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["a  b", "a b ", " a", "  ", "\n\nx\n y", "x  y", "  z", "it's  I'll '", "1 234 5,6", "<|endoftext|> x", "é è́ ñ", "日本 語 x", "a\r\n b\t c", "　 q", "😀 😀x"]


def test_pieces_encode_like_whole_texts():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(token_files.default_tokenizer())
    texts = ODD + [a + b for a in ODD for b in ODD]
    flat, bounds = token_files.encode(pa.array(texts), token_files.default_tokenizer())
    for i, text in enumerate(texts):
        assert flat[bounds[i]:bounds[i + 1]].tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_of_random_texts_encode_like_whole_texts():
    import random

    from tokenizers import Tokenizer
    path = token_files.default_tokenizer()
    t, rng = Tokenizer.from_file(path), random.Random(5)
    parts = [*"a s 1 . , ! ' '' - _ é É × ÷ Ж ё ł ñ ª ½ ² … » 日本 😀 e\u0301 The there 'll n't don <|endoftext|> <| endoftext |> 23".split(" "),
             " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x00", "\x7f", "\x85", "\xa0", "\u2003", "\u3000", "\ufeff"]
    for some in (6, 15, len(parts)):
        for _ in range(12):
            kept = rng.sample(parts, some)
            texts = ["".join(rng.choices(kept, k=rng.randrange(12))) for _ in range(150)]
            flat, bounds = token_files.encode(pa.array(["é ", *texts]).slice(1), path)
            for i, e in enumerate(t.encode_batch(texts, add_special_tokens=False)):
                assert flat[bounds[i]:bounds[i + 1]].tolist() == e.ids, repr(texts[i])


def test_words_are_encoded_once_whatever_stands_around_them(monkeypatch):
    seen = []
    ids_of_words, ids_of_pieces = token_files._ids_of_words, token_files._ids_of_pieces
    monkeypatch.setattr(token_files, "_ids_of_words", lambda w, *a: (seen.append(w.to_pylist()), ids_of_words(w, *a))[1])
    monkeypatch.setattr(token_files, "_ids_of_pieces", lambda p, *a: (seen.append(p.to_pylist()), ids_of_pieces(p, *a))[1])
    text = "so été, so été. so été\nso? so été! (so) so;\nso's"
    flat, bounds = token_files.encode(pa.array([text] * 3), token_files.default_tokenizer())
    assert [sorted(s) for s in seen] == [[" so", " été", "so"], ["\n", " (", "!", "'s", ")", ",", ".", ";", "?"]]
    from tokenizers import Tokenizer
    assert flat.tolist() == 3 * Tokenizer.from_file(token_files.default_tokenizer()).encode(text, add_special_tokens=False).ids


def test_other_pre_tokenizers_keep_their_own_words(tmp_path):
    import random

    from tokenizers import AddedToken, Regex, Tokenizer, pre_tokenizers
    path, rng = str(tmp_path / "t.json"), random.Random(6)
    t = Tokenizer.from_file(token_files.default_tokenizer())
    t.add_tokens([AddedToken("the", normalized=False)])
    t.save(path)
    first = [path]
    t = Tokenizer.from_file(token_files.default_tokenizer())
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(r" ?[^\s]+|\s+(?!\S)|\s+"), "isolated"),
                                               pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    t.save(str(tmp_path / "u.json"))
    for path in [*first, str(tmp_path / "u.json")]:
        t = Tokenizer.from_file(path)
        texts = ["".join(rng.choices(["the", "a", "ther", " ", " ", ".", "1", "\n", "n't"], k=rng.randrange(12))) for _ in range(300)]
        flat, bounds = token_files.encode(pa.array(texts), path)
        for i, text in enumerate(texts):
            assert flat[bounds[i]:bounds[i + 1]].tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files_round_trip(spark, docs, frame):
    for df in (docs, frame.select(*PAIRS).union(frame.select(*PAIRS).limit(3)).union(spark.createDataFrame([(None, "no id")], "doc_id long, text string"))):
        got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_output(df).collect()]
        assert sorted(got, key=lambda r: r[1]) == brute_tokens(rows_of(df))


def test_token_files_several_files_a_task(spark, docs):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)
    try:
        same = spark.createDataFrame([(5, f"text {i}") for i in range(20)] + [(None, f"no id {i}") for i in range(20)], "doc_id long, text string")
        df = docs.select(*PAIRS).union(same)
        got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.token_output(df).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted(got, key=lambda r: r[1]) == brute_tokens(rows_of(df))


def test_token_files_empty_and_lookup(spark, docs, tmp_path):
    assert token_files.token_output(docs.limit(0)).collect() == []
    path = str(tmp_path / "orc")
    token_files.write_token_files(docs, path)
    found = token_files.lookup(spark, path, [3, 5])
    assert sorted(r.doc_id for r in found.collect()) == [3, 5]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString()


# -- op9 -----------------------------------------------------------------------------------------------------------

def test_repeated_windows(spark, docs, frame):
    more = spark.createDataFrame([(901, "a b c " * 40), (902, "y " * 35), (903, "z " * 36), (None, "p q r " * 30), (None, "p q r " * 30)], "doc_id long, text string")
    for df in (docs.select(*PAIRS), frame.select(*PAIRS).union(more), frame.select(*PAIRS).union(frame.select(*PAIRS).limit(2))):
        got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.removal_digest(df).collect()), key=str)
        assert got == sorted(h.removed_windows(rows_of(df)), key=str)


def test_windows_empty_table_and_text(docs, frame):
    assert substring_dedup.removal_digest(docs.limit(0)).collect() == []
    left = {r.doc_id: r.text for r in substring_dedup.deduplicated(frame).collect()}
    assert left[1] == "" and left[4] == "" and left[7] == "one two"
    assert substring_dedup.merged(np.array([50, 0, 1]), np.array([1, 1, 2])) == [(0, 37), (50, 85)]


# -- op10 ----------------------------------------------------------------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 150: 150, 200: 150}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def near_copies(seed, base_words, copies, edits):
    rng = np.random.default_rng(seed)
    base = [f"b{seed}x{i}" for i in range(base_words)]
    out = []
    for c in range(copies):
        w = list(base)
        for _ in range(int(rng.integers(0, edits + 1))):
            w[int(rng.integers(0, len(w)))] = f"e{rng.integers(0, 50)}"
        out.append(" ".join(w[: len(w) - int(rng.integers(0, 4))]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_match_brute_force(spark, docs, frame, seed):
    texts = near_copies(seed, 60, 70, 6) + near_copies(seed + 10, 200, 40, 12) + near_copies(seed + 20, 9, 30, 1)
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [f"{shared} " + " ".join(f"t{j}u{i}" for i in range(30 + j)) for j in range(40)]      # a passage, not copies
    df = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string").union(frame.select(*PAIRS))
    if seed == 1:
        df = df.union(docs.select((docs.doc_id + 100_000).alias("doc_id"), "text"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(df.repartition(5)).collect()}
    assert got == h.jaccard_components(rows_of(df))


def test_jaccard_long_lists_and_hot_table(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 2)
    monkeypatch.setattr(jaccard_join, "HOT_LIMIT", 10)
    texts = near_copies(5, 80, 120, 7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(df).collect()}
    assert got == h.jaccard_components(list(enumerate(texts)))


def test_one_of_each_keeps_columns(frame):
    kept = jaccard_join.one_of_each(frame.union(frame.limit(2)))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 9, 10, 11]
    assert jaccard_join.similar_components(frame.limit(0)).collect() == []


def test_jaccard_keys_rows_not_ids(spark):
    """An id with two texts, null ids with and without copies: near copies are found by row, and no other row goes."""
    def text(name, edit=None):
        return " ".join("other" if i == edit else f"{name}{i}" for i in range(120))
    rows = [(1, text("a")), (1, text("b")), (7, text("b", 60)), (8, text("c")), (None, text("c", 50)), (None, text("d")), (None, text("e")),
            (None, text("e")), (None, text("e", 40)), (None, ""), (None, ""), (3, None), (9, text("f")), (9, text("f"))]
    for turn in (rows, rows[::-1]):
        df = spark.createDataFrame([(*r, i) for i, r in enumerate(turn)], "doc_id long, text string, row_key int").repartition(3)
        got = jaccard_join.similar_components(df).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == {1: 1, 7: 1, 8: 8, 3: 3, 9: 9}
        free = [r.component_id for r in got if r.doc_id is None]
        assert free.count(8) == 1 and free.count(None) == 2 and len(set(free)) == 4       # 8, d, e (three rows), no words
        kept = jaccard_join.one_of_each(df)
        assert kept.columns == df.columns
        names = sorted((r.doc_id or 0, ("-" if r.text is None else r.text[:1])) for r in kept.collect())
        assert names == [(0, ""), (0, ""), (0, "d"), (0, "e"), (1, "a"), (1, "b"), (3, "-"), (8, "c"), (9, "f")]


# -- op1 -----------------------------------------------------------------------------------------------------------

def plain(text):
    import re
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ", text.lower()).split()


def brute_leaks(rows, items):
    out = set()
    for d, text in rows:
        w = plain(text or "")
        held = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        for i, item in items:
            q = plain(item or "")
            inside = set()
            for k in range(len(q) - 4):
                if tuple(q[k:k + 5]) in held:
                    inside.update(range(k, k + 5))
            if q and len(inside) >= 0.8 * len(q):
                out.add((d, i))
    return out


def test_leaks_match_brute_force(spark, docs):
    from reviewlab.llm.common import table
    bench = table(spark, "/root/testdata/sf0.001", "benchmark")
    items = [(r.item_id, r.text) for r in bench.collect()]
    planted = [(9000 + i, "Lead in. " + items[i][1].upper() + " trailing words here") for i in range(0, 40, 5)]
    w = items[1][1].split()
    planted.append((9100, " ".join(w[: len(w) // 3])))                       # a third of an item is no leak
    df = docs.select(*PAIRS).union(spark.createDataFrame([*planted, (9200, None), (9201, "")], "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(df, bench).collect()}
    assert got == brute_leaks(rows_of(df), items) and {(9000 + i, i) for i in range(0, 40, 5)} <= got


def test_long_items_answers_and_shards(spark, monkeypatch):
    long = " ".join(f"q{i}" for i in range(400))
    bench = spark.createDataFrame([(1, long), (2, "What is the tallest peak on the moon? It is called mons huygens"), (3, None), (4, ""), (5, "tiny item")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " * 30 + long + " y" * 30), (2, "what is the tallest peak on the moon it is called mons huygens ok"),
                                  (3, "what is the tallest peak on the moon nobody knows"), (4, "a tiny item here"), (5, " ".join(f"q{i}" for i in range(60)))],
                                 "doc_id long, text string")
    want = {(1, 1), (2, 2), (4, 5)}
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()} == want
    monkeypatch.setattr(decontamination, "SHARD_ITEMS", 1)
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()} == want
    assert sorted(r.doc_id for r in decontamination.without_leaks(docs, bench).collect()) == [3, 5]
    assert decontamination.leaks(docs, bench.limit(0)).collect() == []
    assert decontamination.without_leaks(docs.limit(0), bench).collect() == []


def test_wand_skips_nothing_that_reaches_the_threshold():
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"w{x}" for x in rng.zipf(1.5, 30) % 200)) for i in range(60)]
    index = decontamination.ItemIndex(items)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.5, 150) % 200) for _ in range(20)] + [t for _, t in items[:10]]
    got = set(zip(*(c.tolist() for c in index.retrieve(plain_words_of(pa.array(texts))))))
    dense = np.zeros((len(index.vocabulary), len(items)))
    for t in range(len(index.vocabulary)):
        s = slice(index.post_first[t], index.post_first[t + 1])
        dense[t, index.post_item[s]] = index.post_gain[s]
    want = set()
    for n, text in enumerate(texts):
        hashes = plain_words_of(pa.array([text])).hash
        for p in range(max(1, -(-len(hashes) // 32) - 1)):
            terms = np.flatnonzero(np.isin(index.vocabulary, hashes[32 * p:32 * p + 64]))
            want |= {(n, int(i)) for i in np.flatnonzero(dense[terms].sum(0) >= 1 - 1e-9)}
    assert got == want and len(want) >= 10


# -- SQL -----------------------------------------------------------------------------------------------------------

def test_queries_match_their_sql(spark, duck):
    from reviewlab.llm.queries import QUERIES, SQL
    con = duck("/root/testdata/sf0.001")
    for key, sql in SQL.items():
        got, want = QUERIES[key](spark, "/root/testdata/sf0.001").toPandas(), con.sql(sql).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        assert sorted(map(tuple, got[cols].round(9).itertuples(index=False))) == sorted(map(tuple, want[cols].round(9).itertuples(index=False)))


def test_op10_leaves_no_table_and_no_staged_folder(spark):
    """Only the result's own folder outlives the join; the catalog is as before."""
    import os

    from reviewlab.llm import jaccard_join
    from reviewlab.llm.common import shared_path
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:39])), (3, "a b c d e f"), (4, None)], "doc_id long, text string")
    base = os.path.dirname(shared_path(spark, "x").removeprefix("file:"))
    tables, folders = len(spark.catalog.listTables()), set(os.listdir(base))
    rows = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_components(docs).collect()}
    kept = jaccard_join.one_of_each(docs)
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - folders}
    assert rows == {1: 1, 2: 1, 3: 3, 4: 4}
    assert left == {"components", "near-duplicates"} and len(spark.catalog.listTables()) == tables
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
