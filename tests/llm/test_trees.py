"""Merkle manifest, document fingerprints and the prefix trie, against brute force."""

import hashlib
import random

import pytest

import helpers as h
from reviewlab.llm import fingerprints as fp
from reviewlab.llm import merkle_manifest, prefix_trie, queries

SMALL = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def plain(rows):
    """Rows as sortable tuples, nulls first."""
    return sorted((tuple((x is not None, x if x is not None else 0) for x in r) for r in rows))


# -- op11 ----------------------------------------------------------------------------------------------------------

def manifest_of(df):
    return plain(tuple(r) for r in merkle_manifest.audit(df).collect())


def test_manifest_of_the_documents(spark, docs):
    got = queries.QUERIES["op11_merkle_manifest"](spark, SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = h.manifest_rows([tuple(r) for r in docs.select(*FIELDS).collect()])
    assert plain(tuple(r) for r in got.collect()) == plain(want)
    assert len({r[6] for r in want}) == 2                                # some verified, some not


def test_manifest_with_odd_rows_over_many_blocks(spark, monkeypatch):
    """Three tiers of blocks of nine; null and repeated keys, whole repeats, a lone leaf, a null and an empty source."""
    monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", 2)
    rows = [(i, "hot", "en", i, f"text {i}\nline\n" if i % 3 else None) for i in range(100)]
    rows += [(None, "hot", None, None, "no id\n"), (7, "hot", "en", 7, "other\n"), (5, "hot", "en", 5, "text 5\nline\n")]
    rows += [(200, None, None, None, None), (201, "", "", 0, ""), (202, "é", "fr", 1, "é\n"), (203, "lone", "x", 9, "\n")]
    rows += [(300 + i, f"s{i}", "en", 1, "a\nb") for i in range(30)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, key string, score int")
    assert manifest_of(df) == plain(h.manifest_rows(rows))


def test_manifest_proofs_fold_and_empty_tables(spark, docs):
    from pyspark.sql import functions as F
    leaves = merkle_manifest.tampered_leaves(docs, FIELDS, "doc_id", "text")
    signed = merkle_manifest.manifest(leaves, "source", "doc_id", "leaf")
    folds = signed.select((merkle_manifest.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"))
    assert folds.where("ok").count() == docs.count()
    assert merkle_manifest.audit(docs.limit(0)).collect() == []


# -- op12 ----------------------------------------------------------------------------------------------------------

def edited_rows(rows):
    """The query's rows by a plain loop; rows: (doc_id, text) in order."""
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = map(fp.fingerprint, (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return out


@pytest.mark.parametrize("block_rows", [fp.BLOCK_ROWS, 20])
def test_edited_fingerprints(docs, block_rows):
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    assert plain(tuple(r) for r in fp.edited_fingerprints(docs, block_rows).collect()) == plain(edited_rows(rows))


def test_edited_fingerprints_of_odd_rows(spark, frame):
    got = fp.edited_fingerprints(frame, 3).collect()
    rows = sorted((r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect())
    assert plain(tuple(r) for r in got) == plain(edited_rows(rows))
    assert fp.edited_fingerprints(frame.limit(0)).collect() == []
    one = fp.edited_fingerprints(frame.where("doc_id = 1")).collect()
    assert [r.near_next for r in one] == [1.0]                           # its own next
    twins = spark.createDataFrame([(None, "a b"), (None, None), (1, "x y z"), (1, "x y z"), (1, "q")], "doc_id long, text string")
    got = fp.edited_fingerprints(twins, 1).collect()
    assert len(got) == 5 and sum(r.doc_id is None for r in got) == 2 and {r.n_chars for r in got} == {0, 1, 3, 5}


def test_fingerprints_locate_edits_and_grade_likeness():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "eta", "theta", "iota", "kappa"]
    lines = [" ".join(rng.choices(words, k=30)) + f" {i}." for i in range(60)]
    text = "\n".join(lines)
    mark = fp.fingerprint(text)
    assert mark == fp.fingerprint("\n".join(lines)) and fp.likeness(mark, mark) == 1.0 and fp.differences(mark, mark) == []
    changed = fp.fingerprint("\n".join([*lines[:40], "something new here", *lines[41:]]))
    flat = [(n, m) for n, s in enumerate(mark.split("/")[1:]) for m in range(s.count(".") + 1)]
    assert fp.differences(mark, changed) == [flat[40]]
    assert 0.95 < fp.likeness(mark, changed) < 1.0
    assert fp.likeness(mark, fp.fingerprint("\n".join(lines[::-1]))) < 1.0          # the same lines in another order
    assert fp.likeness(mark, fp.fingerprint("")) == 0.0 and fp.likeness(fp.fingerprint(""), fp.fingerprint(None)) == 1.0
    previous = 1.0
    for share in (10, 30, 50):
        near = fp.likeness(mark, fp.fingerprint("\n".join([*lines[share:], *[f"new line {i}" for i in range(share)]])))
        assert near < previous
        previous = near
    for odd in ("a" * 5000, " " * 3000, "\n" * 40, "日本語" * 500, "x\r\ny\t\tz", "a    b" * 100):
        assert "".join(x for line in odd.split("\n") for x in fp._PHRASES.findall(line)) == odd.replace("\n", "")
        assert fp.likeness(fp.fingerprint(odd), fp.fingerprint(odd + "!")) < 1.0


def test_fingerprint_table(docs):
    got = fp.fingerprints(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts) and all(r.fingerprint == fp.fingerprint(texts[r.doc_id]) for r in got)
    assert all(r.n_paragraphs == (texts[r.doc_id] or "").count("\n") + 1 and 1 <= r.n_sections <= r.n_paragraphs for r in got)


# -- op13 ----------------------------------------------------------------------------------------------------------

def test_trie_of_the_conversations(spark):
    got = queries.QUERIES["op13_prefix_trie"](spark, SMALL)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert plain(tuple(r) for r in got.collect()) == plain(h.trie_rows(rows))


def test_trie_of_odd_conversations(spark, monkeypatch):
    """Copies, nulls, one long conversation, bases that are short or absent, turnless rebuilds, a salted parent."""
    monkeypatch.setattr(prefix_trie, "HEAVY", 3)
    monkeypatch.setattr(prefix_trie, "PACK_BITS", 2)
    rng = random.Random(3)
    rows = [(c, t, "u" if t % 2 else "a", rng.choice(["x", "y z", "p q r"])) for c in range(120) for t in range(rng.randint(1, 6))]
    rows += [(c, t, "a", "same words here") for c in range(200, 240) for t in range(5)]
    rows += [(400, t, "a", f"long {t}") for t in range(70)] + [(403, t, "a", f"long {t}") for t in range(70)]
    rows += [(500, None, "a", "first"), (500, 0, None, None), (500, 1, "", ""), (None, 0, "a", "nobody's"), (501, 0, "a", "only")]
    rows += [(520, 2, "b", "tie"), (520, 2, "a", "tie"), (520, 2, "a", "tie"), (541, 0, "a", "orphan"), (542, 0, "a", "orphan"), (543, 0, "a", "orphan")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id long, turn long, role string, text string, depth int, name string")
    got = prefix_trie.conversation_trie(df)
    assert plain(tuple(r) for r in got.collect()) == plain(h.trie_rows(rows))


def test_trie_of_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(empty).collect() == []
    nobody = spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(nobody).collect() == []
