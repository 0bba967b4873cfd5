"""What a task's helpers hold at once: bounded by their slices, whatever the words and tokens in them."""

import random
import tracemalloc

import pyarrow as pa

from reviewlab.llm import decontamination, token_files
from reviewlab.llm.words import plain_words_of


def test_retrieval_looks_up_a_bounded_number_of_blocks(monkeypatch):
    rng = random.Random(3)
    common = [f"word{i}" for i in range(40)]
    items = [(i, " ".join([*rng.sample(common, 6), *(f"own{i}x{j}" for j in range(18))])) for i in range(40)]
    texts = [" ".join(rng.choices(common, k=200)) for _ in range(12)] + [items[5][1], items[39][1]]
    index, words = decontamination.ItemIndex(items), plain_words_of(pa.array(texts))
    whole = index.retrieve(words)
    assert {(12, 5), (13, 39)} <= set(zip(*(x.tolist() for x in whole)))
    for limit in (1, 300):
        calls = []
        reaching = decontamination.ItemIndex._reaching
        monkeypatch.setattr(decontamination, "LOOKED_UP", limit)
        monkeypatch.setattr(decontamination.ItemIndex, "_reaching", lambda self, p, t, s: calls.append((len(set(p.tolist())), int(s.sum()))) or reaching(self, p, t, s))
        part = index.retrieve(words)
        monkeypatch.setattr(decontamination.ItemIndex, "_reaching", reaching)
        assert [x.tolist() for x in part] == [x.tolist() for x in whole]
        assert len(calls) > 3 and all(passages == 1 or blocks <= limit for passages, blocks in calls)


def test_encoding_holds_a_small_multiple_of_the_slice(monkeypatch):
    rng = random.Random(4)
    some = [f"{a}{b}" for a in ("re", "un", "in", "co") for b in ("view", "do", "put", "st", "é")]
    texts = pa.array([""] + [" ".join(rng.choices(some, k=400)) for _ in range(1000)] + ["", "a"]).slice(1)
    path = token_files.default_tokenizer()
    token_files.encode(texts.slice(0, 2), path)
    monkeypatch.setattr(token_files, "PUT_BACK", 1 << 14)
    tracemalloc.start()
    flat, bounds = token_files.encode(texts, path)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = sum(len(t.encode()) for t in texts.to_pylist())
    assert peak < 9 * size                      # 6.4 times; 12.6 before
    tokenizer, _ = token_files._load(path)
    for i in (0, 999, 1000, 1001):
        assert flat[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids
