"""Mixing, neighbours, HTML, toxicity, URL rules, language identification, and the pipeline."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import helpers as h
from reviewlab.llm import html_text, language_id, mixing, nn_descent, toxicity, url_rules
from reviewlab.llm.common import table

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# -- op3 -----------------------------------------------------------------------------------------------------------

def brute_exponent(words, budget, entropy, repeats):
    total = sum(words)
    p = np.array([w / total for w in words if w])
    ok = lambda t: (lambda q: -(q * np.log(q)).sum() <= entropy * math.log(len(p)) + 1e-9 and (q * (budget or total * (p / q).max()) / (p * total)).max() <= repeats + 1e-9)(
        p ** t / (p ** t).sum())
    if ok(0.0):
        return 0.0
    if not ok(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if ok(mid) else (mid, high)
    return high


def skewed(spark):
    rows = [(i, "w " * (5 + i % 7), "big") for i in range(400)] + [(1000 + i, "v " * (3 + i % 5), "mid") for i in range(60)] \
        + [(2000 + i, "u " * 4, "small") for i in range(10)] + [(3000, "", "void"), (3001, None, "void"), (3002, "n n n", None)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, key string, copies int")


@pytest.mark.parametrize("budget", [None, 900.0, 9000.0])
def test_mixture_meets_its_targets(spark, budget):
    docs = skewed(spark)
    plan = {r.key: r for r in mixing.plan(docs, budget).collect()}
    total = sum(r.words for r in plan.values())
    t = brute_exponent([r.words for r in plan.values()], budget, mixing.ENTROPY, mixing.REPEATS)
    z = sum((r.words / total) ** t for r in plan.values() if r.words)
    for r in plan.values():
        assert r.weight == pytest.approx((r.words / total) ** t / z if r.words else 0.0, abs=1e-6)
    got = mixing.sample(docs, budget).collect()
    if budget is None:
        assert {r.doc_id for r in got} == {r.doc_id for r in docs.select("doc_id").collect()}
    names = {"sbig": "big", "smid": "mid", "ssmall": "small", "null": None}
    longest = {"big": 11, "mid": 7, "small": 4, None: 3}
    for key, source in names.items():
        taken = [r for r in got if r.source == source]
        words, target = sum(r.n_words for r in taken), plan[key].target
        assert target - longest[source] < words <= target
        copies = {}
        for r in taken:
            copies.setdefault(r.doc_id, []).append(r.copy)
        assert all(sorted(c) == list(range(len(c))) for c in copies.values())
        held = {r.doc_id for r in docs.where("source <=> '%s'" % source if source else "source is null").collect()}
        full = plan[key].passes
        assert all(full <= len(copies.get(d, [])) <= full + 1 for d in held)
        # the last pass is a prefix of its permutation
        order = sorted((r.turn, r.ticket) for r in taken if r.copy == full)
        assert len(order) == len(set(order))
    assert sorted(r.doc_id for r in got if r.source == "void") == [3000, 3001]


def test_mix_keeps_columns_and_empty(spark, frame):
    out = mixing.mix(frame)
    assert out.columns == frame.columns and out.count() > 0
    assert mixing.mix(frame.limit(0)).collect() == [] and mixing.sample(frame.limit(0)).collect() == []
    only_empty = frame.where("text is null or trim(text) = ''")
    assert mixing.sample(only_empty).count() == only_empty.count()


# -- op4 -----------------------------------------------------------------------------------------------------------

def exact_nearest(rows, k=20, every=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for a in np.flatnonzero(ids % every == 0):
        s = x @ x[a]
        keep = np.flatnonzero(ids != ids[a])
        out[int(ids[a])] = [int(i) for i in ids[keep[np.lexsort((ids[keep], -s[keep]))]][:k]]
    return out


def recall(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, {})[r.rank] = r.vec_id
    return np.mean([len(set(by.get(q, {}).values()) & set(w)) / max(1, len(w)) for q, w in want.items()])


def test_neighbours_recall_and_scores(spark):
    df = table(spark, MEDIUM, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = nn_descent.nearest(df).collect()
    assert recall(got, exact_nearest(rows)) >= 0.95
    vec = dict(rows)
    for r in got[:200]:
        assert r.score == pytest.approx(float(np.dot(np.array(vec[r.query_id], float), np.array(vec[r.vec_id], float))), abs=1e-12)
    ranks = sorted((r.query_id, r.rank, -r.score) for r in got)
    assert all(a[2] <= b[2] for a, b in zip(ranks, ranks[1:]) if a[0] == b[0])


def test_neighbours_odd_vectors_and_copies(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.standard_normal(8) * rng.uniform(0.5, 3)]) for i in range(1, 90)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]                                   # many copies of one vector
    bad = [(300, None), (320, [0.0] * 8), (340, [1.0] * 7), (360, [float("nan")] * 8), (380, [None] * 8), (400, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = nn_descent.nearest(df).collect()
    want = exact_nearest(rows)
    assert {r.query_id for r in got} == set(want) and recall(got, want) >= 0.95
    few = spark.createDataFrame(rows[:0] + [(20, [1.0, 2.0]), (21, [2.0, 1.0]), (22, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id) for r in nn_descent.nearest(few).orderBy("rank").collect()] == [(20, 1, 21), (20, 2, 22)]
    assert nn_descent.nearest(df.limit(0)).collect() == []


@pytest.mark.parametrize("lengths", [0.2, 0.5, 1.0, 1.5, "x10", "x100", "x1000"])
def test_neighbours_of_spread_lengths(spark, monkeypatch, lengths):
    """Log-normal lengths, and one vector much longer than the others, over some twenty partitions and four blocks."""
    for name, value in (("LEAF", 100), ("LONGEST", 32), ("BLOCK", 512)):
        monkeypatch.setattr(nn_descent, name, value)
    x = np.array([r.embedding for r in table(spark, MEDIUM, "embeddings").collect()], float)
    if isinstance(lengths, float):
        x *= np.exp(np.random.default_rng(3).standard_normal(len(x)) * lengths)[:, None]
    else:
        x[7] *= float(lengths[1:])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert recall(got, exact_nearest(rows)) >= 0.95


def test_parallel_vectors(spark):
    """Many vectors of one direction and different lengths, beside others: the longest of them win."""
    rng = np.random.default_rng(5)
    line = rng.standard_normal(16)
    x = np.vstack([line * s for s in rng.permutation(700) + 1.0] + [rng.standard_normal((700, 16))])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = nn_descent.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert recall(got, exact_nearest(rows)) >= 0.95


# -- op5 -----------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=x>Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies, the best of the web for you and for all of us in it.</div><aside>Side of the road</aside>
<article><header><h2>Title &amp; more</h2></header><p>First&nbsp;line
 of <b>text</b>, caf&eacute; &#x41;.<br>Same block<p>Second <a href=q>link</a> block</p><div class="ad">Buy the thing</div>
<form><p>Mail</p><input></form><table><tr><td>Cell one</td><td>Cell two</td></tr></table></article>
<section id="comments"><p>I am a reader and this is the best of it for you to read in the morning with all of them.</p></section>
<footer>&copy; the footer</footer></body></html>"""


def test_page_rules():
    assert html_text.main_text(PAGE) == "Title & more\n\nFirst line of text, café A. Same block\n\nSecond link block\n\nCell one\n\nCell two"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p>  </p>") == ""
    assert html_text.main_text("<article><p>open <b>and<p>unclosed &am") == "open and\n\nunclosed &am"


def test_second_pass_inherits_from_neighbours():
    good = "<p>It is the story of a man who was in the town and of what he did there for all of the people that he met.</p>"
    bad = "<p>" + "Xyzzy plugh frobnicate quux wibble " * 5 + "</p>"
    assert html_text.main_text(f"<div>{good}<p>Short.</p>{good}{bad}<p>Tiny</p>{bad}</div>").split("\n\n")[1] == "Short."
    assert "Tiny" not in html_text.main_text(f"<div>{good}<p>Short.</p>{good}{bad}<p>Tiny</p>{bad}</div>")
    assert html_text.main_text("<p>alone</p>") == "alone"


def test_html_optional_end_tags():
    """A page without the end tags that HTML lets it omit reads like the page that has them."""
    import re
    good = "It is the long one of the running texts and that is for all of the words in it to be read as a whole."
    whole = (f"<html><head><title>no</title><script>x()</script></head><body><p>{good} P.</p><div>{good} D.</div>"
             f"<ul><li class='ad'>{good} A.<ol><li>{good} B.</li></ol></li><li>{good} C.</li></ul>"
             f"<dl><dt class='promo'>{good} E.</dt><dd>{good} F.</dd><dd class='ad'>{good} G.</dd><dt>{good} H.</dt></dl>"
             f"<table><thead><tr class='ad'><th>{good} I.</th></tr></thead><tbody><tr class='ad'><td>{good} J.</td></tr><tr><td class='ad'>"
             f"<table><tr><td>{good} K.</td></tr></table></td><td>{good} L.</td></tr></tbody></table>"
             f"<p class='ad'>{good} M.</p><div>{good} N.</div><p class='ad'>{good} O.</p><hr>{good} Q.</body></html>")
    kept = [t[-2] for t in html_text.main_text(whole).split("\n\n")]
    assert kept == list("PDCFHLNQ")
    assert html_text.main_text(re.sub("</(head|body|html|p|li|dt|dd|thead|tbody|tr|td|th)>", "", whole)) == html_text.main_text(whole)
    for start in ("<p>", "<div>", "<body>", "<body class='x'><span>", "", "<br>", "<a href='/'></a>"):
        assert html_text.main_text(f"<!doctype html><html><head><meta charset='u'><title>no</title><style>p{{}}</style>\n{start}{good}") == good
    assert html_text.main_text(f"<head><title>a</title> <noscript><p>{good}</p></noscript></head><body><p>b</p></body>") == "b"


def test_deep_nesting_costs_no_more_than_flat_pages():
    import time
    n = 30000
    start = time.time()
    assert html_text.main_text("<div>x" * n) == "\n\n".join(["x"] * n)
    assert html_text.main_text("<ul><li><ul>" + "<div>" * n + "<li>a</li>" * n) == "\n\n".join(["a"] * n)
    assert html_text.main_text("<table>" + "<div>" * n + "<td>a</td></section>" * n) == "\n\n".join(["a"] * n)
    assert time.time() - start < 30


def test_extract_pages(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article>" + "é" * 100_000 + "</article>")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "page_id long, url string, html string, n_chars int")
    got = html_text.extract(df).collect()
    assert len(got) == 4 and {r.n_chars for r in got} == {0, 100_000, len(html_text.main_text(PAGE))}
    assert html_text.extract(df.limit(0)).collect() == []
    whole = html_text.extract(table(spark, SMALL, "pages")).collect()
    assert all(r.n_chars == len(r.text) for r in whole) and not any("track(" in r.text or "©" in r.text for r in whole)


# -- op6 -----------------------------------------------------------------------------------------------------------

def test_clause_machine():
    i, o, t, n, r, v, m = (getattr(toxicity, x) for x in ("INSULT", "OTHER", "TARGET", "NEGATION", "REPORT", "THREAT", "INTENT"))
    kinds = lambda *s: [k for k, _ in toxicity.clause_matches(list(s), [1.0] * len(s))]
    assert kinds(o, i) == [0] and kinds(t, o, i) == [1] and kinds(i, t) == [1]
    assert kinds(t, n, o, i) == [2] and kinds(n, o, o, o, i) == [0]
    assert kinds(r, o, t, i) == [3] and kinds(m, v, t) == [4] and kinds(v, t) == [] and kinds(m, o, v) == [] and kinds(n, m, v, t) == []


def test_toxicity_learns_whole_words_and_beginnings(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(900):
        w = [f"w{x}" for x in rng.integers(0, 400, 40)]
        toxic = i % 5 == 0
        if toxic:
            w[int(rng.integers(0, 40))] = ["grumpo", f"zorkle{rng.integers(0, 1000)}"][i % 2]
        rows.append((i, " ".join(w) + "."))
        labels.append((i, int(toxic), 1))
    rows += [(1000, None), (1001, ""), (1002, "you grumpo! " * 3), (None, "zorkle77 you")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, h string")
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, None, 0)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.toxic_scores(docs, lab).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    test = [i for i in range(900) if h.held_out(i)]
    assert all(got[i].held_out for i in test) and not got[None].held_out
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in test]) >= 0.97
    assert got[1002].predicted == 1 and got[1001].predicted == 0 and got[1000].score == got[1001].score
    assert {r.score < 0.01 for r in toxicity.toxic_scores(docs, lab.limit(0)).collect()} == {True}
    assert toxicity.toxic_scores(docs.limit(0), lab).collect() == []


def test_toxicity_on_the_tables(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    got = toxicity.toxic_scores(table(spark, sf, "documents").join(labels.select("doc_id"), "doc_id"), labels).where("held_out").join(labels, "doc_id").collect()
    hit = [r.predicted for r in got if r.toxic == 1]
    assert np.mean(hit) >= 0.85 and np.mean([r.toxic for r in got if r.predicted]) >= 0.8


# -- op7 -----------------------------------------------------------------------------------------------------------

def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].translate({i: i + 32 for i in range(65, 91)}), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for action, rule in url_rules.RULES:
        rh, rp = rule.split("/", 1)
        if (host == rh or host.endswith("." + rh)) and path.startswith("/" + rp) and (best is None or len(rule) > len(best[1])):
            best = (action, rule)
    return host, path, best and best[1], best and best[0]


def test_url_parts_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://ORG", "http://a.Org/", "x://example.org/es/1?q#f", "https://WWW.Example.org/en/12#t", "http://borg/x",
            "http://a.com/fr/", "http://a.com/de/x?y", "http://a.com?x=/de/", "http://a.com#/fr/", "ftp://ÀB.com/fr/é", "http://example.org/en/2", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)] + [(0, None, "z")], "page_id long, url string, host string")
    got = url_rules.verdicts(pages, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path, rule, action = brute_url(urls[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, action or "allow")
    assert url_rules.verdicts(pages.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def test_a_template_of_many_parameters_is_mined_at_once(spark):
    query = "&".join(f"name{k:02d}=1" for k in range(30))
    names = [f"q:name{k:02d}" for k in range(30)]
    items = [(["h:shop", "p:list", *names] + ([url_rules.BAD] if i % 10 else []),) for i in range(200)]
    items += [(["h:shop", f"p:w{i % 7}"] + ([url_rules.BAD] if i % 10 == 0 else []),) for i in range(400)]
    rules = url_rules.mine(spark.createDataFrame(items, "items array<string>"))
    got = {tuple(r.tokens): r.confidence for r in rules.collect()}
    assert got == {(t,): pytest.approx(0.9) for t in ["p:list", *names]}
    pages = spark.createDataFrame([("http://shop/x?" + query,), ("http://shop/x?name07=2",), ("http://shop/x?other=2",), ("http://a/list",)], "url string")
    hit = {r.url for r in url_rules.blocked_urls(url_rules.with_parts(pages), rules).collect()}
    assert hit == {"http://shop/x?" + query, "http://shop/x?name07=2", "http://a/list"}


def test_rules_of_tokens_with_equal_rows(spark):
    """a and its equal b are bad only together with c and its equal d."""
    items = [(["a", "b", "c", "d", url_rules.BAD],)] * 60 + [(["a", "b", "e"],)] * 90 + [(["c", "d", "f"],)] * 90 + [(["e", "f"],)] * 60
    items = [(["h:" + t if t != url_rules.BAD else t for t in r],) for r, in items]
    rules = url_rules.mine(spark.createDataFrame(items, "items array<string>"))
    assert [(r.tokens, r.choices) for r in rules.collect()] == [(["h:a", "h:c"], [["h:a", "h:b"], ["h:c", "h:d"]])]
    urls = [f"http://{x}.{y}/" for x in "abe" for y in "cdf"]
    hit = url_rules.blocked_urls(url_rules.with_parts(spark.createDataFrame([(u,) for u in urls], "url string")), rules)
    assert {r.url for r in hit.collect()} == {f"http://{x}.{y}/" for x in "ab" for y in "cd"}


def test_mined_rules(spark):
    urls, labels = [], []
    for i in range(400):
        spam = i % 4 == 0
        host = ("casino-win" if spam else f"site{i % 9}") + (".net" if i % 2 else ".info")
        urls.append((i, f"http://{host}/{'promo' if i % 3 else 'news'}/{i}"))
        labels.append((i, 0 if spam else 1, 0))
    urls += [(900, "https://casino-win.info/other"), (901, "http://fine.info/other")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = url_rules.mine(url_rules.labelled_urls(url_rules.with_parts(pages), lab)).collect()
    assert {tuple(r.tokens) for r in rules} == {("h:casino",), ("h:win",)}
    got = {r.page_id: r.verdict for r in url_rules.verdicts(pages, lab).collect()}
    assert got == {i: "block" if "casino" in u else "allow" for i, u in urls}


# -- op8 -----------------------------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = table(spark, MEDIUM, "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language_id.identify(docs).collect()
    assert len(got) == len(truth) and all(r.held_out == h.held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) >= 0.98


def test_language_odd_rows(spark, frame):
    got = {r.doc_id: r for r in language_id.identify(frame).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {4, 5, 6} and got[4].score == 0
    assert {r.lang_pred for r in language_id.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.identify(frame.limit(0)).collect() == []
    kept = language_id.language_filter(frame)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 7, 8, 9, 10, 11]
    long = "the " * 100_000 + "œuvre"
    assert language_id.presence(long).sum() > language_id.presence("the " * 100_000).sum()


# -- pipeline ------------------------------------------------------------------------------------------------------

def test_pipeline_stages_match_brute_force(spark, docs):
    import corpus_pipeline
    from reviewlab.llm import decontamination, token_files
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "mixing", "token_files"]
    odd = spark.createDataFrame([(7001, None, "en", "src1", 0), (7002, "12 34 !!", "en", "src1", 8)], docs.schema)
    now, kept = docs.union(odd), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in now.collect()}
        now = stage(spark, now, SMALL)
        rows = now.collect()
        kept[name] = rows
        ids = [r.doc_id for r in rows]
        if name == "language_id":
            assert set(before) - set(ids) == {7001, 7002}
        elif name == "jaccard_join":
            assert sorted(ids) == sorted(i for i, (_, c) in h.jaccard_components(list(before.items())).items() if i == c)
        elif name == "decontamination":
            from test_exact_operators import brute_leaks
            items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
            assert sorted(ids) == sorted(set(before) - {d for d, _ in brute_leaks(list(before.items()), items)})
        if name != "token_files":
            assert now.columns == docs.columns
    from test_exact_operators import brute_tokens
    want = brute_tokens([(r.doc_id, r.text) for r in kept["mixing"]])
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in kept["token_files"]), key=lambda r: r[1]) == want
    assert token_files and decontamination


def test_language_stage_drops_unknown_languages(spark, docs):
    """The identifier decides: shuffled letters and mixed languages score under the threshold, whole texts do not."""
    import random

    import corpus_pipeline
    rng = random.Random(5)
    noise = " ".join("".join(rng.choice("qwxzkjvy") for _ in range(rng.randint(2, 9))) for _ in range(60))
    by = {r.lang: r.text for r in docs.where("length(text) between 400 and 4000").orderBy("doc_id").collect()}
    mixed = " ".join(by[x][:200] for x in sorted(by))
    odd = spark.createDataFrame([(7001, noise, None, "src1", 0), (7002, mixed, None, "src1", 0)], docs.schema)
    ids = {r.doc_id for r in corpus_pipeline.language(spark, docs.union(odd), SMALL).collect()}
    assert ids == {r.doc_id for r in docs.collect()}
