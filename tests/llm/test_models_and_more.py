"""BPE, HTML, line templates, mixing, classifiers, embeddings, pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.conftest import corpus, with_clashes, words
from traitlab.llm import bpe, embeddings, html, lines, mixing, quality, toxicity
from traitlab.llm.queries import byte_bpe, token_digests


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- BPE


ODD = [
    "", " ", "  a  b  ", "a" * 5000, "it's we'll I'd they've you're I'm don't 'S ' s", "tab\t\ttab\n\n\nline \r\n x", "<|endoftext|>", "a <|endoftext|>b<|endoftext|> c <|endoftext|", "x\x1c y\x1d\x1e z\x85 w\xa0 v  u​ t", "漢字かな交じり文 " * 200,
    "🙂🙃 👩‍👩‍👧 é é ﬁ ① Ⅷ ٣ ১২৩ ²", "no safe place" .replace(" ", "\n") * 50, "word " * 3000, " leading and trailing ", "  sep   x", "a  b   c    d     e " * 100, "1234567890 3.14 -5 1e9 " * 50,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe())


def test_bpe_equals_the_library(spark, docs, library):
    texts = ODD + [t for _, t in corpus()]
    rng = random.Random(3)
    alphabet = "ab c\n\t'é漢🙂1 .,s　\x1c  "
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(3000))) for _ in range(60)]
    shared = words(rng, 3000)
    texts += [words(rng, 50) + " " + shared + " " + words(rng, 50) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in rows(bpe.encode_decode(with_clashes(df), byte_bpe()))}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert list(got[i]["ids"]) == want, repr((t or "")[:80])
        assert got[i]["decoded"] == library.decode(want, skip_special_tokens=False) == (t or "")


def test_bpe_shared_chunks_are_found_and_used(spark):
    rng = random.Random(4)
    passage = words(rng, 2000)
    df = spark.createDataFrame([(i, words(rng, 40) + " " + passage) for i in range(6)], "id long, t string")
    assert len(bpe.shared_chunks(df, byte_bpe())) >= 5


def test_bpe_decode_of_partial_characters(spark, library):
    ids = library.encode("漢字🙂", add_special_tokens=False).ids
    df = spark.createDataFrame([(1, ids[:2]), (2, ids[1:]), (3, None), (4, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in rows(bpe.decode_ids(df, byte_bpe()))}
    assert got == {1: library.decode(ids[:2]), 2: library.decode(ids[1:]), 3: "", 4: ""}


def test_bpe_empty(no_docs):
    assert rows(token_digests(bpe.encode_decode(no_docs, byte_bpe()))) == []


def test_cuts_depend_on_content_alone():
    rng = random.Random(5)
    a = words(rng, 4000)
    one, two = set(bpe.chunk_texts(a)), set(bpe.chunk_texts("other start " + a))
    assert len(one & two) >= len(one) - 3 and "".join(bpe.chunk_texts(a)) == a


# --- HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>x";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- <article>no</article> --><div class='ad'>Buy</div>{article}
<aside>Side</aside><div id="comments"><p>Reader</p></div><form><label>Mail</label><input></form><div class="cookie-notice">We use</div><footer>&copy; x</footer></body></html>"""


def test_html_article_only(spark):
    article = '<article class="post"><header><h1>Head &amp; line</h1></header><p>One <b>bo</b>ld&nbsp;&#33;<br>two\n  three<p>next<div class="share">Tweet</div><ul><li>i<li>j</ul><script>x</script></article>'
    lines_, marks = html.text_lines(PAGE.format(article=article))
    assert " ".join(x for x, m in zip(lines_, marks) if m == html.ARTICLE) == "Head & line One bold ! two three next i j"


def test_html_truncated():
    text = lambda page: " ".join(x for x, m in zip(*html.text_lines(page)) if m == html.ARTICLE)
    assert text("<article><p>a b &am") == "a b &am"
    assert text("<article><p>a b &amp") == "a b &"
    assert text("<article><p>a b</p><p cla") == "a b"
    assert text("<article><p>1 < 2 and <b>3</b> > 2") == "1 < 2 and 3 > 2"
    assert text("<article><p>a</p><!-- open") == "a"
    assert text("<article><p>a</p><script>open") == "a"


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            t[i][j] = t[i + 1][j + 1] + 1 if a[i] == b[j] else max(t[i + 1][j], t[i][j + 1])
    return t[0][0]


def test_lcs_is_longest():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(0, 12)), rng.integers(0, 5, rng.integers(0, 12))
        mask = html.lcs_shared(a, b)
        assert mask.sum() == brute_lcs(a.tolist(), b.tolist())
        it = iter(b.tolist())
        assert all(x in it for x in a[mask].tolist())


def test_html_differencing_without_article(spark):
    body = "<html><body><div>Brand</div><div>{0}</div><div>Links</div></body></html>"
    data = [(i, f"http://h.example/a/{i}", body.format(f"text of page {i}")) for i in range(7)] + [(50, "http://other.example/z", body.format("alone")), (51, None, body.format("no url")), (52, "http://h.example/a/0", None), (None, "http://h.example/a/9", body.format("no id")), (53, "http://copy.example/1", body.format("<article>same</article>")), (54, "http://copy.example/2", body.format("<article>same</article>"))]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r for r in rows(html.main_text(with_clashes(df)))}
    assert len(got) == len(data)
    assert [got[i]["text"] for i in range(1, 7)] == [f"text of page {i}" for i in range(1, 7)]
    assert got[50]["text"] == "Brand alone Links" and got[52]["text"] == "" and got[53]["text"] == got[54]["text"] == "same"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_html_differencing_decides_inside_articles_and_passes_over_copies(spark):
    marked = "<html><body><article><p>Share this</p><p>{0}</p><p>Read more soon</p></article></body></html>"
    plain = "<html><body><div>Brand</div><div>{0}</div><div>Links</div></body></html>"
    data = [(i, f"http://a.x/p/{i}", marked.format(f"story {i}")) for i in range(4)]
    data += [(10 + i, "http://b.x/same", plain.format("twice")) for i in range(12)] + [(30, "http://b.x/z", plain.format("other"))]
    data += [(40 + i, "http://c.x/only", plain.format("alone")) for i in range(2)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in rows(html.main_text(df))}
    assert [got[i] for i in range(4)] == [f"story {i}" for i in range(4)]
    assert {got[10 + i] for i in range(12)} == {"twice"} and got[30] == "other"
    assert {got[40], got[41]} == {"Brand alone Links"}


def test_html_prose_that_neighbours_share_stays(spark):
    """An article line goes only by the host's evidence, not because the
    neighbour happens to hold it."""
    marked = "<html><body><nav><p>Top stories</p></nav><article><p>{0}</p><p>{1}</p></article></body></html>"
    second = ["A sentence of two articles.", "A sentence of two articles.", "Top stories", "Top stories", "fifth", "sixth", "seventh"]
    data = [(i, f"http://a.x/{'top/' if x == 'Top stories' else 'p/'}{i}", marked.format(f"story {i}", x)) for i, x in enumerate(second)]
    data += [(20 + i, f"http://b.x/{i}", marked.format(f"tale {i}", "Both pages of a small host.")) for i in range(2)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in rows(html.main_text(df))}
    want = [f"story {i}" + ("" if x == "Top stories" else f" {x}") for i, x in enumerate(second)]
    assert [got[i] for i in range(len(second))] == want
    assert [got[20 + i] for i in range(2)] == [f"tale {i} Both pages of a small host." for i in range(2)]


def test_lcs_of_very_long_pages(monkeypatch):
    """Two pages of 50,000 common lines in another order: the longest common
    subsequence is the longest rising run, in little memory."""
    import bisect
    import tracemalloc

    a, b = np.arange(50_000), np.random.default_rng(3).permutation(50_000)
    tails: list[int] = []
    for v in b.tolist():
        at = bisect.bisect_left(tails, v)
        tails[at : at + 1] = [v]
    tracemalloc.start()
    mask = html.lcs_shared(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert mask.sum() == len(tails) and peak < 100e6
    it = iter(b.tolist())
    assert all(x in it for x in a[mask].tolist())
    monkeypatch.setattr(html, "CELLS", 4)
    test_lcs_is_longest()


def test_html_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert rows(html.main_text(df)) == []


# --- line templates


def test_lines_recurring_templates_go_and_copies_stay(spark):
    rng = random.Random(6)
    data = [(i, f"{words(rng, 30)}\nPosted on 2024-0{i}-11 by the staff\n{words(rng, 25)}\nUser u{rng.randrange(10**6)} liked this page very much") for i in range(8)]
    same = "\n".join(words(rng, 20) for _ in range(6))
    near = [same.replace(same.split()[5], f"edit{i}", 1) for i in range(5)]
    data += [(20 + i, same) for i in range(5)] + [(30 + i, t) for i, t in enumerate(near)] + [(40, None), (41, ""), (None, data[0][1]), (41, "")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = rows(lines.dedup_lines(with_clashes(df)))
    assert len(got) == len(data)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i, t in data[:8]:
        part = t.split("\n")
        assert by[i]["text"] == f"{part[0]}\n{part[2]}" and by[i]["_n_dropped"] == 2 and by[i]["_n_lines"] == 4
    assert all(by[i]["text"] == t and not by[i]["_n_dropped"] for i, t in data[8:18])
    assert by[40]["text"] is None and by[41]["text"] == ""


def test_lines_that_occur_together_go(spark):
    """A header, a notice of several lines and a footer in unrelated documents,
    one of which has more edited copies than there are others."""
    rng = random.Random(16)
    notice = [words(rng, 6) for _ in range(4)]
    body = [words(rng, 60) for _ in range(12)]
    body += [" ".join(["new", *body[0].split()[:i], "edit", *body[0].split()[i + 1 :]]) for i in range(5, 55, 3)]
    df = spark.createDataFrame([(i, "\n".join([*notice[:3], b, notice[3]])) for i, b in enumerate(body)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in rows(lines.dedup_lines(df))}
    assert all(got[i]["text"] == b and got[i]["_n_dropped"] == 4 for i, b in enumerate(body))


def test_short_lines_that_recur_go(spark):
    rng = random.Random(17)
    body = [words(rng, 40) for _ in range(6)]
    df = spark.createDataFrame([(i, f"All rights reserved.\n\n{b}\nMore\n  Page {i}\n{i + 10}\n7 8") for i, b in enumerate(body)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in rows(lines.dedup_lines(df))}
    assert all(got[i]["text"] == f"\n{b}\n{i + 10}" and got[i]["_n_dropped"] == 4 for i, b in enumerate(body))


def test_lines_words_are_split_alike_with_odd_spaces(spark):
    """Fast and general splitting give the same words; texts without a word
    and equal texts take part as stated."""
    rng = random.Random(18)
    gaps = [" ", "  ", "\t", " \x0b ", "\x0c", "\r "]
    data = [(i, f"{words(rng, 30)}\n {gap.join(['Seen', 'by', 'u7x', 'and', 'others'])}{gap}\n{words(rng, 20)}") for i, gap in enumerate(gaps)]
    data += [(20 + i, t) for i, (_, t) in enumerate(data)] + [(40, " \t\n\n "), (41, " \t\n\n "), (42, "\n")]
    got = {r["doc_id"]: r for r in rows(lines.dedup_lines(spark.createDataFrame(data, "doc_id long, text string").repartition(3)))}
    for i, t in data:
        part = t.split("\n")
        assert got[i]["text"] == (t if i >= 40 else f"{part[0]}\n{part[2]}")


def test_families_find_pairs_of_edited_copies(spark):
    """Of all pairs of texts of documents whose shingle sets are alike by 0.5
    or more, counted by brute force, at least 0.9 stand in one family."""
    import re
    from itertools import combinations

    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r[0]: r[1] for r in docs_.select(F.xxhash64("text"), "text").where("text is not null").distinct().collect()}
    sets = {}
    for h, t in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        sets[h] = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    by = {}
    for h, x in sets.items():
        for y in x:
            by.setdefault(y, []).append(h)
    near = {p for hs in by.values() if len(hs) > 1 for p in combinations(sorted(hs), 2)}
    near = [(a, b) for a, b in near if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])]
    outlines = lines.written(lines._outlines(docs_.select(F.xxhash64("doc_id").alias("key"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("t")), 3), "outlines")
    root = dict(lines._families(outlines, 0.5).collect())
    assert len(near) > 20 and sum(root.get(a, a) == root.get(b, b) for a, b in near) >= 0.9 * len(near)


def test_lines_empty(no_docs):
    assert rows(lines.dedup_lines(no_docs)) == []


def test_lines_plan_is_native(docs):
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- mixing


def mixed_corpus(spark):
    rng = random.Random(7)
    voc = {"x": ["x%d" % i for i in range(40)], "y": ["y%d" % i for i in range(40)], "z": ["z%d" % i for i in range(40)]}
    data = []
    for i in range(300):
        d = "x" if i < 200 else "y" if i < 270 else "z"
        data.append((i, " ".join(rng.choice(voc[d]) for _ in range(rng.randrange(5, 60))), d))
    data += [(900, None, "x"), (901, "", "y"), (902, "unknown words only", None), (None, "x1 x2 x3", "x"), (5, data[5][1], "x")]
    return spark.createDataFrame(data, "doc_id long, text string, dom string").repartition(3)


def brute_rates(a, t, steps=20000):
    scale = 1 / np.sqrt((a * a).sum(axis=0))
    g = (a * scale).T @ (a * scale)
    step, r = 1 / np.linalg.eigvalsh(g).max(), np.ones(len(a))
    for _ in range(steps):
        res = a.T @ r - t
        if np.abs(res).max() < 1e-7 * t.max():
            break
        r = np.maximum(0, r - step * (a @ (scale**2 * res)))
    return r


@pytest.mark.parametrize("grow", [False, True])
def test_mix_reaches_targets_and_matches_brute_force(spark, grow):
    df = mixed_corpus(spark)
    weights = {"x": 0.2, "y": 0.3, "z": 0.5}
    domains, priors, scores = mixing.fit_domains(df, "dom")
    m = mixing.posteriors(df, domains, priors, scores).toPandas()
    a = m[["p0", "p1", "p2"]].to_numpy() * m["tokens"].to_numpy()[:, None]
    assert np.allclose(m[["p0", "p1", "p2"]].sum(axis=1), 1)
    now, share = a.sum(axis=0), np.array([0.2, 0.3, 0.5])
    total = max(now / share) if grow else now.sum()
    out = mixing.mix(df, df, "dom", weights, grow=grow).toPandas()
    assert len(out) == 305 and (out["rate"] >= 0).all()
    key = lambda x: x[0]
    got = sorted(zip(out["tokens"].tolist(), out["rate"].tolist()), key=key)
    want = sorted(zip(m["tokens"].tolist(), brute_rates(a, share * total).tolist()), key=key)
    assert np.allclose(sorted(x for _, x in got), sorted(x for _, x in want), atol=1e-3)
    r = brute_rates(a, share * total)
    assert np.allclose(a.T @ r / (a.T @ r).sum(), share, atol=1e-4)
    assert out[out["tokens"] == 0]["rate"].eq(1.0).all()


def test_mix_unknown_domain_raises(spark):
    df = mixed_corpus(spark)
    with pytest.raises(ValueError, match="no labelled rows"):
        mixing.mix(df, df, "dom", {"x": 1.0, "nowhere": 1.0})


def test_mix_empty_and_unlabelled(spark, no_docs, docs):
    assert rows(mixing.mix(no_docs, no_docs, "lang", {})) == []
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["rate"] for r in rows(mixing.mix(bare, bare, "lang", {}))} == {1.0}


def test_mix_plan_is_native(spark):
    df = mixed_corpus(spark)
    plan = mixing.mix(df, df, "dom", {"x": 1.0})._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- classifiers


def labelled_corpus(spark, bad):
    rng = random.Random(8)
    data, labels = [], []
    for i in range(400):
        t = words(rng, 60)
        y = int(i % 4 == 0)
        data.append((i, bad(t, rng) if y else t))
        labels.append((i, 1 - y, y))
    data += [(900, None), (901, ""), (None, "some text"), (902, words(rng, 20_000)), (3, data[3][1])]
    labels += [(1, None, None), (None, 1, 1), (2, 7, 7), (3, 1, 0), (5000, 1, 0)]
    return spark.createDataFrame(data, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out_accuracy(out, y, n=400):
    part = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < n]
    return np.mean([r["predicted"] == y(r["doc_id"]) for r in part]), len(part)


def test_quality_held_out_accuracy(spark):
    df, labels = labelled_corpus(spark, lambda t, rng: " ".join(w + "###" for w in t.split()))
    out = rows(quality.score_quality(with_clashes(df), with_clashes(labels)))
    assert len(out) == 405 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    accuracy, n = held_out_accuracy(out, lambda i: int(i % 4 != 0))
    assert n > 80 and accuracy > 0.97
    import zlib

    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)


def test_quality_votes_match_brute_force():
    rng = np.random.default_rng(4)
    terms = rng.random((50, quality.N_TERMS)).astype(np.float32) * (rng.random((50, quality.N_TERMS)) < 0.05)
    y = (rng.random(50) < 0.5).astype(int)
    voter = quality.Voter(terms, y, np.ones(50), 8, 5)
    new = terms[:20] + 0.01
    x = voter._unit(voter._scaled(new) @ voter.basis)
    for i, s in enumerate(voter.score(new)):
        cos = voter.known @ x[i]
        near = np.argsort(-cos)[:5]
        w = np.maximum(cos[near], 1e-6) ** 8
        assert abs(s - (w * y[near]).sum() / w.sum()) < 1e-4


def test_classifiers_without_labels_or_rows(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in rows(quality.score_quality(docs, none))} == {0.5}
    assert {r["score"] for r in rows(toxicity.score_toxicity(docs, none))} == {0.5}
    assert rows(quality.score_quality(no_docs, none)) == [] and rows(toxicity.score_toxicity(no_docs, none)) == []


def misspell(w, rng):
    i = rng.randrange(1, len(w) - 1)
    return rng.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "x" + w[i + 1 :]])


def test_toxicity_misspellings_and_held_out_accuracy(spark):
    foul = ["grumbleton", "snollygost", "fopdoodle"]

    def bad(t, rng):
        w = t.split()
        for _ in range(3):
            x = rng.choice(foul)
            w.insert(rng.randrange(len(w)), misspell(x, rng) if rng.random() < 0.3 else x + rng.choice(["", "!", ","]))
        return " ".join(w)

    df, labels = labelled_corpus(spark, bad)
    out = rows(toxicity.score_toxicity(with_clashes(df), with_clashes(labels)))
    assert len(out) == 405
    accuracy, n = held_out_accuracy(out, lambda i: int(i % 4 == 0))
    assert n > 50 and accuracy > 0.97


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(9)
    entries = ["abcde", "abcab", "bcdeabcde", "cab", "eedcb"]
    auto = toxicity.LexiconAutomaton(entries, ["dda"])
    for _ in range(4000):
        if rng.random() < 0.5:
            w = list(rng.choice(entries))
            for _ in range(rng.randrange(4)):
                i = rng.randrange(len(w) + 1)
                w[i : i + rng.randrange(2)] = rng.choice(["", "a", "e"])
            w = "".join(w)
        else:
            w = "".join(rng.choice("abcde") for _ in range(rng.randrange(10)))
        near = [levenshtein(w, e) for e in entries]
        want = toxicity.DIRECT if w.startswith("dda") or 0 in near else toxicity.FUZZY if any(d <= auto.bound(e) for d, e in zip(near, entries)) else toxicity.NONE
        assert auto.read(w) == want, w


def test_every_lexicon_word_takes_misspellings(spark):
    """Also four letters, a term in few documents, and one a clean row quotes."""
    rng = random.Random(18)
    data = [(i, words(rng, 40) + (" fopdoodle" if i == 1 else " " + (["mumpsimus"] * 18 + ["zsux", "fopdoodle"])[i // 4 % 20] if i % 4 == 0 else "")) for i in range(800)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in data], "doc_id long, toxic int")
    lexicon, _, _ = toxicity.fit(df, labels)
    scan = toxicity.Scanner(lexicon)
    assert {"mumpsimus", "zsux", "fopdoodle"} <= set(lexicon.words)
    for w, near, edits in (("zsux", "zzux", 1), ("fopdoodle", "fopdodle", 1), ("fopdoodle", "fopxdodle", 2)):
        assert scan.verdict(near) == (toxicity.FUZZY, lexicon.words[w] * toxicity.PER_EDIT**edits)


def test_context_tells_quotation_from_abuse():
    scan = toxicity.Scanner(toxicity.Lexicon({"scoundrel": 5.0}, {}, frozenset(["scoundrel"])))
    abuse = scan.hits("you are a scoundrel and you know it")[0][3]
    quote = scan.hits('he wrote that "the scoundrel of the tale" was a title')[0][3]
    assert abuse > 0.9 and quote < 0.5


# --- embeddings


def brute_links(data, threshold):
    ok = []
    for i, v, label in data:
        x = None if v is None or label is None or any(c is None for c in v) else np.array(v, dtype=float)
        ok.append(None if x is None or not len(x) or not np.isfinite(x).all() or not x.any() else x / np.linalg.norm(x))
    n, root = len(data), list(range(len(data)))
    links = [0] * n
    for a in range(n):
        for b in range(a):
            if ok[a] is not None and ok[b] is not None and data[a][2] == data[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold:
                links[a] += 1
                links[b] += 1
                ra, rb = root[a], root[b]
                root = [rb if r == ra else r for r in root]
    least = {}
    for a in range(n):
        least[root[a]] = min(least.get(root[a], data[a][0]), data[a][0])
    return {data[a][0]: (links[a], least[root[a]]) for a in range(n)}


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(6)
    data, i = [], 0
    for label in (0, 1):
        for _ in range(40):
            v = rng.standard_normal(32)
            for _ in range(rng.integers(1, 5)):
                data.append((i, [float(x) for x in (v + 0.1 * rng.standard_normal(32)).astype(np.float32)], label))
                i += 1
    data += [(900 + j, data[3][1], 0) for j in range(5)] + [(910, data[3][1], 1), (911, [2 * x for x in data[3][1]], 0)]
    odd = [(920, None, 0), (921, [0.0] * 32, 0), (922, [float("nan")] * 32, 0), (923, [float("inf")] + [1.0] * 31, 0), (924, [None] + [1.0] * 31, 0), (925, data[3][1], None), (926, [], 0), (927, data[3][1][:16], 0)]
    df = spark.createDataFrame(data + odd + [(None, data[3][1], 0)], T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])).repartition(3)
    out = rows(embeddings.near_vectors(df.withColumn("id", F.lit("x")).withColumn("name", F.lit("x")).withColumn("rep", F.lit("x"))))
    want = brute_links(data + odd, 0.98)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out if r["vec_id"] is not None} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    assert [r["n_links"] for r in out if r["vec_id"] is None] == [0]


def test_embeddings_empty(spark):
    assert rows(embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))) == []


def test_embeddings_recall(spark):
    """Pairs exactly at the threshold are found, at any number of bits."""
    for rows_ in (100, 10_000, 10_000_000):
        bits, tables = embeddings.plan_tables(rows_, 0.98, 0.9999)
        p = (1 - np.arccos(0.98) / np.pi) ** bits
        assert 1 - (1 - p) ** tables >= 0.9999


# --- pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(10)
    data = [(i, words(rng, 120, 10**6) + "\nAll rights reserved by the owner\n" + words(rng, 60, 10**6), "en" if i % 3 else "fr", "s", 0) for i in range(60)]
    data += [(100 + i, data[7][1], "en", "s", 0) for i in range(4)] + [(200, "w " * 300, "en", "s", 0), (201, None, "en", None, None), (202, "", None, "s", 0)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"]
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
        seen.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    assert set(seen[0]) == {*range(60), *range(100, 104)}
    assert sorted(seen[1]) == sorted(seen[0])
    assert sorted(seen[2]) == list(range(60))
    assert set(seen[3]) == set(range(60)) and len(seen[3]) > 60
    assert sorted(seen[4]) == sorted(seen[3])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen[3])
