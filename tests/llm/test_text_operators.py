"""Operators on texts against brute force, with hostile rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import corpus, with_clashes
from traitlab.llm import jaccard, rules, substrings
from traitlab.llm.text import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_word_hashes_equal_words_only():
    text = "aa a aa\taaa b\n x a"
    got = word_hashes(text.encode())[0].tolist()
    want = WORD.findall(text)
    assert len(got) == len(want)
    assert [[x == y for y in got] for x in got] == [[x == y for y in want] for x in want]


# --- n-gram Jaccard join


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute_groups(data, k, num, den):
    ids = [(i, shingles(t, k)) for i, t in data]
    root = {i: i for i, _ in ids if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(ids):
        for j, b in ids[:n]:
            if i is not None and j is not None and a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in ids), key=str)


@pytest.mark.parametrize(("k", "num", "den", "n2", "k2"), [(3, 90, 100, 3, 1), (5, 80, 100, 2, 1), (2, 60, 100, 4, 2), (1, 50, 100, 3, 1)])
def test_jaccard_groups_match_brute_force(docs, k, num, den, n2, k2):
    got = jaccard.jaccard_groups(with_clashes(docs), shingle=k, num=num, den=den, n2=n2, k2=k2)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(got)), key=str) == brute_groups(corpus(), k, num, den)


@pytest.mark.parametrize("held", [1 << 22, 40])
def test_jaccard_repeat_filter_loses_no_repeated_signature(docs, held):
    signing = jaccard.Signing(3, 90, 100, 3, 1, frozenset())
    texts = docs.where("doc_id is not null").select(docs["text"].alias("t")).repartition(5)
    found = {r[0] for r in jaccard._repeated(texts, signing, 6, held).collect()}
    nodes = defaultdict(set)
    for node, sigs in next(signing.rows([{"t": [t for i, t in corpus() if i is not None]}])):
        for x in sigs.tolist():
            nodes[x].add(node)
    assert {x >> 26 for x, at in nodes.items() if len(at) > 1} <= found


def test_jaccard_sets_that_share_a_name_are_two_nodes():
    a = np.array([1, 2, 3], dtype=np.uint64)
    clash = frozenset([jaccard.set_name(a)])
    assert jaccard.node_of(a, frozenset()) == jaccard.set_name(a)
    assert jaccard.node_of(a, clash) == jaccard.check_name(a) != jaccard.set_name(a)


def test_jaccard_chain_beyond_leaders(spark):
    """A chain of texts, each like the next only: one component."""
    base = ["w%d" % i for i in range(60)]
    data = []
    for i in range(40):
        w = list(base)
        w[: i] = ["n%d" % j for j in range(i)]
        data.append((1000 - i, " ".join(w)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = rows(jaccard.jaccard_groups(df, shingle=1, num=90, den=100, leader_rounds=1))
    assert {r["component_id"] for r in got} == {961}


def test_jaccard_all_pairs_share_a_signature():
    rng = np.random.default_rng(5)
    bands = jaccard.Bands()
    for _ in range(300):
        size = int(rng.integers(2, 300))
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        b = a.copy()
        b[: size // 20] = rng.integers(0, 2**63, size // 20).astype(np.uint64)
        b = b[: size - int(rng.integers(0, size // 20 + 1))]
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if both * 100 >= 90 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            assert set(jaccard.signatures(a, 90, 100, 3, 1, bands).tolist()) & set(jaccard.signatures(b, 90, 100, 3, 1, bands).tolist())


def test_jaccard_light_signatures_go_and_no_pair_does():
    rng = np.random.default_rng(11)
    bands = jaccard.Bands()
    sign = lambda s, rule: set(jaccard.signatures(s, *rule, bands).tolist())
    for rule in [(80, 100, 3, 1), (90, 100, 3, 1), (60, 100, 4, 2), (80, 100, 2, 1)]:
        for _ in range(150):
            both = rng.integers(0, 2**63, int(rng.integers(1, 250))).astype(np.uint64)
            most = len(both) * (rule[1] - rule[0]) // rule[0]  # in which the sets may differ beside ``both``
            left = int(rng.integers(0, most + 1))
            more = rng.integers(0, 2**63, most).astype(np.uint64)
            a, b = np.unique(np.concatenate([both, more[:left]])), np.unique(np.concatenate([both, more[left:]]))
            if most:
                assert sign(a, rule) & sign(b, rule)
    # sets with nothing in common do not meet in signatures of no element
    bands.of(1000)
    size = next(x for x in bands.hi if x > 100) + 1  # the smallest of a band
    far = [np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for _ in range(200)]
    assert max(Counter(x for s in far for x in sign(s, (80, 100, 3, 1))).values()) == 1


def test_jaccard_sets_are_read_of_candidates_alone(spark, monkeypatch):
    """Texts that share half of their words meet in signatures; only pairs that
    their sketches allow need their sets."""
    common = ["c%d" % i for i in range(40)]
    data = [(i, " ".join(common + ["u%d-%d" % (i, j) for j in range(40)])) for i in range(30)]
    data += [(100, " ".join("p%d" % i for i in range(80))), (101, " ".join("p%d" % i for i in range(3, 80)))]
    tables, written = [], jaccard.written

    def noted(df, name):
        tables.append((name, out := written(df, name)))
        return out

    monkeypatch.setattr(jaccard, "written", noted)
    got = rows(jaccard.jaccard_groups(spark.createDataFrame(data, "doc_id long, text string"), shingle=1, num=80, den=100))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute_groups(data, 1, 80, 100)
    assert next(t for name, t in tables if name == "nodes").count() > 20
    assert {t.count() for name, t in tables if name == "arrays"} <= {0, 2}


def test_jaccard_large_sets_of_two_size_classes(spark):
    base = ["w%d" % i for i in range(2000)]
    data = [(1, " ".join(base)), (2, " ".join(base + ["x%d" % i for i in range(90)])), (3, " ".join(base[300:] + ["y%d" % i for i in range(300)])), (4, " ".join(base[:-150]))]
    got = jaccard.jaccard_groups(spark.createDataFrame(data, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(got)) == brute_groups(data, 3, 90, 100)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(200):
        size = int(rng.integers(1, 6000))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * rng.random())], rng.integers(0, 2**63, size // 10).astype(np.uint64)]))
        if not len(b):
            continue
        differ = len(np.setxor1d(a, b))
        longs = 1 << int(rng.integers(0, 8))
        x, y, twice = jaccard.parity_sketch(a, longs), jaccard.parity_sketch(b, longs), jaccard.parity_sketch(a, 2 * longs)
        assert sum(bin(int(v) & (2**64 - 1)).count("1") for v in x ^ y) <= differ
        assert (twice[:longs] ^ twice[longs:] == x).all()


def test_jaccard_empty(no_docs):
    assert rows(jaccard.jaccard_groups(no_docs)) == []


def test_one_of_each_keeps_smallest(docs):
    kept = jaccard.one_of_each(docs, jaccard.jaccard_groups(docs))
    want = {i for i, _, c in brute_groups(corpus(), 3, 90, 100) if i == c}
    assert {r["doc_id"] for r in rows(kept)} == want


def test_one_of_each_and_mixing_move_no_texts(spark, docs):
    import corpus_pipeline

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.one_of_each(docs, jaccard.jaccard_groups(docs))
        mixed = corpus_pipeline.mix_languages(spark, docs.selectExpr("doc_id", "text", "if(doc_id % 5 = 0, 'fr', 'en') lang"), "")
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (kept, mixed)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("BroadcastHashJoin" in x and "SortMergeJoin" not in x for x in plans)


# --- quality rules


def brute_figures(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    dup = len(lines) - len(set(lines))
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": dup, "n_repeat_words": len(hit)}
    out["base_failed"] = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return out


def test_rules_figures(docs):
    got = sorted(rows(rules.judge(with_clashes(docs), sample_rows=10)), key=str)
    want = sorted(({"doc_id": i, **brute_figures(t)} for i, t in corpus()), key=str)
    assert [{k: r[k] for k in w} for r, w in zip(got, want)] == want
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_rules_order_does_not_change_the_verdict(docs):
    a = sorted((r["doc_id"] or -1, r["kept"]) for r in rows(rules.judge(docs)))
    b = sorted((r["doc_id"] or -1, r["kept"]) for r in rows(rules.judge(docs, rules=tuple(reversed(rules.RULES)))))
    assert a == b


def test_rules_cascade_order():
    assert rules.cascade_order([("a", 2.0, 0.5), ("b", 1.0, 0.5), ("c", 1.0, 0.0), ("d", 0.001, 0.4)]) == ["d", "b", "a", "c"]


def test_rules_filter_keeps_columns_and_rows(docs):
    kept = rules.keep_good(with_clashes(docs))
    assert kept.columns == with_clashes(docs).columns
    want = sorted(str(r["doc_id"]) for r in rows(rules.judge(docs)) if r["kept"])
    assert sorted(str(r["doc_id"]) for r in rows(kept)) == want


def test_rules_empty(no_docs):
    assert rows(rules.judge(no_docs)) == [] and rows(rules.keep_good(no_docs)) == []


# --- substring dedup


def brute_cut(data, size):
    first = {}
    for i, t in data:
        w = WORD.findall(t or "")
        if i is not None:
            for p in range(len(w) - size + 1):
                x = tuple(w[p : p + size])
                first[x] = min(first.get(x, (i, p)), (i, p))
    out = []
    for i, t in data:
        w = WORD.findall(t or "")
        gone = set()
        if i is not None:
            for p in range(len(w) - size + 1):
                if first[tuple(w[p : p + size])] != (i, p):
                    gone |= set(range(p, p + size))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "gram", "slots"), [(20, 8, 4.0), (20, 8, 0.001), (5, 2, 4.0), (8, 8, 4.0)])
def test_substrings_match_brute_force(docs, size, gram, slots):
    got = substrings.dedup_substrings(with_clashes(docs), size=size, gram=gram, slots_per_place=slots)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows(got)), key=str) == brute_cut(corpus(), size)


def test_substrings_prefilter_is_selective(docs):
    picked = docs.selectExpr("doc_id as id", "text as t")
    bits = substrings.sketch_bits(picked, 20, 8, 4.0, 64)
    maps = substrings.repeated_slots(picked, 20, 8, bits)
    assert 0 < sum(bin(b).count("1") for b in maps[0]) < 2**bits / 8


def test_substrings_empty(no_docs):
    assert rows(substrings.dedup_substrings(no_docs)) == []


def test_minimisers_of_equal_windows_agree():
    rng = np.random.default_rng(2)
    w = rng.integers(0, 2**63, 200).astype(np.uint64)
    doubled = np.concatenate([w, w])
    least, places = substrings.minimisers(doubled, 20, 8)
    assert (least[:181] == least[200:]).all()
    count = defaultdict(int)
    for x in places.tolist():
        count[x] += 1
    assert all(count[x] >= 2 for x in least[:181].tolist())
