"""DivideSkip join, spelling variants and ranked search against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchloom.llm import op11_divide_skip as join
from matchloom.llm import op12_spelling as spelling
from matchloom.llm import op13_ranked_search as search
from matchloom.llm.words import Letters, shingle_set, spaced_words
from tests.llm import helpers
from tests.llm.test_pairs import near_copies


def classes_and_links(rows, percent=85):
    """(id, text) rows -> (id, shingles, component, links) by comparing all pairs."""
    sets = [helpers.shingle_set(t, 4) for _, t in rows]
    linked = [[] for _ in rows]
    for j in range(len(rows)):
        for i in range(j):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                linked[i].append(j)
                linked[j].append(i)
    out = []
    for start in range(len(rows)):
        seen, todo = {start}, [start]
        while todo:
            todo += (new := set(linked[todo.pop()]) - seen)
            seen |= new
        ids = [rows[i][0] for i in seen if rows[i][0] is not None]
        out.append((rows[start][0], len(sets[start]), min(ids, default=None), len(linked[start])))
    return sorted(out, key=repr)


def joined(df, **more):
    return sorted((tuple(r) for r in join.joined(df, **more).collect()), key=repr)


def test_join_on_awkward_rows(spark):
    docs = helpers.awkward(spark, ["a b c", "A b C", "a b", "a", "a b c d", "a b c d e"])
    assert joined(docs) == classes_and_links([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert join.joined(helpers.empty(spark)).count() == 0


@pytest.mark.parametrize("block", [join.BLOCK, 2000])
def test_join_is_that_of_all_pairs(spark, monkeypatch, block):
    rng = random.Random(block)
    common = helpers.prose(rng, 60)
    texts = [helpers.prose(rng, rng.randrange(3, 200)) for _ in range(40)] + [f"{helpers.prose(rng, 20)} {common}" for _ in range(30)]
    texts += near_copies(rng, 60, 250, 1) + near_copies(rng, 40, 120, 3) + texts[:10] + [t.upper() for t in texts[:10]]
    rng.shuffle(texts)
    monkeypatch.setattr(join, "BLOCK", block)
    monkeypatch.setattr(join, "HOT", 500)
    df = spark.createDataFrame(helpers.rows(texts), helpers.DOCS)
    want = classes_and_links(list(enumerate(texts)))
    assert max(w[3] for w in want) > 30
    assert joined(df) == want


def test_join_at_another_threshold(spark):
    rng = random.Random(2)
    texts = [t for _ in range(15) for t in near_copies(rng, 3, 150, 6)]
    df = spark.createDataFrame(helpers.rows(texts), helpers.DOCS)
    want = classes_and_links(list(enumerate(texts)), 60)
    assert max(w[3] for w in want) > 1
    assert joined(df, percent=60) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=12), max_size=9), st.integers(1, 6))
def test_heap_merge_counts_lists(lists, least):
    lists = [sorted(set(x)) for x in lists if x]
    count = Counter(i for x in lists for i in x)
    found, times = join.merge_skip(lists, least)
    assert dict(zip(found, times, strict=True)) == {i: n for i, n in count.items() if n >= least}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(1, 25), min_size=1, max_size=25), min_size=1, max_size=10), st.sampled_from([50, 70, 85, 100]))
def test_index_finds_all_linked_sets(sets, percent):
    sets = sorted((np.array(sorted(s), np.uint64) for s in sets), key=len)
    index = join.Index(sets, percent)
    for one in sets:
        want = [j for j, s in enumerate(sets) if 100 * len(np.intersect1d(one, s)) >= percent * len(np.union1d(one, s))]
        assert index.linked(one).tolist() == want
        for after in (0, len(sets) // 2):
            assert index.linked(one, after).tolist() == [j for j in want if j > after]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(1, 40), min_size=1, max_size=20), min_size=2, max_size=8))
def test_linked_sets_share_prefixes(sets):
    sets = [np.array(sorted(s), np.uint64) for s in sets]
    order = join.Order(np.array([20, 3, 5, 8], np.uint64), np.array([1, 4, 1, 2], np.int8))
    for a in sets:
        for b in sets:
            if 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
                least = min(join.SHORT, -(-85 * len(a) // 100))
                assert len(np.intersect1d(order.prefix(a, 85), order.prefix(b, 85))) >= least


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


def test_words_of_one_structure_differ(spark):
    a, b = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    letters = Letters()
    x, y = (spaced_words(np.frombuffer(t.encode(), np.uint8), letters) for t in (a, b))
    assert x != y
    assert {r["component_id"] for r in join.joined(spark.createDataFrame(helpers.rows([a, b]), helpers.DOCS)).collect()} == {0, 1}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abÉ漢\x00", min_size=1, max_size=90), max_size=12), st.sampled_from([3, 1 << 20]))
def test_word_hashes_tell_words_apart(texts, at_once):
    words = [w.encode() for w in texts]
    hashes = spaced_words(np.frombuffer(b" \n".join(words), np.uint8), Letters(at_once)).tolist()
    assert len(hashes) == len(words)
    assert len(set(hashes)) == len(set(words)) and all((hashes[i] == hashes[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(i))
    n = max(0, len(words) - 3) if len(words) > 3 else min(1, len(words))
    assert len(shingle_set(np.array(hashes, np.uint64), 4)) == len({tuple(words[i : i + 4]) for i in range(n)})


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len, reverse=True)
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def variants(rows):
    count = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(helpers.LOWER)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    out, form = {}, {}
    for w in n:
        others = [o for o in n if o != w and near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = len(others)
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, n[w], out[w], form[w], n[form[w]] if form[w] else None, root))
    return sorted(rows)


def spelled(df):
    return sorted(tuple(r) for r in spelling.variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("chunk", [spelling.CHUNK, 40])
def test_variants_by_all_pairs(spark, monkeypatch, chunk):
    rng = random.Random(chunk)
    some = ["".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))) for _ in range(150)]
    texts = [" ".join(rng.choice(some[: rng.randrange(2, 150)]) for _ in range(300)) for _ in range(12)]
    texts += ["colour color colours COLOUR Colour " * 9, "color, color; color", "plank " * 20 + "planks " * 8 + "plankse " * 3, "Étés!" * 4, "ab" * 30000 + " " + "ab" * 30000 + "c " + ("ab" * 30000 + " ") * 5]
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    docs = helpers.awkward(spark, texts)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = variants(rows)
    assert spelled(docs) == want
    assert sum(w[3] is not None for w in want) > 10 and any(w[3] != w[5] for w in want if w[3])
    assert spelling.variants(helpers.empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abé", max_size=5), max_size=25))
def test_acceptor_pairs(words):
    words = sorted(words)
    machine = spelling.Acceptor([tuple(w) for w in words])
    found = list(spelling.pairs(machine, machine.start, 6))
    assert len(found) == len({frozenset(p) for p in found})
    assert {frozenset(p) for p in found} == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    machine = spelling.Acceptor([tuple(w) for w in ("bake", "cake", "fake", "faked", "lake", "make")])
    # one state before "ake" for b, c, l, m; f has its own three letters, as "faked" goes on
    assert len(machine.to) == 1 + 3 + 1 + 3 + 1


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ranking(rows, items, top=10):
    docs = [(i, Counter(helpers.words(t, TERM))) for i, t in rows]
    big_n, big_l = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    w = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in set(items):
        query, found = helpers.words(text, TERM), []
        for ident, c in docs:
            m = 25 + (75 * sum(c.values()) * big_n) // big_l if c else 0
            score = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in query if c[t])
            if score > 0:
                found.append((-score, ident is None, ident or 0, ident))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found, key=lambda f: f[:3])[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block", "bucket", "first"), [(search.BLOCK, search.BUCKET, search.FIRST), (300, 4, 0.2)])
def test_ranking_by_scoring_all(spark, monkeypatch, block, bucket, first):
    rng = random.Random(9)
    passages = [helpers.prose(rng, 30) for _ in range(12)]
    texts = [f"{helpers.prose(rng, rng.randrange(5, 80))} {rng.choice(passages)[: rng.randrange(200)]}, alpha1!" for _ in range(150)]
    docs = helpers.awkward(spark, texts + texts[:20] + ["alpha1 " * 500])
    items = [*enumerate(passages), (20, None), (21, ""), (22, "nowhere-to-be-found"), (23, "ALPHA1 alpha1, Épée Épée"), (23, "one"), (0, passages[0]), (24, passages[3] * 3)]
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "BUCKET", bucket)
    monkeypatch.setattr(search, "FIRST", first)
    benchmark = spark.createDataFrame([(i, t, 5, 6.0) for i, t in items], "item_id long, text string, block int, score double")
    got = search.ranked(docs, benchmark).collect()
    want = ranking([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert search.ranked(helpers.empty(spark), benchmark).count() == 0
    none = search.ranked(docs, benchmark.limit(0))
    assert none.count() == 0 and none.dtypes == search.ranked(docs, benchmark).dtypes


def test_bounds_leave_documents_out():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    lists = [np.sort(rng.choice(50, rng.integers(1, 30), replace=False)) for _ in range(400)]
    times = [rng.integers(1, 5, len(x)) for x in lists]
    weight = rng.integers(1, 9000, 50)
    batch = pa.record_batch([pa.array(range(400)), pa.array([int(t.sum()) for t in times]), pa.array([x.tolist() for x in lists], pa.list_(pa.int32())), pa.array([t.tolist() for t in times], pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tf"])
    bucket = search.Bucket(batch, weight, 400, 10_000)
    left = 0
    for k in range(60):
        ids = rng.choice(50, 5, replace=False)
        scores = np.array([sum(int(bucket.impact[bucket.postings(t)][bucket.row[bucket.postings(t)] == d].sum()) for t in ids) for d in range(400)])
        item = search.Item(ids, np.ones(5, np.int64), weight, int(np.sort(scores)[-3]), 3)
        live = item.candidates(bucket)
        assert live[scores >= item.least].all()
        left += int((~live).sum())
    assert left > 60 * 40
