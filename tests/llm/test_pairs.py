"""MinHash, edit embedding and the corpus pipeline's deduplication."""

import hashlib
import random

import numpy as np
import pytest

from matchloom.llm import op2_edit_embedding as embedding
from matchloom.llm import op4_decontamination as decontamination
from matchloom.llm import op10_minhash as minhash
from tests.llm import helpers


def near_copies(rng, n, size, edits):
    base = helpers.prose(rng, size).split()
    out = []
    for _ in range(n):
        copy = base.copy()
        for _ in range(edits):
            copy[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return [" ".join(base), *out]


def test_components_are_those_of_all_pairs(spark):
    rng = random.Random(5)
    texts = [helpers.prose(rng, rng.randrange(3, 200)) for _ in range(60)]
    texts += near_copies(rng, 40, 300, 2) + near_copies(rng, 30, 300, 4) + [t.upper() for t in texts[:10]] + texts[:10] + [None, "", "a b", "A b"]
    rng.shuffle(texts)
    df = spark.createDataFrame(helpers.rows(texts), helpers.DOCS)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df).collect()}
    want = helpers.components(dict(enumerate(texts)))
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert all(r["kept"] == (k == want[k]) and r["n_shingles"] == len(helpers.shingle_set(texts[k])) for k, r in got.items())


def test_buckets_beyond_a_block(spark, monkeypatch):
    rng = random.Random(6)
    texts = near_copies(rng, 90, 120, 2)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    df = spark.createDataFrame(helpers.rows(texts), helpers.DOCS)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()}
    assert got == helpers.components(dict(enumerate(texts)))


def linked_pairs(texts, percent):
    sets = [helpers.shingle_set(t) for t in texts]
    both = {(i, j): len(sets[i] & sets[j]) for j in range(len(sets)) for i in range(j)}
    return {(i, j) for (i, j), n in both.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)}


@pytest.mark.parametrize("percent", [50, 70])
def test_lower_thresholds_find_all_pairs(spark, percent):
    rng = random.Random(percent)
    texts = [t for _ in range(60) for t in near_copies(rng, 1, 200, 11 if percent == 50 else 6)]
    pairs = linked_pairs(texts, percent)
    assert len(pairs) > 20 and all(j == i + 1 and i % 2 == 0 for i, j in pairs)
    df = spark.createDataFrame(helpers.rows(texts), helpers.DOCS)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, percent=percent).collect()}
    assert {(c, k) for k, c in got.items() if c != k} == pairs


def test_bands_reach_the_stated_chance():
    assert minhash.banding() == (20, 5)
    for percent in (100, 95, 85, 80, 70, 50, 30):
        bands, rows = minhash.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISS and bands * rows <= minhash.HASHES
    for percent in (0, 3):
        with pytest.raises(ValueError):
            minhash.banding(percent)


def test_one_row_of_each_group_stays_with_its_columns(spark):
    docs = helpers.awkward(spark)
    kept = minhash.deduplicated(docs).collect()
    assert minhash.deduplicated(docs).schema == docs.schema
    ids = [r["doc_id"] for r in kept]
    assert ids.count(0) == 1 and 1 not in ids and 9 not in ids and 6 not in ids and 5 in ids
    assert {2, 3, 4, 8, 10} <= set(ids) and ids.count(None) == 2


def test_empty_tables(spark):
    assert minhash.near_duplicates(helpers.empty(spark)).count() == 0
    assert minhash.deduplicated(helpers.empty(spark)).count() == 0
    assert embedding.fingerprints(helpers.empty(spark)).count() == 0


def test_gates_keep_what_may_be_similar():
    for n, least in minhash.gates():
        assert least <= 0.85 * n
    a = np.zeros((2, minhash.HASHES), np.uint32)
    b = a.copy()
    b[1, ::2] = 1
    sizes = np.array([10, 10])
    assert minhash.passing(a, b, (sizes, sizes), minhash.gates(), 85).tolist() == [True, False]
    assert minhash.passing(a, b, (sizes, np.array([100, 10])), minhash.gates(), 85).tolist() == [False, False]


def test_fingerprints_against_walks_of_whole_texts(spark):
    docs = helpers.awkward(spark)
    got = embedding.fingerprints(docs).collect()
    data = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert len(got) == len(data)
    walk = embedding.Walk()
    want = []
    for (ident, text), (_, following) in zip(data, data[1:] + data[:1], strict=True):
        half = len(text) // 2
        other = text[: len(text) - half] + following[:half]
        a, b, c = (walk.of(x) for x in (text, other, following))
        want.append((ident, len(text), hashlib.sha256(other.encode()).hexdigest(), a, b, round(embedding.likeness(a, b), 9), round(embedding.likeness(a, c), 9)))
    have = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_likeness_follows_edits():
    rng, walk = random.Random(1), embedding.Walk()
    means = []
    for edits in (1, 8, 40):
        found = []
        for _ in range(25):
            text = helpers.prose(rng, 200)
            copy = text.split()
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = "changed"
            found.append(embedding.likeness(walk.of(text), walk.of(" ".join(copy))))
        means.append(np.mean(found))
    other = np.mean([embedding.likeness(walk.of(helpers.prose(rng, 200)), walk.of(helpers.prose(rng, 200))) for _ in range(25)])
    assert means[0] > means[1] > means[2] > other and means[0] > 0.8
    assert embedding.likeness("", "") == 1.0 and embedding.likeness("", walk.of("abc")) == 0.0
    text = helpers.prose(rng, 50)
    assert not embedding.bands(walk.of(text)).isdisjoint(embedding.bands(walk.of(text + " more")))


@pytest.mark.parametrize("text", ["", "a", "ab" * 5000])
def test_walk_by_hand(text):
    walk = embedding.Walk()
    classes = walk.classes(text)
    begin = walk.begin(classes)
    assert len(begin) == len(text) + 1 and (np.diff(begin) >= 1).all()
    whole = walk.begin(classes[: len(text) // 2])
    assert (begin[: len(whole)] == whole).all()


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


def test_words_of_like_structure_are_not_linked(spark):
    """Sums over powers of a base, modulo 2^64, can't tell these words apart."""
    a, b = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    long = [f"{w} with some more words" for w in (a, b)]
    docs = spark.createDataFrame(helpers.rows([a, b, *long]), helpers.DOCS)
    assert all(r["component_id"] == r["doc_id"] for r in minhash.near_duplicates(docs).collect())
    assert minhash.deduplicated(docs).count() == 4
    benchmark = spark.createDataFrame([(1, b)], "item_id long, text string")
    assert [r["doc_id"] for r in decontamination.report(docs, benchmark).where("contaminated").collect()] == [1, 3]


def test_columns_named_like_the_operators_own(spark):
    names = ["_id", "_mark", "_component", "row", "id", "mark", "doc_mark", "component", "n"]
    texts = ["one two three four five six", "one two three four five six", "another text"]
    rows = [(i, t, *range(len(names))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0], rows[2]], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    kept = minhash.deduplicated(docs)
    assert kept.schema == docs.schema and sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
