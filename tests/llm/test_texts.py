"""Decontamination, personal data, shuffling and toxicity against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchloom.llm import op4_decontamination as decontamination
from matchloom.llm import op5_shuffle as shuffle
from matchloom.llm import op7_sanitise as sanitise
from matchloom.llm import op9_toxicity as toxicity
from tests.llm import helpers

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contamination(texts, items, width=13):
    windows = {}
    for item, text in items:
        w = helpers.words(text, WORD)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    out = []
    for ident, text in texts:
        w = helpers.words(text, WORD)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((ident, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_contamination(spark, monkeypatch):
    rng = random.Random(4)
    passage = helpers.prose(rng, 40)
    docs = helpers.awkward(spark, [f"x {passage[30:]} y", passage, helpers.prose(rng, 400) + " " + passage, "short item here, Épée", "short item"])
    items = [(1, passage), (12, passage), (2, "Short item here"), (3, None), (4, ""), (5, "!!"), (None, "one"), (7, "one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [x for x in items if x[0] is not None])
    for block in (decontamination.BLOCK, 1):
        monkeypatch.setattr(decontamination, "BLOCK", block)
        got = decontamination.report(docs, benchmark).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=repr) == sorted(want, key=repr)
    longest = {r["doc_id"]: (r["longest_match"], r["match_start"]) for r in got}
    assert longest[13] == (len(helpers.words(passage, WORD)), 0) and longest[2] == (0, None)
    kept = decontamination.clean(docs, benchmark)
    assert kept.schema == docs.schema and kept.count() == sum(not w[-1] for w in want)
    assert decontamination.clean(helpers.empty(spark), benchmark).count() == 0
    assert decontamination.clean(docs, benchmark.limit(0)).count() == docs.count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab c", max_size=40), min_size=1, max_size=5), st.lists(st.text("ab c", max_size=20), min_size=1, max_size=4))
def test_suffix_arrays_find_every_window(texts, items):
    width = 3
    data = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    found = decontamination.shard_report(np.frombuffer(b"".join(data), np.uint8), at, [decontamination.Tests([(str(i), t) for i, t in enumerate(items)], width)], decontamination.Powers(64))
    want = contamination(list(enumerate(texts)), list(enumerate(items)), width)
    assert list(zip(found["n_words"], found["n_hit"], found["n_items"], found["items_sha256"], strict=True)) == [w[1:5] for w in want]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else 2 * int(d) - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m[0])]


ODD = [
    "🙂 a@b.com_foo@x.y.z mail é@q.de a@b a.b+c@d-e.fr.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0000255.1.01.9 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 41111111111111111111",
    "+1 (555) 123-4567 +49 30 1234 +123456789012345678 ++4 30.30.30.30.", "x" * 5000 + "@" + "y." * 500, "9" * 4000, "+1" * 900, "1 " * 2000, "+1" + " " * 3000 + "2",
]


def test_base_spans(spark):
    rng = random.Random(8)
    noise = ["".join(rng.choice("ab1+@.- ()9🙂") for _ in range(200)) for _ in range(150)]
    docs = helpers.awkward(spark, [*ODD, *noise])
    got = sanitise.digest(sanitise.with_spans(docs)).collect()
    want = [(r["doc_id"], hashlib.sha256(",".join(base(r["text"])).encode()).hexdigest()) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["base_sha256"]) for r in got), key=repr) == sorted(want, key=repr)
    assert sanitise.digest(sanitise.with_spans(helpers.empty(spark))).count() == 0


def test_texts_lose_what_reveals_and_nothing_else(spark):
    rng = random.Random(9)
    texts = [helpers.prose(rng, 30) for _ in range(300)]
    for i in range(8):  # an entity that eight texts hold, always with one name that no other text has
        texts[i] = f"Zorblax wrote to zed@site.org. {texts[i]}"
    texts[20] = "call +1 (555) 123-4567, common@once.org!"
    docs = spark.createDataFrame(helpers.rows(texts), helpers.DOCS).union(helpers.awkward(spark).where("doc_id is null or text is null or text = ''"))
    out = sanitise.sanitised(docs, length_col="n_chars")
    assert out.schema == docs.schema
    got = {r["doc_id"]: r for r in out.where("doc_id is not null and text <> ''").collect()}
    for i in range(8):
        assert got[i]["text"] == texts[i].replace("Zorblax", "[TERM]").replace("zed@site.org", "[EMAIL]").replace("wrote", "[TERM]")
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[20]["text"] == "call [PHONE], [EMAIL]!"
    assert all(got[i]["text"] == t for i, t in enumerate(texts) if i not in {*range(8), 20})
    assert out.where("text is null").count() == docs.where("text is null").count()
    assert sanitise.sanitised(helpers.empty(spark)).count() == 0


def test_copies_of_a_text_hide_no_term(spark):
    rng = random.Random(12)
    texts = [helpers.prose(rng, 30) for _ in range(400)]
    for i in range(6):
        texts[i] = f"Zorblax of zed@site.org. {texts[i]}"
    once = {r["doc_id"]: r["text"] for r in sanitise.sanitised(spark.createDataFrame(helpers.rows(texts), helpers.DOCS)).collect()}
    assert all("Zorblax" not in once[i] and "[TERM]" in once[i] for i in range(6))
    copies = [(i, t) for i, t in enumerate(texts) for _ in range(100 if i < 6 else 3 if i < 50 else 1)]
    docs = spark.createDataFrame([(i, t, *[None] * 6) for i, t in copies], helpers.DOCS)
    many = sanitise.sanitised(docs).collect()
    assert len(many) == len(copies) and all(r["text"] == once[r["doc_id"]] for r in many)


def terms_by_hand(texts):
    """Per distinct text the terms that disclose one of its identifiers, from the definitions."""
    texts = sorted(set(texts))
    words = [{w for w in re.findall(r"[^\W\d_]+", t.lower()) if len(w) >= sanitise.LETTERS} for t in texts]
    held, beside = [], []
    for t in texts:
        mine, by = set(), set()
        for kind, pattern in PATTERNS.items():
            matches = list(re.finditer(pattern, t))
            edges = [0, *(m.end() for m in matches)], [*(m.start() for m in matches), len(t)]
            for k, m in enumerate(matches):
                if not good(kind, m[0]):
                    continue
                name = kind + ":" + (m[0].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", m[0]))
                mine.add(name)
                before, after = t[edges[0][k] : m.start()], t[m.end() : edges[1][k + 1]]
                before = re.sub(r"^[^\W\d_]+", "", before[-sanitise.AROUND :]) if len(before) > sanitise.AROUND else before
                after = re.sub(r"[^\W\d_]+$", "", after[: sanitise.AROUND]) if len(after) > sanitise.AROUND else after
                by |= {(name, w) for w in re.findall(r"[^\W\d_]+", f"{before}\n{after}".lower()) if len(w) >= sanitise.LETTERS}
        held.append(mine)
        beside.append(by)
    n = len(texts)
    n_entity, n_term = ({x: sum(x in s for s in sets) for x in set().union(*sets)} for sets in (held, words))
    told = {}
    for i, t in enumerate(texts):
        out = set()
        for e in held[i]:
            p = n_entity[e] / n
            for w in words[i]:
                near = sum((e, w) in b for b in beside)
                if (e, w) in beside[i] and (near + p) / (n_term[w] + 1) >= p ** (1 - sanitise.DISCLOSE):
                    out.add(w)
                both = sum(e in h and w in x for h, x in zip(held, words, strict=True))
                if both >= sanitise.SUPPORT:
                    cells = ((both, n_entity[e], n_term[w]), (n_entity[e] - both, n_entity[e], n - n_term[w]), (n_term[w] - both, n - n_entity[e], n_term[w]))
                    cells += ((n - n_entity[e] - n_term[w] + both, n - n_entity[e], n - n_term[w]),)
                    g = sum(2 * x * np.log(x * n / (a * b)) for x, a, b in cells if x)
                    pmi = np.log2(both * n / (n_entity[e] * n_term[w]))
                    if pmi > 0 and pmi >= sanitise.DISCLOSE * -np.log2(p) and g >= sanitise.SIGNAL:
                        out.add(w)
        told[t] = out
    return told


def test_terms_against_all_counts(spark):
    rng = random.Random(15)
    texts = [helpers.prose(rng, 12) for _ in range(1300)]
    for i in range(7):
        texts[i] = f"{helpers.prose(rng, 9)} quorl met Zorblax of zed@site.org. {texts[i]}"
    for i in range(10, 40):  # names beside identifiers that stand in one text, some known from elsewhere
        name = "".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(4))
        texts[i] = f"{helpers.prose(rng, rng.randrange(9))} write {name} at {name[:3]}{i}@mail.org or +1 (555) 123-45{i}, {texts[i]}"
        if i % 3 == 0:
            texts[i + 100] += f" {name}"
    texts += texts[:30]
    docs = spark.createDataFrame(helpers.rows(texts), helpers.DOCS)
    want = terms_by_hand(texts)
    rows = {r["doc_id"]: r for r in sanitise.with_spans(docs).collect()}
    taken = {t: {w for w in x if any(m.lower() == w for m in re.findall(r"[^\W\d_]+", re.sub(r"\S+@\S+", " ", t)))} for t, x in want.items()}
    assert {i: {s["value"].lower() for s in r["term"]} for i, r in rows.items()} == {i: taken[t] for i, t in enumerate(texts)}
    assert sum(map(bool, taken.values())) > 20


def test_long_contact_lists_are_linear(spark):
    rng = random.Random(16)
    text = " ".join(f"{rng.choice('abcdef')}{i}@mail.org" for i in range(20_000))
    docs = spark.createDataFrame(helpers.rows([text, "x " * 300 + text[:9000]]), helpers.DOCS)
    got = {r["doc_id"]: r["text"] for r in sanitise.sanitised(docs).collect()}
    assert got[0] == " ".join(["[EMAIL]"] * 20_000)
    row = sanitise.digest(sanitise.with_spans(docs)).where("doc_id = 0").first()
    assert row["base_sha256"] == hashlib.sha256(",".join(base(text)).encode()).hexdigest()


def test_terms_need_more_than_chance(spark):
    cases = [(5, 5, 5, True), (5, 500, 5, False), (100_000, 6, 6, False), (100_000, 120, 120, True), (50, 40, 40, True)]
    rows = spark.createDataFrame(cases, "e long, t long, b long, want boolean")
    said = rows.select("want", sanitise.discloses(F.col("e"), F.col("t"), F.col("b"), 200_000).alias("got")).collect()
    assert [r["got"] for r in said] == [r["want"] for r in said]


def test_shards_hold_every_record_in_a_seeded_order(spark, tmp_path):
    docs = helpers.awkward(spark, [f"text {i}" for i in range(500)])
    got = shuffle.placement(docs, bucket_bytes=2000).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    slots = {k: sorted(r["slot"] for r in got if r["shard"] == k) for k in range(8)}
    assert all(s == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    ranks = [(r["slot"] * 8 + r["shard"], r["doc_id"]) for r in got if r["doc_id"] is not None]
    assert abs(np.corrcoef(np.array(ranks).T)[0, 1]) < 0.2
    assert len({r["bucket"] for r in got}) > 20
    again = shuffle.placement(docs, bucket_bytes=2000).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert shuffle.placement(helpers.empty(spark)).count() == 0
    shuffle.write(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).select("record.*")
    assert sorted(map(repr, back.collect())) == sorted(map(repr, docs.collect()))


def ordinal(rng, n):
    texts, grades = [], []
    for _ in range(n):
        grade = rng.choice([0, 0, 0, 1, 2, 3])
        texts.append(" ".join([helpers.prose(rng, 30), *(["nasty"] if grade > 0 else []), *(["vile"] if grade > 1 else []), *(["hateful"] if grade > 2 else [])]))
        grades.append(grade)
    return texts, grades


def test_grades_are_learnt_in_order():
    rng = random.Random(10)
    model = toxicity.fit(*ordinal(rng, 400), joint=True)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 3
    texts, grades = ordinal(rng, 300)
    above = model.grades(np.array([model.score(t) for t in texts]))
    assert (np.diff(above, axis=1) <= 0).all()
    assert np.abs(above.sum(axis=1) - grades).mean() < 0.2
    assert toxicity.fit(["a"], [0]).thresholds.size == 0 and toxicity.fit([], []).weights == {}


def loss(row, column, grade, n, state):
    """Mean negative log likelihood, written from the definition P(grade <= k) = sigmoid(threshold_k - w.x)."""
    w, raw = state[:n], state[n:]
    cuts = [raw[0]]
    for gap in raw[1:]:
        cuts.append(cuts[-1] + np.exp(gap))
    total = 0.0
    for i, g in enumerate(grade):
        score = sum(w[c] for r, c in zip(row, column, strict=True) if r == i)
        at_most = [0.0, *[1 / (1 + np.exp(score - c)) for c in cuts], 1.0]
        total -= np.log(at_most[g + 1] - at_most[g])
    return total / len(grade)


def test_the_fit_climbs_along_the_numeric_gradient():
    rng = np.random.default_rng(13)
    n, m, top = 4, 30, 3
    pairs = [(i, j) for i in range(m) for j in range(n) if rng.random() < 0.4]
    row, column = np.array(pairs).T
    grade = np.arange(m) % (top + 1)
    start = rng.normal(size=n + top) * 0.3
    slope = np.array([(loss(row, column, grade, n, start + d) - loss(row, column, grade, n, start - d)) / 2e-6 for d in np.eye(n + top) * 1e-6])
    w, cuts = toxicity.ascend(row, column, grade, n, start, 0.0, 1, 0)
    first = np.concatenate([w - start[:n], [cuts[0] - start[n]], np.log(np.diff(cuts)) - start[n + 1 :]])
    assert (np.sign(first) == -np.sign(slope)).all()  # the first step of Adam has the gradient's signs alone
    w, cuts = toxicity.ascend(row, column, grade, n, start, 0.0, 4000, 0)
    best = np.concatenate([w, cuts[:1], np.log(np.diff(cuts))])
    flat = [(loss(row, column, grade, n, best + d) - loss(row, column, grade, n, best - d)) / 2e-5 for d in np.eye(n + top) * 1e-5]
    assert np.abs(flat).max() < 1e-3 and loss(row, column, grade, n, best) < loss(row, column, grade, n, start)


def test_production_fit_tells_three_grades_apart(spark):
    rng = random.Random(14)
    texts, grades = ordinal(rng, 900)
    grades = [min(g, 2) for g in grades]
    docs = spark.createDataFrame(helpers.rows(texts), helpers.DOCS)
    labels = spark.createDataFrame([(i, g) for i, g in enumerate(grades) if i < 600], "doc_id long, grade int")
    model = toxicity.fit(*toxicity.sample(docs, labels))
    rows = toxicity.severity(docs, model).where("doc_id >= 600").collect()
    assert np.mean([abs(r["severity"] - grades[r["doc_id"]]) for r in rows]) < 0.05
    assert np.mean([r["grade"] == grades[r["doc_id"]] for r in rows]) > 0.97
    for r in rows:  # a second scorer
        have = set(re.findall(r"\w+", texts[r["doc_id"]].lower()))
        have |= {f"{x[:k]}-" for x in have for k in (4, 5) if len(x) > k}
        score = sum(model.weights.get(f, 0.0) for f in have)
        assert abs(r["severity"] - sum(1 / (1 + np.exp(t - score)) for t in model.thresholds)) < 1e-9


def test_the_sample_keeps_to_its_bytes(spark):
    docs = spark.createDataFrame(helpers.rows(["x" * 100] * 50), helpers.DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, grade int")
    texts, grades = toxicity.sample(docs, labels, most=2050)
    assert len(texts) == len(grades) == 20 and texts[0] == "x" * 100
    assert toxicity.sample(docs, labels, most=99) == ([], [])


def test_toxic_documents_go_and_clean_ones_stay(spark):
    rng = random.Random(11)
    data = [(i, " ".join([helpers.prose(rng, 30), "scum"]) if i % 5 == 0 else helpers.prose(rng, 30)) for i in range(400)]
    docs = spark.createDataFrame(helpers.rows([t for _, t in data]), helpers.DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(301, None), (None, 1)], "doc_id long, grade int")
    model = toxicity.fit(*toxicity.sample(docs, labels))
    mixed = docs.union(helpers.awkward(spark).where("doc_id is null or doc_id < 8"))
    out = toxicity.without_toxic(mixed, model)
    assert out.schema == mixed.schema
    assert sorted(r["doc_id"] for r in out.where("lang = 'en' and doc_id >= 300").collect()) == [i for i in range(300, 400) if i % 5]
    graded = toxicity.severity(mixed, model)
    assert graded.count() == mixed.count() and graded.where("rejected").count() == 80
    assert toxicity.without_toxic(helpers.empty(spark), model).count() == 0
    nothing = toxicity.fit(*toxicity.sample(docs, labels.limit(0)))
    assert toxicity.without_toxic(docs, nothing).count() == 400
