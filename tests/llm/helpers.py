"""Small tables with all the awkward rows, and brute-force versions of the rules."""

import random
import re

LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, hash long, class string"


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Épée", "zeta", "eta", "theta", "iota", "kappa"]) + str(rng.randrange(400)) for _ in range(n))


def rows(texts, start=0):
    """Rows of documents with extra columns whose names clash with the operators' own."""
    return [(start + i, t, "en", "s", None if t is None else len(t), 7, 8, "mine") for i, t in enumerate(texts)]


def awkward(spark, extra=()):
    """Null and empty texts, a null id, a row that is there twice, copies, a very long text."""
    rng = random.Random(3)
    base = prose(rng, 60)
    texts = [base, base, None, "", "   \n", "one", "One", "three short words", prose(rng, 40000), base.replace("alpha", "ALPHA"), prose(rng, 90), "ﬁ naïve 漢字 🙂  x", *extra]
    data = rows(texts)
    data += [data[0], (None, prose(rng, 20), None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(texts):
    """doc_id -> smallest linked id, by comparing all pairs."""
    sets = {k: shingle_set(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}
