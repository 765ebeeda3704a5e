"""Spelling variants by composition of finite-state machines.

The vocabulary's words that lie one edit apart are the pairs accepted by A o T o A: the minimised acceptor A of the vocabulary,
the transducer T that inserts, deletes or replaces exactly one code point, and A again. The composition isn't built; its
paths are walked. Before the edit both acceptors are in one state, afterwards in two, which have to accept the same endings. Whether
two states have any ending in common is worked out once for each pair of states.

Spark partitions the composition by its initial states. Of two words one edit apart, the shorter of m code points, the edit falls
into one of `PARTS` parts of the m places, and all else is equal. So a word goes to 2 * `PARTS` groups: for m its length or one less and
for each part, the group of the words that agree outside the part. Groups are the transitions of the initial state, and a task's
acceptor takes the middles of many groups at once, which share their endings. An edit is told by the first place at which two
words differ, so each pair is found in one group alone, and counts of groups add up. Groups leave a row a word, not their pairs.
A group holds words that agree in all but a part, so it is bounded by the letters that a part can hold, not by the corpus.

Words: runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. In one of `NOISE` runs, by the crc32 of "id:run", one code point is
left out. A word's form is its near word of largest count (ties: smallest in code-point order), if that is `TIMES` its own or more. Counts grow
along forms, so forms lead to a root in log2(largest count) steps; paths are halved until nothing changes.

Cases: null and empty texts have no runs; a null id counts as the empty string; repeated rows count each; words below the least length or
count are no words, also not as near ones; other columns are not read; an empty table gives no rows. A very long text is exploded in
Spark row by row.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of
from matchloom.session import staged

RUN = "[A-Za-zÀ-ÿ]+"
#: One run in NOISE loses a code point; least code points and occurrences of a word; what a form's count is at least.
NOISE, LENGTH, COUNT, TIMES = 97, 5, 3, 2
#: Parts of a word of which one holds the edit, and the words whose middles one acceptor takes.
PARTS, CHUNK = 2, 50_000


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of all texts and how often they occur."""
    lower = F.translate(text_of(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    k = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), k), F.substring(F.col("run"), k + 2, F.char_length("run")))
    words = runs.select(F.when(h % NOISE == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= COUNT)


def groups(words: DataFrame) -> DataFrame:
    """key, cut (places of the part, all if it is the last), size, middle, word, n: the groups that a word goes to."""
    of = lambda m, j: F.floor(m * j / PARTS).cast("int")
    length = F.char_length("word")

    def member(m: Column, j: int) -> Column:
        begin, end = of(m, j), of(m, j + 1)
        head, tail = F.substring(F.col("word"), F.lit(1), begin), F.substring(F.col("word"), length - (m - end) + 1, m - end)
        middle = F.substring(F.col("word"), begin + 1, length - (m - end) - begin)
        # the lengths of head and tail follow from m and j, so the key needs no mark between them
        return F.struct(F.concat(m.cast("string"), F.lit(f"/{j}/"), head, tail).alias("key"), F.lit(j == PARTS - 1).alias("last"), (end - begin).alias("size"), middle.alias("middle"))

    of_word = F.array(*[member(m, j) for m in (length, length - 1) for j in range(PARTS)])
    rows = words.select("word", "n", F.explode(of_word).alias("at"))
    return rows.where(f"length(word) > {LENGTH} or at.key not like '{LENGTH - 1}/%'").select("at.key", "at.last", "at.size", "at.middle", "word", "n")


class Acceptor:
    """The minimal acyclic machine of strings that come in ascending order. State 0 ends every string that nothing follows."""

    def __init__(self, strings: list[tuple]):
        self.to: list[dict] = [{}]
        self.final: list[bool] = [True]
        self._known: dict[tuple, int] = {(True, ()): 0}
        self._meets: dict[tuple[int, int], bool] = {}
        path: list[tuple[dict, list[bool]]] = [({}, [False])]
        before: tuple = ()
        for one in strings:
            same = 0
            while same < min(len(one), len(before)) and one[same] == before[same]:
                same += 1
            self._settle(path, before, same)
            for _ in one[same:]:
                path.append(({}, [False]))
            path[-1][1][0] = True
            before = one
        self._settle(path, before, 0)
        self.start = self._state(*path[0])

    def _state(self, to: dict, final: list[bool]) -> int:
        key = (final[0], tuple(to.items()))
        if key not in self._known:
            self._known[key] = len(self.to)
            self.to.append(to)
            self.final.append(final[0])
        return self._known[key]

    def _settle(self, path: list, word: tuple, depth: int) -> None:
        """Nothing will be added any more below this depth of the path: those states are looked up or kept."""
        while len(path) > depth + 1:
            to, final = path.pop()
            path[-1][0][word[len(path) - 1]] = self._state(to, final)

    def meets(self, s: int, t: int) -> bool:
        """Whether two states accept an ending in common."""
        start, seen, todo = (s, t), set(), [(s, t)]
        while todo:
            pair = todo.pop()
            s, t = pair
            known = s == t or (self.final[s] and self.final[t]) or self._meets.get(pair)
            if known:
                self._meets[start] = True
                return True
            if known is None and pair not in seen:
                seen.add(pair)
                a, b = self.to[s], self.to[t]
                todo += [(a[c], b[c]) for c in a if c in b]
        self._meets.update(dict.fromkeys(seen, False))
        return False

    def endings(self, s: int, t: int, but: str = "") -> Iterator[str]:
        """The endings that both states accept; `but`: a letter that they don't begin with."""
        todo = [(s, t, "")]
        while todo:
            s, t, head = todo.pop()
            if self.final[s] and self.final[t]:
                yield head
            a, b = self.to[s], self.to[t]
            todo += [(a[c], b[c], head + c) for c in a if c in b and (head or c != but) and self.meets(a[c], b[c])]


def pairs(machine: Acceptor, state: int, places: int) -> Iterator[tuple[str, str]]:
    """Strings that the state accepts and that are one edit apart, the longer one first, edited at one of the next `places` places."""
    todo = [(state, "")]
    while todo:
        state, head = todo.pop()
        to = machine.to[state]
        letters = list(to) if len(head) < places else []
        for i, a in enumerate(letters):
            for b in letters[i + 1 :]:
                if machine.meets(to[a], to[b]):
                    for end in machine.endings(to[a], to[b]):
                        yield head + a + end, head + b + end
            # the letter is one more than the other string has; were the next letter the same, the first difference would be later
            if machine.meets(to[a], state):
                for end in machine.endings(to[a], state, but=a):
                    yield head + a + end, head + end
            todo.append((to[a], head + a))


class Near:
    """What is known of the words of one chunk of groups."""

    def __init__(self) -> None:
        self.found: dict[str, list] = {}

    def add(self, word: str, n: int, other: str) -> None:
        have = self.found.setdefault(word, [0, n, other])
        have[0] += 1
        if (-n, other) < (-have[1], have[2]):
            have[1:] = n, other


def near_in(rows: list[tuple]) -> dict[str, list]:
    """word -> [near words, the count and the word of the best] of whole groups, which are rows of (key, last, size, middle, word, n)."""
    rows.sort(key=lambda r: (r[0], r[3]))
    machine = Acceptor([(r[0], *r[3]) for r in rows])
    words = {(r[0], r[3]): (r[4], r[5]) for r in rows}
    out = Near()
    for key, last, size in dict.fromkeys((r[0], r[1], r[2]) for r in rows):
        # the last part also takes an edit beyond its end
        for a, b in pairs(machine, machine.to[machine.start][key], size + last):
            if len(b) == size:  # two words of m + 1 letters meet in the groups of m + 1
                (x, n_x), (y, n_y) = words[key, a], words[key, b]
                out.add(x, n_y, y)
                out.add(y, n_x, x)
    return out.found


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form_n, form: near words of each word that has any, and the best of them."""
    small_batches(words.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(rows: list[tuple]) -> pa.RecordBatch:
            found = near_in(rows)
            columns = zip(*[(w, *x) for w, x in found.items()], strict=True) if found else ((), (), (), ())
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "form_n", "form"])

        whole: list[tuple] = []
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    if len(group) > 1:
                        whole += group
                    group = []
                    if len(whole) >= CHUNK:
                        yield answer(whole)
                        whole = []
                group.append(row)
        if len(group) > 1:
            whole += group
        if whole:
            yield answer(whole)

    rows = groups(words).repartition("key").sortWithinPartitions("key")
    parts = rows.mapInArrow(each, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of each word that has a form; forms: word, form."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("later"))
        joined = staged(now.join(after, "root", "left").select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("moved")), "roots")
        if joined.where("moved").isEmpty():
            return joined.select("word", "root")
        now = joined.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    words = staged(vocabulary(docs, id_col, text_col), "words")
    near = words.join(near_words(words), "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    is_form = F.col("form_n") >= TIMES * F.col("n")
    near = near.select("word", "n", "n_near", F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    near = staged(near, "near")
    return near.join(roots(near.where("form is not null")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
