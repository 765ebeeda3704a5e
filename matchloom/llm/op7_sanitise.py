"""Personal data: patterns for plain identifiers, and information-theoretic sanitisation of terms that reveal them.

Base spans are e-mail addresses, IP addresses, payment cards and phone numbers, found by the rules fixed below. The
values found are the protected entities. For every entity e that stands in `SUPPORT` distinct texts or more, the terms t
of these texts (words of `LETTERS` letters or more) are counted, and over the whole corpus how many documents hold each
term. Copies of a text count once, among the texts of an entity as in the corpus: all counts are of distinct texts. A term discloses e when its pointwise mutual information with e reaches the share `DISCLOSE` of e's
own information, PMI(t; e) >= DISCLOSE * -log2 p(e), that is p(e|t) >= p(e)^(1 - DISCLOSE), and when the two depend on each
other with a G statistic of `SIGNAL` or more, so that rare words that met an entity by chance stay. In texts that hold e
those terms are spans of the kind "term". Most identifiers stand in one text or two, where such counts say nothing of the words of
a whole text. For every entity, however rare, the terms within `AROUND` code points beside it are therefore judged on a smoothed
estimate: a corpus of one more text, in which e is as likely as anywhere, gives p(e|t) = (n_both + p(e)) / (n_term + 1), and t discloses e
from p(e)^(1 - DISCLOSE) on. That leaves a word that the corpus knows from elsewhere, and takes a name that only stands beside e. Sanitised texts have each span replaced by its kind, e.g. [EMAIL]: identifiers
are removed, terms generalised.

Only DataFrame functions are used. Texts are scanned where they lie; spans, counts and terms are what is shuffled, and
counts are summed before their shuffle, so a common entity or term is no hot key.

Cases: null and empty texts have no spans and stay as they are; repeated texts count once in the corpus and are each
sanitised; a null id stays null; other columns pass through `sanitised` untouched; an empty table gives no rows; spans
that overlap are one gap in the sanitised text, named after the one that begins first.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import text_of
from matchloom.session import staged

SUPPORT, DISCLOSE, SIGNAL, LETTERS, AROUND = 5, 0.9, 40.0, 3, 40
#: Long lists are walked in blocks of so many, since a step that appends to a list copies it.
BLOCK = 256

#: The kinds in order, their patterns, and what a match has to satisfy. Beside the given patterns these have
#: possessive quantifiers, where giving back never helps, and look-behinds that leave out starts which can't match.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text has to hold for the pattern to be tried at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
WORD = r"\p{L}+"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}\z")
    if kind == "card":
        return F.length(digits(value)).between(13, 19) & F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


SPANS = "array<struct<start:int,end:int,value:string,near:string>>"


def given(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often and in whatever loop it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks_of(rows: Column) -> Column:
    """A list that isn't empty in blocks of `BLOCK`."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int")), lambda b: F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What holds before each of the values, and after the last: 0, merge(0, first), and so on."""
    return F.aggregate(values, F.array(F.lit(0)), lambda out, x: F.concat(out, F.array(merge(F.element_at(out, -1), x))))


def beside(before: Column, after: Column) -> Column:
    """Whole words of `AROUND` code points on both sides."""
    left = F.when(F.length(before) > AROUND, F.regexp_replace(F.substring(before, -AROUND, AROUND), r"^\p{L}+", "")).otherwise(before)
    right = F.when(F.length(after) > AROUND, F.regexp_replace(F.substring(after, 1, AROUND), r"\p{L}+$", "")).otherwise(after)
    return F.concat_ws("\n", left, right)


def spans_of(text: Column, pattern: str, good, near: bool = False) -> Column:
    """start, end, value of the leftmost matches that do not overlap and are good, in code points; `near`: and the words beside them."""

    def matched(between: Column) -> Column:
        pairs = F.zip_with(between, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
        return F.zip_with(pairs, F.slice(between, F.lit(2), F.size(between)), lambda p, after: F.struct(p["gap"].alias("gap"), p["value"].alias("value"), after.alias("after")))

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + F.length(pair["gap"])
        last = first + F.coalesce(F.length(pair["value"]), F.lit(0))
        words = beside(pair["gap"], pair["after"]) if near else F.lit("")
        found = F.array(F.struct(first.alias("start"), last.alias("end"), pair["value"].alias("value"), words.alias("near")))
        take = pair["value"].isNotNull() & good(pair["value"])
        return F.struct(last.alias("at"), F.when(take, F.concat(state["spans"], found)).otherwise(state["spans"]).alias("spans"))

    def length(pair: Column) -> Column:
        return F.length(pair["gap"]) + F.coalesce(F.length(pair["value"]), F.lit(0))

    def walk(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda rows: F.aggregate(rows, F.lit(0), lambda n, pair: n + length(pair)))
        placed = F.arrays_zip(blocks.alias("rows"), F.slice(running(sizes, lambda n, x: n + x), F.lit(1), F.size(sizes)).alias("at"))
        start = lambda at: F.struct(at.alias("at"), F.array().cast(SPANS).alias("spans"))
        return F.flatten(F.transform(placed, lambda block: F.aggregate(block["rows"], start(block["at"]), step)["spans"]))

    return given(F.split(text, pattern, -1), lambda between: given(matched(between), lambda rows: given(blocks_of(rows), walk)))


def base_spans(text: Column, kind: str) -> Column:
    hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
    return F.when(hint, spans_of(text, PATTERNS[kind], lambda v: valid(kind, v), near=True)).otherwise(F.array().cast(SPANS))


def term_spans(text: Column, terms: Column) -> Column:
    return spans_of(text, WORD, lambda v: F.array_contains(terms, F.lower(v)))


def outside(terms: Column, base: list[Column]) -> Column:
    """Spans of terms that no base span overlaps."""
    return given(F.concat(*base), lambda taken: F.filter(terms, lambda t: ~F.exists(taken, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))


def entity(kind: str, value: Column) -> Column:
    """One name for the ways to write an entity."""
    return F.concat(F.lit(kind + ":"), F.lower(value) if kind in ("email", "ip") else digits(value))


def of_spans(spans: Column, kind: str, make: Callable[[str, Column], Column]) -> Column:
    """What `make` gives for each span of a kind."""
    return F.transform(spans, lambda s: make(kind, s))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark (a hash of the text), and a list of spans for each kind. No shuffle."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), *[base_spans(text, k).alias(k) for k in KINDS])


def words_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"\p{{L}}{{{LETTERS},}}"), F.lit(0)))


def disclosing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame | None:
    """mark, terms: the terms to generalise in the texts of a mark; None if there are none. found: the written table of `scanned`."""
    text = text_of(text_col)
    named = F.concat(*[of_spans(F.col(k), k, lambda kind, s: F.struct(entity(kind, s["value"]).alias("entity"), s["near"].alias("near"))) for k in KINDS])
    named = found.select("mark", F.explode(named).alias("s")).select("mark", "s.entity", "s.near").distinct()
    held = named.select("mark", "entity").distinct()
    counts = staged(held.groupBy("entity").agg(F.count("*").alias("n_entity")), "entities")
    if counts.isEmpty():
        return None
    n_texts = found.agg(F.countDistinct("mark")).first()[0]
    close = staged(named.select("mark", "entity", F.explode(words_of(F.col("near"))).alias("term")).distinct(), "close")
    pairs = _close_pairs(close, counts, n_texts)
    often = counts.where(F.col("n_entity") >= SUPPORT)
    common = staged(held.join(often, "entity"), "common")  # texts that hold an entity of `SUPPORT` texts
    marked = docs.select(F.xxhash64(text).alias("mark"), text.alias("text"))
    far = None
    if not common.isEmpty():
        far = marked.join(common.select("mark").distinct(), "mark", "left_semi").select("mark", F.explode(words_of(F.col("text"))).alias("term"))
        # copies of a text say the same; sizes on disk say little of these rows in memory, so they aren't sent to all
        far = staged(far.distinct(), "near").hint("merge")
        # a term stands in as many texts at least as it does among these, which leaves out the common ones before the corpus is read
        about = far.groupBy("term").agg(F.count("*").alias("n_near"))
        both = common.join(far, "mark").groupBy("entity", "term", "n_entity").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= SUPPORT)
        both = both.join(about, "term").where(reveals(F.col("n_entity"), F.col("n_near"), F.col("n_both"), n_texts))
        pairs = pairs.union(both.select("entity", "term", "n_entity", "n_both", F.lit(False).alias("close")))
    pairs = staged(pairs, "pairs")
    if pairs.isEmpty():
        return None
    # terms are counted over all rows, which needs no texts moved; what copies add to that is taken off again
    copied = staged(found.groupBy("mark").agg((F.count("*") - 1).alias("surplus")).where("surplus > 0"), "copied")
    copies = marked.join(copied, "mark").groupBy("mark").agg(F.first("text").alias("text"), F.first("surplus").alias("surplus"))
    words = docs.select(F.explode(words_of(text)).alias("term"), F.lit(1).cast("long").alias("n"))
    words = words.union(copies.select(F.explode(words_of(F.col("text"))).alias("term"), -F.col("surplus")))
    terms = words.groupBy("term").agg(F.sum("n").alias("n_term"))
    n = F.col("n_entity"), F.col("n_term"), F.col("n_both")
    told = pairs.join(terms, "term").where(F.when(F.col("close"), suggests(*n, n_texts)).otherwise(discloses(*n, n_texts)))
    terms = staged(told.select("entity", "term", "close"), "terms")
    if terms.isEmpty():
        return None
    # of the terms that disclose an entity, a text that holds it has to know those that it holds too
    own = close.join(terms.where("close"), ["entity", "term"]).select("mark", "term")
    if far is not None:
        own = own.union(common.join(terms.where("not close"), "entity").select("mark", "term").join(far, ["mark", "term"], "left_semi"))
    return staged(own.groupBy("mark").agg(F.collect_set("term").alias("terms")), "terms")


def _close_pairs(close: DataFrame, counts: DataFrame, n_texts: int) -> DataFrame:
    """The pairs of an entity and a term beside it that may be told. The texts that have the term beside any entity are some of all that hold it."""
    about = staged(close.groupBy("term").agg(F.countDistinct("mark").alias("n_near")), "about")  # written: a common word's pairs can be split
    pairs = close.groupBy("entity", "term").agg(F.count("*").alias("n_both")).join(counts, "entity").join(about, "term")
    pairs = pairs.where(suggests(F.col("n_entity"), F.col("n_near"), F.col("n_both"), n_texts))
    return pairs.select("entity", "term", "n_entity", "n_both", F.lit(True).alias("close"))


def suggests(n_entity: Column, n_term: Column, n_both: Column, n_texts: int) -> Column:
    """Whether a term beside an entity gives the share `DISCLOSE` of its information by the smoothed estimate."""
    p = n_entity / F.lit(float(n_texts))
    return (n_both + p) / (n_term + 1) >= F.pow(p, F.lit(1 - DISCLOSE))


def reveals(n_entity: Column, n_term: Column, n_both: Column, n_texts: int) -> Column:
    """Whether a term gives the share `DISCLOSE` of an entity's information. The fewer texts hold the term, the more it gives."""
    n = F.lit(float(n_texts))
    pmi = F.log2(n_both * n / (n_entity * n_term))
    return (pmi > 0) & (pmi >= DISCLOSE * -F.log2(n_entity / n))


def discloses(n_entity: Column, n_term: Column, n_both: Column, n_texts: int) -> Column:
    """Whether a term reveals an entity, and not by chance."""
    n = F.lit(float(n_texts))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    g = (
        part(n_both, n_entity * n_term / n)
        + part(n_entity - n_both, n_entity * (n - n_term) / n)
        + part(n_term - n_both, n_term * (n - n_entity) / n)
        + part(n - n_entity - n_term + n_both, (n - n_entity) * (n - n_term) / n)
    )
    return reveals(n_entity, n_term, n_both, n_texts) & (g >= SIGNAL)


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark and the spans of every kind, "term" among them, of every document."""
    found = staged(scanned(docs, id_col, text_col), "scanned")
    terms = disclosing_terms(docs, found, text_col)
    if terms is None:
        return found.withColumn("term", F.array().cast(SPANS))
    text = text_of(text_col)
    told = docs.select(F.xxhash64(text).alias("mark"), text.alias("text")).join(terms, "mark")
    told = told.groupBy("mark").agg(F.first("text").alias("text"), F.first("terms").alias("terms"))
    told = staged(told.select("mark", term_spans(F.col("text"), F.col("terms")).alias("term")), "told")
    return found.join(told.hint("merge"), "mark", "left").select(*found.columns, outside(F.coalesce("term", F.array().cast(SPANS)), [F.col(k) for k in KINDS]).alias("term"))


def digest(rows: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""

    def lines(kinds: tuple[str, ...]) -> Column:
        said = [of_spans(F.col(k), k, lambda kind, s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))) for k in kinds]
        return F.array_join(F.concat(*said), ",")

    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(lines(KINDS), 256).alias("base_sha256"), lines((*KINDS, "term")).alias("spans"), F.size("term").cast("long").alias("n_term"))


def masked(text: Column, spans: dict[str, Column]) -> Column:
    """The text with every span replaced by its kind; unchanged without spans."""
    place = lambda kind, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("kind"))
    every = F.concat(*[of_spans(v, k, place) for k, v in spans.items()])

    def piece(block: Column) -> Column:
        """A block's part of the text, from where the spans of earlier blocks end to where its own do."""
        low = block["at"]
        start = F.struct(low.alias("at"), F.lit("").alias("out"))

        def walk_part(part: Column) -> Column:
            def step(state: Column, span: Column) -> Column:
                gap = F.substring(part, state["at"] - low + 1, span["start"] - state["at"])
                after = F.greatest(state["at"], span["end"])
                return F.struct(after.alias("at"), F.when(span["start"] >= state["at"], F.concat(state["out"], gap, span["kind"])).otherwise(state["out"]).alias("out"))

            return F.aggregate(block["rows"], start, step)["out"]

        return given(F.substring(text, low + 1, block["end"] - low), walk_part)

    def walk(blocks: Column) -> Column:
        last = F.transform(blocks, lambda rows: F.array_max(F.transform(rows, lambda s: s["end"])))
        ends = running(last, lambda a, b: F.greatest(a, b))
        placed = F.arrays_zip(blocks.alias("rows"), F.slice(ends, F.lit(1), F.size(last)).alias("at"), F.slice(ends, F.lit(2), F.size(last)).alias("end"))
        rest = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(placed, piece), ""), rest)

    return given(F.array_sort(every), lambda rows: F.when(F.size(rows) > 0, given(blocks_of(rows), walk)).otherwise(text))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of `docs` with their texts sanitised, all other columns as they were; `length_col`: the length of a changed text."""
    found = staged(scanned(docs, id_col, text_col), "scanned")
    terms = disclosing_terms(docs, found, text_col)
    text = text_of(text_col)
    spans = {k: base_spans(text, k) for k in KINDS}
    rows = docs
    if terms is not None:
        terms = terms.select(F.col("mark").alias("_mark"), F.col("terms").alias("_terms"))
        rows = docs.join(terms, F.xxhash64(text) == terms["_mark"], "left")
        told = outside(term_spans(text, terms["_terms"]), list(spans.values()))
        spans["term"] = F.when(terms["_terms"].isNotNull(), told).otherwise(F.array().cast(SPANS))
    rows = rows.select(F.when(docs[text_col].isNotNull(), masked(text, spans)).alias("clean"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    kinds = dict(docs.dtypes)
    old = F.col(f"row.{text_col}")

    def column(name: str) -> Column:
        if name == text_col:
            return F.col("clean").alias(name)
        if name == length_col:
            changed = old.isNotNull() & (old != F.col("clean"))
            return F.when(changed, F.length("clean").cast(kinds[name])).otherwise(F.col(f"row.{name}")).alias(name)
        return F.col(f"row.{name}").alias(name)

    return rows.select(*[column(c) for c in docs.columns])
