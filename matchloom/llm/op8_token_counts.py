"""Token counts by batch encoding in Arrow functions that return lengths only.

The tokenizer file is a parameter. Texts of an Arrow batch are dealt into encoding batches of about equal bytes, and a
text above `LONG` bytes is cut where a cut changes nothing: at a single space between two other characters. No piece of
the vocabulary holds a space mark after another character (checked when the file is loaded), so no token spans such a
space; the space itself becomes the mark that the library puts before each part anyway. A text without such a place
stays whole.

Cases: null and empty texts have 0 bytes and 0 tokens; repeated rows each get their row; an empty table gives no rows;
other columns are not looked at, so their names cannot clash; a null id stays null.
"""

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of

#: Bytes of text that one call of the library encodes, and the length above which a text is cut.
BATCH, LONG = 1 << 20, 1 << 16
MARK = "▁"


def parts(text: str, long: int = LONG) -> list[str]:
    """The text cut at safe spaces into parts of about `long` characters; the spaces cut at are left out."""
    out, start = [], 0
    while len(text) - start > long:
        at = text.find(" ", start + long)
        while at > 0 and (at + 1 >= len(text) or text[at - 1] in (" ", MARK) or text[at + 1] in (" ", MARK)):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[start:at])
        start = at + 1
    return [*out, text[start:]]


def batches(sizes: Iterable[int], most: int = BATCH) -> Iterator[list[int]]:
    """Positions of the items in runs whose sizes sum to `most` at most, or of one larger item."""
    run, total = [], 0
    for i, size in enumerate(sizes):
        if run and total + size > most:
            yield run
            run, total = [], 0
        run.append(i)
        total += size
    if run:
        yield run


def load(path: str):
    """A function from a list of texts to their token counts."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        safe = not any(MARK in p.lstrip(MARK) for p in pieces)
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), safe
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = Tokenizer.from_file(path)
    return (lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]), False


def lengths(texts: list[str], sizes: list[int], encode, safe: bool, long: int = LONG) -> list[int]:
    """Token counts of the texts."""
    owner, cut = [], []
    for i, text in enumerate(texts):
        for part in parts(text, long) if safe and sizes[i] > long else (text,):
            owner.append(i)
            cut.append(part)
    counts = [0] * len(texts)
    for run in batches(map(len, cut)):
        for k, n in zip(run, encode([cut[k] for k in run]), strict=True):
            counts[owner[k]] += n
    return counts


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more tokens than `limit`) of every text. No shuffle."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def count(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, safe = load(path)
        for batch in batches_in:
            texts = batch.column(1).to_pylist()
            sizes = [len(t.encode()) for t in texts]
            n = lengths(texts, sizes, encode, safe)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(count, f"doc_id {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
