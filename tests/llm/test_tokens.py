"""Packing and token counts against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from matchloom.llm import op6_packing as packing
from matchloom.llm import op8_token_counts as counts
from tests.llm import helpers

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a <|endoftext|> b", " 　  x\n\n y ", "ﬁ 漢字 🙂🙂", "1234567 don't we'll", "\x00\x1c\x85", "á‍ e"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_pieces_hold_every_id_once_and_windows_are_gapless(spark, library):
    rng = random.Random(2)
    docs = helpers.awkward(spark, [*ODD, helpers.prose(rng, 511)])
    got = packing.packed(docs, RANKS, PATTERN, JSON).collect()
    want = []
    for r in docs.collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r["doc_id"], i, len(ids[i : i + 1024]), zlib.crc32(ids[i : i + 1024].tobytes()), len(ids)) for i in range(0, len(ids), 1024)]
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)])]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024
    assert packing.packed(helpers.empty(spark), RANKS, PATTERN, JSON).count() == 0


def best_fit(sizes, capacity):
    """How full best-fit decreasing, piece by piece, makes its windows. Which of equally tight windows it takes doesn't matter to that."""
    left = []
    for size in sorted(sizes, reverse=True):
        fits = [i for i, x in enumerate(left) if x >= size]
        if fits:
            i = min(fits, key=lambda i: left[i])
        else:
            i = len(left)
            left.append(capacity)
        left[i] -= size
    return sorted(capacity - x for x in left)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_plan_is_best_fit_decreasing(sizes):
    steps, windows = packing.plan({s: sizes.count(s) for s in sizes}, 32)
    held = {}
    for s in steps:
        for k in range(s.count):
            held.setdefault(s.window + k // s.each, []).append((s.offset + k % s.each * s.size, s.size))
    fillings = []
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]]
        fillings.append(sum(n for _, n in parts))
    assert sorted(fillings) == best_fit(sizes, 32) and sorted(held) == list(range(windows))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'ab1.é漢🙂 ́"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_are_those_of_the_library(library, text):
    assert encode(text) == library.encode(text, add_special_tokens=False).ids


encode = packing.encoder(RANKS, PATTERN, JSON)


@pytest.mark.parametrize("text", [" " * 1_200_000 + "x <|endoftext|>", "a" + "\n" * 1_200_000, "1" * 300_000 + "!" * 300_000])
def test_very_long_runs_have_ids(library, text):
    assert encode(text) == library.encode(text, add_special_tokens=False).ids


def test_counts_are_those_of_the_library(spark):
    model = SentencePieceProcessor(model_file=MODEL)
    docs = helpers.awkward(spark, [*ODD, "a ▁ b", "<s> </s>"])
    got = counts.token_counts(docs, MODEL, 4096).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(model.encode(r["text"] or ""))) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got) and any(r["over_limit"] for r in got)
    assert counts.token_counts(helpers.empty(spark), MODEL, 4096).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n▁é", max_size=80), st.integers(1, 20))
def test_cuts_change_no_count(text, long):
    model = SentencePieceProcessor(model_file=MODEL)
    assert sum(len(model.encode(p)) for p in counts.parts(text, long)) == len(model.encode(text))


def test_batches_and_the_other_library(library):
    assert list(counts.batches([5, 5, 20, 1, 1], 10)) == [[0, 1], [2], [3, 4]]
    encode_json, safe = counts.load(JSON)
    assert encode_json(ODD) == [len(library.encode(t, add_special_tokens=False).ids) for t in ODD] and not safe
