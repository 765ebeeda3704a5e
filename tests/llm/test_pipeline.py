"""The stages of the pipeline, each against the rule it applies to its own input."""

import re

import corpus_pipeline
import public_tokenizers
from matchloom.llm import queries
from matchloom.llm.op4_decontamination import WIDTH
from tests.llm import helpers
from tests.llm.test_texts import base, contamination
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = queries.table(spark, SF, "documents")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.schema == docs.schema
    toxic = {r["doc_id"] for r in queries.table(spark, SF, "labels").where("toxic = 0").collect()}
    kept = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert kept.items() <= before.items() and toxic <= kept.keys()

    single = stages["near_duplicates"](spark, clean, SF)
    roots = helpers.components(kept)
    assert single.schema == docs.schema and {r["doc_id"] for r in single.collect()} == {k for k, v in roots.items() if k == v}

    fair = stages["decontamination"](spark, single, SF)
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = {w[0] for w in contamination([(k, kept[k]) for k, v in roots.items() if k == v], items, WIDTH) if not w[-1]}
    assert fair.schema == docs.schema and {r["doc_id"] for r in fair.collect()} == want

    private = stages["personal_data"](spark, fair, SF)
    assert private.schema == docs.schema
    texts = {r["doc_id"]: r["text"] for r in private.collect()}
    assert texts.keys() == want
    for k, text in texts.items():
        found = base(kept[k])
        assert (text == kept[k]) if not found else len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", text)) >= 1 and not base(text)

    packed = stages["packing"](spark, private, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in texts.values())
    assert sum(r["length"] for r in packed) == total
    assert corpus_pipeline.run(spark, SF).count() == len(packed)
