from __future__ import annotations

import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from gradewise.llm import bpe, pii, quality_rules
from gradewise.llm.tables import stored
from tests.llm import plain
from tests.llm.test_decontaminate import expected as contaminated
from tests.llm.test_pii import base
from tests.llm.test_setsketch import expected as groups


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages(spark, sf):
    """Each stage against a plain version of it on its own input; the last one's rows are those of run()."""
    docs = plain.read(spark, sf, "documents")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "near_dedup", "decontaminate", "pii", "bpe"]

    good = stored(steps["quality_rules"](spark, docs, sf), "t")
    verdict = quality_rules.score(docs, quality_rules.train(docs, plain.read(spark, sf, "labels")))
    assert set(by_id(good)) == {r.doc_id for r in verdict.collect() if r.kept}

    apart = stored(steps["near_dedup"](spark, good, sf), "t")
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert set(by_id(apart)) == {d for d, _, c in groups(rows, 80) if d == c}
    assert len(by_id(apart)) < len(rows)

    clean = stored(steps["decontaminate"](spark, apart, sf), "t")
    items = [(r.item_id, r.text) for r in plain.read(spark, sf, "benchmark").collect()]
    found = contaminated([(r.doc_id, r.text) for r in apart.collect()], items)
    assert set(by_id(clean)) == {d for d, _, hit, _ in found if not hit}

    private = stored(steps["pii"](spark, clean, sf), "t")
    before, after = by_id(clean), by_id(private)
    assert set(before) == set(after)
    for k, row in after.items():
        assert not any(base(row.text).values()) and row.n_chars == len(row.text)
        if not pii.TELLING.search(before[k].text):
            assert row == before[k]
    for frame in (good, apart, clean, private):
        assert frame.dtypes == docs.dtypes

    library = Tokenizer.from_file(bpe.vocabulary_path())
    coded = by_id(steps["bpe"](spark, private, sf))
    for k, row in coded.items():
        ids = library.encode(after[k].text, add_special_tokens=False).ids
        assert list(row.ids) == ids and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert by_id(corpus_pipeline.run(spark, sf)) == coded


def test_odd_rows(spark, sf):
    docs = plain.odd_docs(spark).drop("id", "n", "node")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), "t")
    assert docs.columns[0] == "doc_id"
    none = plain.no_docs(spark).drop("id", "n", "node")
    for _, stage in corpus_pipeline.STAGES:
        none = stored(stage(spark, none, sf), "t")
    assert none.count() == 0
