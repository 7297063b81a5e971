from collections import Counter

import corpus_pipeline
from brimline.llm import mixing, secret_scan
from brimline.llm.common import settled
from tests.llm.test_ids import check_packing, whole  # noqa: F401
from tests.llm.test_native import plain_verdicts
from tests.llm.test_secret_scan import base_spans, markov_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_and_run(spark, whole):  # noqa: F811
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(settled(stage(spark, steps[-1], sf), "test-stage"))
    rows = [s.collect() for s in steps]
    assert all(s.columns == docs.columns for s in steps[:-1])

    judged = plain_verdicts([(r.doc_id, r.text, r.source) for r in rows[0]], 20, 0.05)
    assert {r.doc_id for r in rows[1]} == {x[0] for x in judged if x[-1]}

    groups = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in rows[1]])
    assert Counter(r.doc_id for r in rows[2]) == Counter({c for _, _, c in groups})

    models = secret_scan.train(secret_scan.labelled_tokens(steps[2]))
    before = {r.doc_id: r.text for r in rows[2]}
    assert {r.doc_id for r in rows[3]} == set(before)
    for r in rows[3]:
        found = base_spans(before[r.doc_id]) + markov_spans(before[r.doc_id], models)
        assert (r.text != before[r.doc_id]) == bool(found)
        assert r.n_chars == (len(r.text) if found else r.n_chars)
        assert not any(before[r.doc_id][a:b] in r.text for a, _, b in found)

    weighed = mixing.weighed(steps[3])
    chance = mixing.drawn(weighed, mixing.chances(weighed)).collect()
    assert {r.doc_id for r in rows[4]} == {r["_id"] for r in chance if r.kept}
    assert len(rows[4]) > len(rows[3]) / 2

    check_packing(rows[5], [(r.doc_id, r.text) for r in rows[4]], whole, 2048)
    ran = corpus_pipeline.run(spark, sf).collect()
    lengths = lambda rs: Counter(tuple(r)[:5] for r in rs)
    assert lengths(ran) == lengths(rows[5])

