"""The pipeline against a plain version, stage by stage."""

from collections import Counter

import public_tokenizers

import corpus_pipeline
from pricehouse.llm import mixing, piece_encoding, quality_rules, queries, secret_scans, simhash


def test_stages(odd_docs, odd_rows, no_docs, workers):
    docs = odd_docs
    good = {r["doc_id"] for r in quality_rules.report(docs).collect() if r["kept"]}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "secret_scans", "mixing", "piece_encoding"]
    stage = dict(corpus_pipeline.STAGES)
    first = stage["quality_rules"](workers, docs, "").persist()
    assert {r["doc_id"] for r in first.collect()} == good
    second = stage["simhash_near_dedup"](workers, first, "").persist()
    groups = simhash.near_duplicates(first).collect()
    assert Counter(r["doc_id"] for r in second.collect()) == Counter({r["component_id"] for r in groups})
    third = stage["secret_scans"](workers, second, "").persist()
    assert third.count() == second.count()
    texts = {r["doc_id"]: r["text"] for r in second.collect()}
    for r in third.collect():
        found = [s for s in secret_scans.spans_of(texts[r["doc_id"]]) if s[1] < 3]
        assert ("[secret]" in r["text"]) >= bool(found) and r["n_chars"] == len(r["text"])
    fourth = stage["mixing"](workers, third, "").persist()
    planned = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(third.withColumn("row_key", third.n_chars * 0), ("doc_id",)).collect()}
    assert sum(planned.values()) - len(planned) <= fourth.count() <= 2 * third.count()
    assert [d.columns for d in (first, second, third, fourth)] == [docs.columns] * 4
    last = stage["piece_encoding"](workers, fourth, "")
    sp = piece_encoding.processor(public_tokenizers.path("piece_bpe_32k.model"))
    coded = Counter((r["doc_id"], tuple(sp.encode(r["text"], add_bos=True, add_eos=True))) for r in fourth.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in last.collect()) == coded
    docs = no_docs
    for _, run in corpus_pipeline.STAGES:
        docs = run(workers, docs, "")
    assert docs.count() == 0


def test_run_repeats_itself(workers):
    rows = [queries.pipeline(workers, "/root/testdata/sf0.001").select("doc_id", "n_tokens", "ids") for _ in range(2)]
    assert Counter(map(tuple, rows[0].collect())) == Counter(map(tuple, rows[1].collect()))
