"""A million spaces, a line of a megabyte and a token of a megabyte, through every text operator and the pipeline."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from pricehouse.llm import hyperminhash, piece_encoding, quality_rules, queries, secret_scans, simhash, substring_dedup

_RNG = random.Random(12)
PROSE = " ".join(_RNG.choice(["the", "of", "and", "river", "stone", "x1"]) + str(i) + " the of" for i in range(60_000))
TEXTS = {
    1: "a" + " " * 1_000_000 + "b",
    2: "\n" * 300_000 + " \t" * 100_000,
    3: PROSE,  # one line
    4: "q" * 1_100_000,
    5: "k=" + "".join(_RNG.choice("0123456789abcdefghijABCDEFGHIJ+/") for _ in range(200_000)),
    6: PROSE,
    7: "short",
}


@pytest.fixture(scope="module")
def long_docs(workers):
    rows = [(i, t, "en", "s1", len(t), "x") for i, t in TEXTS.items()]
    return workers.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, `a.b` string").repartition(3).persist()


def test_long_texts_word_operators(long_docs):
    words = {i: t.encode().split() for i, t in TEXTS.items()}
    report = {r["doc_id"]: r for r in quality_rules.report(long_docs).collect()}
    assert {i: r["n_words"] for i, r in report.items()} == {i: len(w) for i, w in words.items()}
    prints = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(long_docs).collect()}
    assert {i: p for i, (p, _) in prints.items()} == {i: simhash.fingerprint(t.encode()) for i, t in TEXTS.items()}
    assert prints[6][1] == prints[3][1] == 3
    near = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hyperminhash.near_duplicates(long_docs).collect()}
    assert near[6][1] == 3 and near[1] == (1, 1) and near[2] == (0, 2) and near[4] == (1, 4)
    left = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(long_docs, digest=True).collect()}
    assert left[6]["n_removed"] == len(words[6]) and left[3]["n_removed"] == 0
    assert left[4]["kept_sha256"] == hashlib.sha256(TEXTS[4].encode()).hexdigest()


def test_long_texts_are_encoded(long_docs):
    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = piece_encoding.processor(model)
    coded = {r["doc_id"]: r["ids"] for r in piece_encoding.encode(long_docs, model).collect()}
    assert coded == {i: sp.encode(t, add_bos=True, add_eos=True) for i, t in TEXTS.items()}


def test_long_texts_are_scanned(long_docs):
    spans = {r["doc_id"]: r["spans"] for r in secret_scans.find_secrets(long_docs).collect()}
    assert all(not spans[i] for i in (1, 2, 3, 4, 7))
    many = "password = hunter2hunter2 " * 20_000 + " Zk3 " * 20_000
    assert len(secret_scans.spans_of(many)) == 20_000


def test_long_texts_pass_the_pipeline(workers, long_docs):
    docs = long_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(workers, docs, "").persist()
        if name != "piece_encoding":
            assert docs.columns == long_docs.columns
    rows = Counter(r["doc_id"] for r in docs.collect())
    assert set(rows) == {3} and queries.piece_model()
