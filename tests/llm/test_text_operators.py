"""Operators on documents against plain Python versions."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricehouse.llm import mixing, piece_encoding, quality_rules, queries, secret_scans, simhash, substring_dedup, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# quality rules


def plain_counts(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(inside), len(words) < 50 or 100 * len(inside) > 50 * len(words),
    )


def test_quality_counts(odd_docs, odd_rows):
    got = rows_of(
        quality_rules.report(odd_docs),
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    )
    assert got == Counter((r[0], *plain_counts(r[1])) for r in odd_rows)


def test_quality_keeps_columns_and_only_good_rows(odd_docs, no_docs):
    kept = quality_rules.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.report(odd_docs).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in verdicts.items() if k}
    assert quality_rules.keep_good(no_docs).count() == 0


def test_quality_rule_bounds(workers):
    text = " ".join(f"the w{i}" for i in range(40))
    docs = workers.createDataFrame([(1, text), (2, text.replace("the", "###"))], "doc_id bigint, text string")
    said = {r["doc_id"]: (r["kept"], r["broken"]) for r in quality_rules.report(docs).collect()}
    assert said == {1: (True, ""), 2: (False, "symbols_per_word,stop_word_ratio")}
    strict = [quality_rules.Rule("mean_word_chars", at_least=4)]
    assert not any(r["kept"] for r in quality_rules.report(docs, strict).collect())
    with pytest.raises(ValueError):
        quality_rules.Rule("n_words").broken()


# SentencePiece


def plain_pieces(sp, text):
    ids = sp.encode(text or "", add_bos=True, add_eos=True)
    raw = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_pieces_equal_the_library(odd_docs, odd_rows, no_docs):
    sp = piece_encoding.processor(MODEL)
    got = rows_of(piece_encoding.digests(odd_docs, MODEL), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == Counter((r[0], *plain_pieces(sp, r[1])) for r in odd_rows)
    assert piece_encoding.digests(no_docs, MODEL).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab ▁\n\té日😀\0<s>", "  "]), max_size=25).map("".join), max_size=6))
def test_chunk_table_on_odd_texts(texts):
    table, sp = piece_encoding.ChunkTable(MODEL, most=5), piece_encoding.processor(MODEL)
    for _ in range(2):
        offsets, ids = table.encode(texts)
        got = [ids[i:j].tolist() for i, j in zip(offsets, offsets[1:])]
        assert got == [sp.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_decode_gives_texts_back(odd_docs, odd_rows):
    coded = piece_encoding.encode(odd_docs, MODEL, ("doc_id", "lang"))
    texts = rows_of(piece_encoding.decode(coded, MODEL), "doc_id", "text")
    sp = piece_encoding.processor(MODEL)
    assert texts == Counter((r[0], sp.decode(sp.encode(r[1] or ""))) for r in odd_rows)


# secrets


def plain_base(text):
    text, found = text or "", []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    names = ("assign", "access", "hex")
    listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))
    return *[sum(k == n for _, k, _ in found) for n in range(3)], hashlib.sha256(listed.encode()).hexdigest()


def test_base_secrets(odd_docs, odd_rows, no_docs):
    got = rows_of(secret_scans.find_secrets(odd_docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == Counter((r[0], *plain_base(r[1])) for r in odd_rows)
    assert secret_scans.find_secrets(no_docs).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"AKIApaswordtken_=:'\" 0f\nK", "AKIA", "token=", "f" * 31, "ſ"]), max_size=60).map("".join))
def test_base_secrets_on_odd_texts(text):
    base = [s for s in secret_scans.spans_of(text) if s[1] < 3]
    listed = ",".join(f"{secret_scans.KINDS[k]}:{s}:{e}" for s, k, e, _, _ in base)
    assert hashlib.sha256(listed.encode()).hexdigest() == plain_base(text)[3]


def test_battery_tells_random_from_patterned(workers):
    import random

    rng = random.Random(3)
    secret = ["".join(rng.choice(secret_scans.ALPHABETS[6]) for _ in range(60)) + "7a" for _ in range(100)]
    patterned = ["xyz123" * 10, "aaaaaaaaaaaaaaaaaaaaaaaaaa1", "0101010101010101x0101010101", "a1b2c3d4e5f6g7h8" * 3]
    docs = workers.createDataFrame(list(enumerate(secret + patterned)), "doc_id bigint, text string")
    found = {r["doc_id"] for r in secret_scans.find_secrets(docs).collect() if r["spans"]}
    assert len(found & set(range(100))) >= 95 and not found & set(range(100, 104))


def test_redaction(odd_docs, odd_rows, workers):
    out = secret_scans.redact(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == len(odd_rows)
    one = workers.createDataFrame([(1, "x token = abcdefgh12 y " + "0f" * 20), (2, None)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in secret_scans.redact(one).collect()} == {1: "x [secret] y [secret]", 2: None}


# mixing


def test_mix_takes_about_the_target(odd_docs, odd_rows, no_docs):
    plan = mixing.plan_mix(odd_docs, cell_rows=4)
    rows = [r.asDict() for r in plan.collect()]
    again = [r.asDict() for r in mixing.plan_mix(odd_docs.repartition(5), cell_rows=4).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert len(rows) == len(odd_rows)
    sizes = defaultdict(int)
    for r in odd_rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, targets = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            break
        targets |= {s: 2.0 * sizes[s] for s in over}
        left, free = left - sum(2 * sizes[s] for s in over), free - over
    targets |= share
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 2
        assert r["target"] == pytest.approx(targets[r["source"]])
        taken[r["source"]] += r["copies"] * r["size"]
    longest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - targets[s]) <= 2 * longest for s in sizes)
    assert mixing.plan_mix(no_docs).count() == 0


def test_mixed_rows(odd_docs, no_docs):
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    plan = mixing.plan_mix(odd_docs)
    assert mixed.count() <= plan.count() * 2
    per_doc = Counter(r["doc_id"] for r in mixed.collect())
    rows = Counter(r["doc_id"] for r in odd_docs.collect())
    assert all(n <= 2 * rows[d] for d, n in per_doc.items())
    assert mixing.mix(no_docs).count() == 0


# SimHash


def plain_groups(rows):
    prints = {r[0]: simhash.fingerprint((r[1] or "").encode()) for r in rows}
    group = {i: i for i in prints}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i: (f"{prints[i]:016x}", root(i)) for i in ids}


def test_fingerprint_by_hand():
    import xxhash

    words = "The cat sat on the cat sat on".lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(6)]
    bits = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > 3)
    assert simhash.fingerprint(b"The cat\tsat ON\nthe cat sat on") == bits
    assert simhash.fingerprint(b"One Two") == xxhash.xxh64_intdigest("one two", 42)
    assert simhash.fingerprint(b" \n") == 0


def test_near_duplicates(odd_docs, odd_rows, no_docs):
    expected = plain_groups(odd_rows)
    got = rows_of(simhash.near_duplicates(odd_docs), "doc_id", "fingerprint", "component_id")
    assert got == Counter((r[0], *expected[r[0]]) for r in odd_rows)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = [r["doc_id"] for r in simhash.keep_first(odd_docs).collect()]
    assert sorted(kept) == sorted(i for i, (_, c) in expected.items() if i == c)


@pytest.mark.parametrize("bands", [4, 6, 8])
def test_links_equal_all_pairs(workers, bands):
    import random

    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for n in (1, 2, 3, 4):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), n)))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = workers.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    got = {(r["left"], r["right"]) for r in simhash.links(df, bands=bands).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_key_coordinates_tell_contents_apart(workers):
    df = workers.createDataFrame([(x << 20,) for x in range(16)], "fingerprint bigint")
    assert df.select(simhash.key_coordinates(5)).distinct().count() == 16


# substrings


def plain_dedup(rows, window=13):
    first = {}
    docs = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for i, words in docs:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, i), i)
    for i, words in docs:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < i:
                gone |= set(range(s, s + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        yield i, len(words), len(gone), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("cell_bytes, part_hashes", [(1 << 24, 1 << 22), (20_000, 2_000)])
def test_substrings(odd_docs, odd_rows, no_docs, monkeypatch, cell_bytes, part_hashes):
    monkeypatch.setattr(substring_dedup, "CELL_BYTES", cell_bytes)
    monkeypatch.setattr(substring_dedup, "PART_HASHES", part_hashes)
    got = rows_of(
        substring_dedup.dedup_substrings(odd_docs, digest=True), "doc_id", "n_words", "n_removed", "kept_sha256"
    )
    assert got == Counter(plain_dedup(odd_rows))
    assert sum(n for (_, _, n, _) in got) > 200
    assert substring_dedup.dedup_substrings(no_docs).count() == 0


def test_substrings_text_and_null_id(workers):
    words = " ".join(f"w{i}" for i in range(20))
    docs = workers.createDataFrame([(None, words), (4, words + " tail"), (5, words)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in substring_dedup.dedup_substrings(docs).collect()}
    assert got == {None: (20, ""), 4: (0, words + " tail"), 5: (20, "")}


# token counts


def test_token_totals(odd_docs, odd_rows, no_docs, workers, tmp_path):
    bpe = queries.byte_bpe()
    counts = token_counts.count_tokens(odd_docs, {"words-1": token_counts.words_counter(), "bpe": bpe}).persist()
    store = token_counts.TokenTotals(workers, f"file://{tmp_path}/totals")
    assert store.totals().count() == 0
    assert store.commit("a", token_counts.inserts(counts)) and not store.commit("a", token_counts.inserts(counts))

    def plain(rows, sign=1):
        out = defaultdict(lambda: [0, 0])
        for r in rows:
            for name, n in (("words-1", len(WORD.findall(r[1] or ""))), ("bpe", bpe(r[1] or ""))):
                out[r[3], r[2], name][0] += sign
                out[r[3], r[2], name][1] += sign * n
        return out

    def totals():
        return {(r[0], r[1], r[2]): [r[3], r[4]] for r in store.totals().collect()}

    expected = plain(odd_rows)
    assert totals() == dict(expected)
    assert store.commit("none", token_counts.inserts(token_counts.count_tokens(no_docs, {"bpe": bpe})))
    least = {}
    for r in odd_rows:
        if r[1] is not None:
            least[r[1]] = min(least.get(r[1], r[0]), r[0])
    copies = [r for r in odd_rows if r[1] is not None and r[0] > least[r[1]]]
    assert copies
    for _ in range(2):
        store.commit("copies", token_counts.deletes(token_counts.repeats(counts)))
    for key, (n, t) in plain(copies, -1).items():
        expected[key][0] += n
        expected[key][1] += t
    assert totals() == {k: v for k, v in expected.items() if v != [0, 0]}
    old = counts.filter("doc_id = 9")
    store.commit("revised", token_counts.revisions(old, old.withColumn("n_tokens", old.n_tokens + 5)))
    row = next(r for r in odd_rows if r[0] == 9)
    for name in ("words-1", "bpe"):
        expected[row[3], row[2], name][1] += 5
    assert totals() == {k: v for k, v in expected.items() if v != [0, 0]}


def test_cut_short_commit_is_not_counted(workers, tmp_path):
    store = token_counts.TokenTotals(workers, f"file://{tmp_path}/totals")
    rows = workers.createDataFrame([("s", "en", "t", 1, 5)], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint")
    store.commit("first", rows)
    rows.write.parquet(f"file://{tmp_path}/totals/rollups/part={token_counts._name('lost')}")
    assert [tuple(r)[3:] for r in store.totals().collect()] == [(1, 5)]
    assert store.commit("lost", rows)
    assert [tuple(r)[3:] for r in store.totals().collect()] == [(2, 10)]


@pytest.mark.parametrize("rows", [1, 7, 40])
def test_mix_is_the_same_for_every_number_of_cells(workers, odd_docs, rows):
    def taken(**options):
        return Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in mixing.plan_mix(odd_docs, **options).collect())

    assert taken(cell_rows=rows) == taken()
    mixed = [Counter(map(tuple, mixing.mix(odd_docs, **o).collect())) for o in ({}, {"cell_rows": rows})]
    assert mixed[0] == mixed[1]


def test_mix_spreads_rows_without_ids_and_repeated_rows(workers):
    rows = [(None, "a b c", "s")] * 60 + [(1, "a b c", "s")] * 40 + [(None, None, "t"), (2, "x", None)]
    df = workers.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string, `a.b` string")
    plan = mixing.plan_mix(df, cell_rows=4).collect()
    assert len(plan) == len(rows)
    for source in ("s", None):
        own = [r for r in plan if r["source"] == source]
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= 3
    assert {r["copies"] for r in plan if r["doc_id"] == 1 or r["source"] == "s"} == {1, 2}
    mixed = mixing.mix(df, cell_rows=4)
    assert mixed.columns == df.columns
    assert sum(1 for r in mixed.collect() if r["source"] == "s") == sum(r["copies"] for r in plan if r["source"] == "s")


def test_long_white_space_is_counted(workers):
    bpe = queries.byte_bpe()
    rows = [(1, "a" + " " * 1_000_000 + "b"), (2, " " * 1_000_000), (3, "x\n" * 600_000), (4, "y" + "\n" * 150_000 + " \t z"), (5, "n" * 1_200_000)]
    assert bpe(rows[3][1]) == len(token_counts._byte_bpe(*_files()).encode_ordinary(rows[3][1]))
    df = workers.createDataFrame([(*r, "s", "en") for r in rows], "doc_id bigint, text string, source string, lang string")
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, {"bpe": bpe}).collect()}
    assert counts[1] == bpe("a" + " " * 90_000 + "b") + 910_000 and counts[2] > 0 and counts[3] == bpe("x\n" * 6) * 100_000


def _files():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_repeats_as_counts_and_folded_batches(odd_docs, workers, tmp_path):
    counts = token_counts.count_tokens(odd_docs, {"words-1": token_counts.words_counter()}).persist()
    extra = counts.limit(5).withColumn("doc_id", counts.doc_id + 1)  # further copies, in other documents
    counts = counts.unionByName(extra).unionByName(extra.withColumn("source", extra.lang)).persist()
    as_rows = token_counts.roll_up(token_counts.deletes(token_counts.repeats(counts))).filter("n_docs <> 0")
    as_counts = token_counts.roll_up(token_counts.repeat_deltas(counts))
    assert Counter(map(tuple, as_rows.collect())) == Counter(map(tuple, as_counts.collect()))
    plain, folding = (token_counts.TokenTotals(workers, f"file://{tmp_path}/{n}") for n in ("plain", "folding"))
    for store in (plain, folding):
        for batch in range(3):
            assert store.commit(f"b{batch}", token_counts.inserts(counts))
            if store is folding:
                store.fold()
        store.commit("gone", token_counts.repeat_deltas(counts))
        assert not store.commit("b0", token_counts.inserts(counts))
    assert Counter(map(tuple, plain.totals().collect())) == Counter(map(tuple, folding.totals().collect()))


def test_op1_query(workers):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in workers.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    bpe, expected, first = queries.byte_bpe(), defaultdict(lambda: [0, 0]), {}
    for doc, text, _, _ in rows:
        first[text] = min(first.get(text, doc), doc)
    for doc, text, lang, source in rows:
        old, new = text or "", (text or "").lower() if lang == "de" else text or ""
        for name, count in (("words-1", lambda t: len(t.encode().split())), ("byte-bpe-50k", bpe)):
            gone = text is not None and doc > first[text]
            expected[source, lang, name][0] += 1 - gone
            expected[source, lang, name][1] += count(new) - (count(old) if gone else 0)
    got = {tuple(r)[:3]: list(r)[3:] for r in queries.op1_token_counts(workers, folder).collect()}
    assert got == {k: v for k, v in expected.items() if v != [0, 0]}
