"""HyperMinHash, sharded Lloyd and the prefix trie against plain Python versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricehouse.llm import hyperminhash, sharded_kmeans, turn_trie

# near-duplicates


def shingle_set(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(b" ".join(words[i : i + width]) for i in range(len(words) - width + 1))


def components_of(rows, least=85):
    """Plain version: doc_id, set size and least reachable doc_id of every row."""
    sets = [shingle_set(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= least * (len(sets[i]) + len(sets[j]) - common):
                    group[root(i)] = root(j)
    least_of = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least_of[root(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        named = min(least_of[root(i)], default=None)
        out.append((doc, len(sets[i]), named, doc is not None and doc == named))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in hyperminhash.near_duplicates(df).collect())


def test_near_duplicates_of_odd_rows(workers, odd_rows, odd_docs, no_docs):
    assert found(odd_docs) == components_of([(r[0], r[1]) for r in odd_rows])
    assert hyperminhash.near_duplicates(no_docs).count() == 0
    rows = [(None, "a b c d"), (None, "A b c d"), (5, "a b c d"), (7, "x y z"), (7, "p q r s"), (None, None), (3, ""), (3, ""), (None, "u v w")]
    assert found(workers.createDataFrame(rows, "doc_id bigint, text string")) == components_of(rows)


def edited(rng, words, share):
    """Words replaced, dropped or repeated."""
    out = []
    for w in words:
        if rng.random() >= share:
            out.append(w)
        elif rng.random() < 0.7:
            out.append(f"w{rng.randrange(100_000)}")
        elif rng.random() < 0.5:
            out += [w, w]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_at_every_similarity(workers, seed):
    """Groups with edits of 0 to 9 in 100 words, copies of copies, shared passages, a centre that is missing."""
    rng = random.Random(seed)
    rows, number = [], iter(range(10_000))
    passage = [f"p{i}" for i in range(60)]
    for group in range(12):
        base = [f"g{group}x{rng.randrange(400)}" for _ in range(rng.choice([8, 20, 60, 150, 400]))]
        family = [base]
        for _ in range(rng.choice([2, 12, 40])):
            family.append(edited(rng, rng.choice(family) if group % 2 else base, rng.random() * 0.09))
        if group % 3 == 0:
            family = family[1:]
        if group % 4 == 0:
            family = [passage + f for f in family]
        rows += [(next(number), " ".join(f)) for f in family]
    rng.shuffle(rows)
    df = workers.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(df) == components_of(rows)


def test_sketches():
    rng = np.random.default_rng(3)
    for n, share in ((2000, 0.9), (2000, 0.5), (150, 0.85), (5000, 0.0)):
        pool = np.unique(rng.integers(0, 2**64, 2 * n, dtype="u8"))
        rng.shuffle(pool)
        same = int(n * share)
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:same], pool[n : 2 * n - same]]))
        true = same / (2 * n - same)
        regs = [hyperminhash.sketch(x)[None] for x in (a, b)]
        got = hyperminhash.estimate(*regs, np.array([float(n)]), np.array([float(n)]))[0]
        assert abs(got - true) < 0.15
    one = hyperminhash.sketch(np.array([5], "u8"))
    assert len(set(one.tolist())) == 1  # the only shingle fills every register
    assert hyperminhash.common(*[np.ascontiguousarray(x.view("u1").reshape(-1, 8)[:, 2:]).tobytes() for x in (a, a)]) == len(a)


# clustering


def lloyd(rows, k=8, rounds=10, seed=3, length=64):
    """Plain version with Python's whole numbers."""
    import math

    kept = [(v, [math.floor(1024 * x) for x in e]) for v, e in rows
            if e is not None and len(e) == length and all(x is not None and math.isfinite(x) and abs(x) < 2**17 for x in e)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centres = [c for _, c in first]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        labels = [nearest(x)[1] for _, x in kept]
        for i in range(len(centres)):
            own = [x for (_, x), label in zip(kept, labels) if label == i]
            if own:
                centres[i] = [sum(c) // len(own) for c in zip(*own)]
    placed = [(v, *nearest(x)[::-1]) for v, x in kept]
    inertia = Counter()
    for _, label, d in placed:
        inertia[label] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((v, c, d, inertia[c], sum(inertia.values()), digest[c]) for v, c, d in placed)


def clustered(df, **options):
    out = sharded_kmeans.with_digests(*sharded_kmeans.cluster(df, **options))
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(tuple(r) for r in out.select(*columns).collect())


@pytest.mark.parametrize("options", [{}, {"columns": 7, "chunk": 3}])
def test_lloyd(workers, options):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(64)]) for i in range(60)]
    rows += [rows[1], rows[1], (None, rows[2][1]), (None, None), (71, None), (72, []), (73, [1.0] * 63), (74, [None] * 64)]
    rows += [(75, [float("nan")] * 64), (76, [float("inf")] * 64), (77, [0.0] * 64), (78, [1e30] * 64), (79, [-131071.0] * 64), (80, [1 / 3] * 64)]
    schema = "vec_id bigint, embedding array<double>, label int, shard int, chunk string"
    df = workers.createDataFrame([(*r, 1, 2, "c") for r in rows], schema).repartition(4)
    assert clustered(df, **options) == lloyd(rows)
    assert clustered(df.limit(0), **options) == Counter()
    few = rows[:3] + [rows[0]]
    assert clustered(workers.createDataFrame([(*r, 1, 2, "c") for r in few], schema), **options) == lloyd(few)


# trie


def plain_nodes(conversations):
    turns = defaultdict(list)
    for conv, turn, role, text in conversations:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}
    whole = {}
    for c, own in lists.items():
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 9
        whole[c] = tuple(lists.get(c - c % 5, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        saved[node] = own + sum(saved[x] for x in children[node])
    return Counter(
        (min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n in members
    )


def nodes(df, **options):
    return Counter(tuple(r) for r in turn_trie.report(df, **options).collect())


_TALK = "conv_id bigint, turn bigint, role string, text string, prefix string, shard int"


def talk(workers, rows):
    return workers.createDataFrame([(*r, "p", 1) for r in rows], _TALK).repartition(3)


@pytest.mark.parametrize("most", [turn_trie.SHARD_TURNS, 12, 1])
def test_trie(workers, most):
    rng = random.Random(6)
    rows = []
    for c in range(90):
        text = rng.choice(["hello", "hello", "é" * 9, "", None])
        for t in range(rng.choice([0, 1, 2, 6, 14])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text if t < 3 else rng.choice(["a", "b", "日本", None])))
    rows += [(200 + i, t, "user", f"same {t}") for i in range(40) for t in range(12)]  # a hot conversation
    rows += [(300 + i, t, "user", f"same {t}" if t < 9 else f"{i}") for i in range(40) for t in range(11)]  # a hot beginning
    rows += [(7, None, None, "first"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (None, 1, "user", "x"), (991, 0, "u", "x" * 300_000)]
    assert nodes(talk(workers, rows), most=most) == plain_nodes(rows)
    assert nodes(talk(workers, rows[:0]), most=most) == Counter()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=6), max_size=30))
def test_double_array_walks_to_every_prefix(sequences):
    distinct = sorted({tuple(s) for s in sequences})
    trie = turn_trie.DoubleArray([np.array(s, "i8") for s in distinct])
    seen = {}
    for depth, rows, at in trie.walk():
        for row, node in zip(rows.tolist(), at.tolist()):
            assert seen.setdefault(node, distinct[row][:depth]) == distinct[row][:depth]
    assert len(set(seen.values())) == len(seen) and set(seen.values()) >= {s[:d] for s in distinct for d in range(len(s) + 1)}
