"""SimHash groups and MinHash fingerprints against brute force."""

import hashlib
import random

import numpy as np
from loomlog.llm import minhash, simhash


def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(2, 8))) for _ in range(n)]


def corpus(seed=1, groups=12):
    """Texts with exact copies, copies with a word changed, short, empty and null texts, a null and a repeated doc_id."""
    r, texts = random.Random(seed), []
    for g in range(groups):
        base = words(120 + 40 * g, g)
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 4)):
            copy = list(base)
            copy[r.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
        texts.append(" ".join(base).upper() if g % 3 == 0 else "\n".join(base))
    texts += ["", None, "one", "one two", "one two three", "  "]
    rows = list(enumerate(texts))
    return [*rows, (None, texts[0]), (3, texts[3]), (900, "x " * 5000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "f", 0, 1) for i, t in rows], "doc_id long, text string, fp string, label int, component_id int")


def root_of(parent, a):
    while parent[a] != a:
        a = parent[a]
    return a


def brute_components(rows, linked):
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for x in range(len(rows)):
        for y in range(x):
            if linked(x, y):
                root[find(x)] = find(y)
    smallest = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            smallest[find(x)] = min(smallest.get(find(x), i), i)
    return [smallest.get(find(x)) for x in range(len(rows))]


def test_groups_match_brute_force(spark):
    rows = corpus()
    fps = [simhash.fingerprint(t or "") for _, t in rows]
    want = brute_components(rows, lambda x, y: (fps[x] ^ fps[y]).bit_count() <= 2)
    expected = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, want)), key=repr)
    for limit in (2_000, 2):
        found = simhash.components(frame(spark, rows), shard_limit=limit)
        got = [(r.doc_id, f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in found.collect()]
        assert sorted(got, key=repr) == expected
    assert sorted(map(tuple, simhash.simhash_groups(frame(spark, rows)).collect()), key=repr) == expected


def test_fingerprint_by_definition():
    import xxhash
    text = "The\tQuick brown fox  jumps ÀÉ over The quick Brown fox"
    lowered = "".join(c.lower() if c.isascii() else c for c in text).split()
    hashes = [xxhash.xxh64_intdigest(" ".join(lowered[k:k + 3]), seed=42) for k in range(len(lowered) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("") == 0


def test_forest_connects_all_links():
    r = random.Random(4)
    base = r.getrandbits(64)
    members = sorted({base ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 3))) for _ in range(200)})
    parent = {m: m for m in members}
    for a, b in simhash.forest(members, 2):
        assert (a ^ b).bit_count() <= 2
        ra, rb = root_of(parent, a), root_of(parent, b)
        assert ra != rb
        parent[rb] = ra
    for a in members:
        for b in members:
            if (a ^ b).bit_count() <= 2:
                assert root_of(parent, a) == root_of(parent, b)


def test_labels_follow_long_chains(spark):
    pairs = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    got = {r.fp: r.label for r in simhash.labels_of(pairs).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_minhash_likeness_is_near_jaccard():
    r = random.Random(2)
    for share in (0.0, 0.3, 0.6, 0.9, 1.0):
        base = words(900, 7)
        other = base[:int(900 * share)] + words(900 - int(900 * share), 8)
        r.shuffle(words(3, 1))
        a, b = (set(zip(*[w[k:] for k in range(5)])) for w in (base, other))
        got = minhash.likeness(minhash.minima(" ".join(base)), minhash.minima(" ".join(other)))
        assert abs(got - len(a & b) / len(a | b)) < 0.12
    assert minhash.fingerprint_likeness("", "") == 1.0
    assert minhash.fingerprint_likeness("", minhash.packed_hex(minhash.minima("a"))) == 0.0


def test_edits_follow_the_next_document(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 7)
    rows = corpus(seed=3)
    got = minhash.edit_likeness(frame(spark, rows)).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        low = [minhash.minima(x) for x in (t, edited, following)]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), minhash.packed_hex(low[0]), minhash.packed_hex(low[1]),
                     minhash.likeness(low[0], low[1]), minhash.likeness(low[0], low[2])))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_stored_fingerprints_give_the_same_likeness():
    a, b = minhash.minima("a b c d e f g h"), minhash.minima("a b c d e f g x")
    assert minhash.fingerprint_likeness(minhash.packed_hex(a), minhash.packed_hex(b)) == minhash.likeness(a, b)
    assert isinstance(a, np.ndarray) and len(a) == minhash.BINS


def test_empty_tables(spark):
    none = frame(spark, [])
    assert simhash.simhash_groups(none).count() == 0
    assert simhash.first_of_each(none, simhash.components(none)).count() == 0
    assert minhash.edit_likeness(none).count() == 0
    assert minhash.fingerprints(none).count() == 0
    one = frame(spark, [(4, "only one")])
    assert minhash.edit_likeness(one).first().near_next == 1.0


def test_one_of_each_group_stays(spark):
    rows = corpus(seed=5, groups=6)
    docs = frame(spark, rows)
    kept = simhash.first_of_each(docs, simhash.components(docs))
    assert kept.columns == docs.columns
    fps = [simhash.fingerprint(t or "") for _, t in rows]
    groups = brute_components(rows, lambda x, y: (fps[x] ^ fps[y]).bit_count() <= 2)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups))
