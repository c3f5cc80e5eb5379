"""BPE by tree concatenation, token counts and packing against the tokenizers library and brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from loomlog.llm import bpe, byte_units, packing, token_counts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a  b ", "\n \n x\t\r\n", "x<|endoftext|>  y <|ENDOFTEXT|>", "don't   we'll 's's", "日本語 テスト 😀 é é", "a\x1c b \x1fc  d", "١٢٣ ²½ İ ΣΑΣ"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    """Documents with null values, a repeated row and columns whose names clash with results."""
    return spark.createDataFrame(
        [(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, n_tokens string, part int, pre_token string")


@pytest.fixture(scope="module")
def rows():
    random.seed(5)
    long = "".join(random.choice("abcdefghij") for _ in range(3000)) + " tail " + "word and " * 900
    return [*enumerate(ODD), (50, None), (None, "null id"), (51, "twice"), (51, "twice"), (52, long), (52, long)]


def encode(path, text):
    return bpe.load(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("part_chars", [40, 700])
def test_tree_concatenation_is_exact(part_chars):
    random.seed(3)
    tokenizer = bpe.load(WORD)
    texts = ["a" * 3000, "ab" * 1500, "'s" * 800 + "!!'s" * 300, "12345" * 300, "é" * 900 + "é" * 300, "<|endoftext|>" * 90,
             "".join(random.choice(["'s", "'", "s", "t", "!", " ", "1", "the", "é"]) for _ in range(4000)), "!" * 2000,
             "".join(random.choice("abcdefgh") for _ in range(6000))]
    for text in texts:
        borders, nodes = bpe.cuts(len(text), part_chars), []
        for a, b in zip(borders, borders[1:]):
            ids, starts, ends = bpe.encode_tokens(tokenizer, text[a:b])
            nodes.append(bpe.Node(a, b, ids, starts + a, ends + a))
        whole = bpe.encode_tokens(tokenizer, text)
        joined = bpe.concat_tree(nodes, text, tokenizer)
        assert joined.ids.tolist() == whole[0].tolist()
        assert joined.starts.tolist() == whole[1].tolist()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_digests_match_the_library(spark, rows, path):
    got = sorted(map(tuple, bpe.encoded_digests(frame(spark, rows), path, part_chars=500).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = encode(path, t)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(bpe.load(path).decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=repr)


def test_units_match_the_library():
    encoder = byte_units.UnitIds(BYTE, kept=5)
    for text in [*ODD, "a   b", "tail  ", "x \n y", "   lead"]:
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == encode(BYTE, text)


def test_token_counts_match_the_library(spark, rows):
    for frequent in (3, 400_000):
        got = sorted(map(tuple, token_counts.token_counts(frame(spark, rows), BYTE, 20, frequent).collect()), key=repr)
        want = [(i, len((t or "").encode()), n := len(encode(BYTE, t)), n > 20) for i, t in rows]
        assert got == sorted(want, key=repr)


def test_packing_holds_every_piece(spark, rows):
    found = [r.asDict() for r in packing.packed(frame(spark, rows), BYTE, capacity=64).collect()]
    want = Counter()
    for i, t in rows:
        ids = np.array([*encode(BYTE, t), 2], dtype="<u4")
        first = len(ids) % 64 or 64
        for k, a in enumerate([0, *range(first, len(ids), 64)]):
            b = first if k == 0 else a + 64
            want[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((f["doc_id"], f["piece"], f["start"], f["length"], f["ids_crc32"]) for f in found) == want
    sequences = {}
    for f in found:
        sequences.setdefault(f["sequence_id"], []).append((f["offset"], f["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(f["length"] for f in found)
    assert len(sequences) <= 1.1 * total / 64 + 1


@pytest.mark.parametrize("counts", [{}, {7: 1}, {1024: 5}, {600: 90, 424: 90}, {n: 1 + n % 7 for n in range(1, 1024)}, {300: 10**7, 100: 3 * 10**6, 24: 5}])
def test_plans_hold_the_histogram(counts):
    plan = packing.pack_lengths(counts, 1024, steps=60)
    held = Counter()
    for config, times in plan.items():
        assert sum(length * n for length, n in config) <= 1024
        for length, n in config:
            held[length] += n * times
    assert held == Counter(counts)
    assert sum(plan.values()) <= 1.08 * sum(a * b for a, b in counts.items()) / 1024 + 40 or counts.get(300)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert bpe.encoded_digests(none, WORD).count() == 0
    assert token_counts.token_counts(none, BYTE).count() == 0
    assert packing.packed(none, BYTE).count() == 0
