import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import counts, packing
from tidemark.llm.frames import tokenizer_file

ODD = [
    None, "", "a  b\n\n c  <|endoftext|> d", "İstanbul ﬁ é", "'s 's ''s don't  \n x²", "<|ENDOFTEXT|> <| x",
    "x\x1cy a\xa0b", "ERTH!!\t%%% | a1b22 \U0001f600", "z" * 9000, "word " * 5000, "日本", " ", "a<b <c|",
]
DDL = "doc_id long, text string, piece int, n_tokens string"


def rows():
    return [(i, t, 9, "clash") for i, t in enumerate(ODD)] + [(None, "a b", 1, ""), (5, "twice", 1, ""), (5, "twice", 1, "")]


def ids_of(name, text):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_are_the_library_s(frame):
    got = counts.count_tokens(frame(rows(), DDL), tokenizer_file("byte_bpe_50k.json"), limit=3).collect()
    want = [(d, len((t or "").encode()), len(ids_of("byte_bpe_50k.json", t))) for d, t, *_ in rows()]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got if r["doc_id"] is not None) == sorted(
        w for w in want if w[0] is not None
    )
    assert all(r["over_limit"] == (r["n_tokens"] > 3) for r in got) and len(got) == len(want)
    assert counts.count_tokens(frame([], DDL), tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_packed_pieces_are_the_library_s_and_gapless(frame, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION_SEQUENCES", 2)
    got = packing.pack(frame(rows(), DDL), tokenizer_file("word_bpe_49k.json"), capacity=100, with_ids=True).collect()
    want = collections.Counter()
    for d, t, *_ in rows():
        ids = np.array(ids_of("word_bpe_49k.json", t) + [0], "<u4")
        for k in range(0, len(ids), 100):
            part = ids[k : k + 100]
            want[(d, k // 100, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    bound = packing.lower_bound(np.array([r["length"] for r in got]), 100)
    assert bound <= len(sequences) <= bound + 1
    assert packing.pack(frame([], DDL), tokenizer_file("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_for_small_optimal_packings(seed):
    rng = np.random.default_rng(seed)
    for _ in range(30):
        sizes = rng.integers(1, 21, rng.integers(1, 8))
        bins = packing.best_fit(sizes, 20)
        assert max(np.bincount(bins, sizes)) <= 20
        assert packing.lower_bound(sizes, 20) <= optimal(sorted(sizes.tolist(), reverse=True), 20) <= bins.max() + 1


def optimal(sizes, capacity):
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= capacity:
                place(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_partitions_with_gaps_exchange_documents(frame):
    # Sizes that pair up across partitions: 60 with 40 of the capacity.
    text = {60: "a " * 59, 40: "a " * 39}
    rows = [(i, text[60 if i % 2 else 40], 0, "") for i in range(200)]
    old = packing.PARTITION_SEQUENCES
    packing.PARTITION_SEQUENCES = 5
    try:
        got = packing.pack(frame(rows, DDL), tokenizer_file("word_bpe_49k.json"), capacity=100)
        assert got.select("sequence_id").distinct().count() == 100 == packing.certified_bound(got, 100)
    finally:
        packing.PARTITION_SEQUENCES = old
