import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece

from tidemark.llm import pieces
from tidemark.llm.frames import tokenizer_file

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", "a  b", "a   b  ", " " * 40, " lead", "trail ", "日本語 テスト \U0001d11e", "x\0y", "a" * 33,
    " aaa baaaab  bbbb", "a▁b ▁▁ c", "\n\n\t x", "the  " + " " * 31 + "quick", "﻿", "z" * 5000,
]


def test_ids_are_the_library_s():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(1)
    vocabulary = list(pieces.vocabulary(PATH).ids)
    texts = ODD + ["".join(rng.choice("abcdeinrst ") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    for text, got in zip(texts, pieces.encode_texts(texts, PATH)):
        ids = np.frombuffer(got, "<u4")
        assert ids.tolist() == library.encode(text), text
        assert pieces.decode_ids(ids, PATH) == text.replace("▁", " ")


def test_borders_of_pieces():
    """The rule for pairs equals merging their joint text."""
    v = pieces.vocabulary(PATH)
    text = {i: p for p, i in v.ids.items()}
    rng = np.random.default_rng(2)
    short = v.matched[v.length <= 4]
    a = np.concatenate([rng.choice(v.matched, 4000), rng.choice(short, 4000)])
    b = np.array([i for i in rng.choice(v.matched, 30_000) if text[i][0] != "▁"][:8000])
    want = [v.merged(text[x] + text[y]) != [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert v._cross(a, b).tolist() == want


def test_columns(frame):
    model = tokenizer_file("piece_bpe_32k.model")
    df = frame([(1, "two words", 5), (1, "two words", 5), (2, None, 6), (None, "", 7)], "doc_id long, text string, ids int")
    rows = df.drop("ids").withColumn("ids", pieces.encode(model)).withColumns({"back": pieces.decode(model), "digest": pieces.round_trip(model)})
    found = sorted(rows.collect(), key=repr)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for r in found:
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids and r["back"] == (r["text"] or "")
        assert r["digest"]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert (r["digest"]["n_ids"], r["digest"]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert len(found) == 4


def test_empty_table(frame):
    df = frame([], "text string")
    assert df.select(pieces.encode(tokenizer_file("piece_bpe_32k.model"))).count() == 0
