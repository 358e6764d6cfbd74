from __future__ import annotations

import random
import time
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from skyledger.llm import queries
from skyledger.llm import sentence_pieces as s

PATH = public_tokenizers.path(s.MODEL)
TEXTS = [
    "",
    " ",
    "   ",
    " a  b ",
    "line\n\n\tnext\r\n",
    "é \U0001f600\U0001f600 中文字 \x00 \x7f ﬁ½",
    "<s> </s> <unk> <0x41> [x]",
    "▁literal ▁▁",
    "x" * 300,
    "ab" * 150 + "  " * 20,
    "Über die Straße, señor; l'été 1234567890!!",
    "supercalifragilisticexpialidocious antidisestablishmentarianism",
]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return s.Vocabulary.load(PATH)


def test_ids_are_those_of_the_library(sp, vocabulary):
    encoder, decoder = s.Encoder(vocabulary), s.Decoder(vocabulary)
    rng = random.Random(1)
    drawn = ["".join(rng.choices("aeinrst ▁.\n-é0", k=rng.randint(1, 40))) for _ in range(2000)]
    pieces = list(vocabulary.ids)
    drawn += ["".join(rng.choices(pieces, k=4)) for _ in range(2000)]
    for text, ids in zip(TEXTS + drawn, encoder.encode(TEXTS + drawn)):
        assert ids.tolist() == sp.encode(text), repr(text)
        assert decoder.decode(ids.tolist()) == sp.decode(ids.tolist())
        assert decoder.decode(ids.tolist()) == text.replace("▁", " ")


def test_one_path_is_left(vocabulary):
    """By brute force over all cuts of short words."""
    encoder = s.Encoder(vocabulary)

    def cuts(word):
        if not word:
            yield []
        for i in range(1, len(word) + 1):
            if word[:i] in vocabulary.ids:
                for rest in cuts(word[i:]):
                    yield [word[:i], *rest]

    for word in ("▁there", "▁nations", "ofthed", "▁▁▁in", "ingly"):
        good = [
            c for c in cuts(word)
            if all(vocabulary.merged(p) == [p] for p in c)
            and all(vocabulary.merged(a + b) == [a, b] for a, b in zip(c, c[1:]))
        ]
        assert len(good) == 1
        path, ends, counts = encoder._viterbi([word])
        assert [vocabulary.pieces[i] for i in path] == good[0] == vocabulary.merged(word)
        assert counts.tolist() == [len(good[0])] and ends[-1] == len(word)


def test_forgetting_changes_nothing(sp, vocabulary, monkeypatch):
    monkeypatch.setattr(s, "REMEMBERED", 1)
    monkeypatch.setattr(s, "PAIRS", 2)
    monkeypatch.setattr(s, "TOGETHER", 2)
    encoder = s.Encoder(vocabulary)
    for _ in range(2):
        for text in TEXTS:
            assert encoder.encode([text])[0].tolist() == sp.encode(text)


def test_pairs_are_decided_as_by_merging(vocabulary):
    encoder, rng = s.Encoder(vocabulary), random.Random(2)
    ids = [i for p, i in vocabulary.ids.items() if len(p) < 9]
    a, b = (np.array(rng.choices(ids, k=5000), dtype=np.int64) for _ in range(2))
    near = [p for p in vocabulary.ids if len(p) > 1]
    cut = [(p, rng.randint(1, len(p) - 1)) for p in rng.choices(near, k=5000)]
    cut = [(vocabulary.ids.get(p[:i]), vocabulary.ids.get(p[i:])) for p, i in cut]
    cut = np.array([c for c in cut if None not in c], dtype=np.int64)
    a, b = np.concatenate([a, cut[:, 0], cut[:500, 0]]), np.concatenate([b, cut[:, 1], cut[:500, 0]])
    pieces = vocabulary.pieces
    want = [vocabulary.merged(pieces[x] + pieces[y]) == [pieces[x], pieces[y]] for x, y in zip(a, b)]
    for _ in range(2):
        assert encoder._allowed(a, b).tolist() == want
    assert 100 < sum(want) < len(want) - 100


@pytest.mark.parametrize(
    "alphabet", ["abcdefghijklmnopqrstuvwxyz", "的一是不了人我在有他这中大来上国", "x", "ab", "0123456789abcdef="]
)
def test_a_million_characters_without_a_space(sp, vocabulary, alphabet):
    rng = random.Random(4)
    text = "".join(rng.choices(alphabet, k=1_000_000))
    if len(alphabet) <= 2:
        text = "odd " + alphabet * (1_000_000 // len(alphabet))
    encoder = s.Encoder(vocabulary)
    start = time.process_time()
    ids = encoder.encode([text])[0]
    assert time.process_time() - start < 20
    assert ids.tolist() == sp.encode(text)


def test_tables(spark, sp):
    docs = spark.createDataFrame(
        [(i % 9, t, b"x") for i, t in enumerate([*TEXTS, None, "twice", "twice"])],
        "doc_id long, text string, ids binary",
    )
    got = s.encode(docs).collect()
    want = [(r.doc_id, np.array(sp.encode(r.text or ""), "<u4").tobytes()) for r in docs.collect()]
    assert sorted((r.doc_id, bytes(r.ids)) for r in got) == sorted(want)
    back = sorted(r.text for r in s.decode(s.encode(docs)).collect())
    assert back == sorted((r.text or "").replace("▁", " ") for r in docs.collect())
    assert s.round_trip(docs.limit(0)).count() == 0


def test_query_on_the_whole_table(spark, sp):
    d = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op7_sentence_pieces(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc, ids in zip(docs, sp.encode([r.text or "" for r in docs])):
        r, text = rows[doc.doc_id], doc.text or ""
        assert (r.n_ids, r.n_chars) == (len(ids), len(text))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r.text_sha256 == sha256(text.encode()).hexdigest()
