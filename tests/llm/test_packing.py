import zlib

import numpy as np

from pricelens.llm import packing


def test_evolve_keeps_every_piece_and_beats_no_seed():
    rng = np.random.default_rng(0)
    for _ in range(4):
        counts = np.zeros(101, np.int64)
        np.add.at(counts, rng.integers(1, 100, 300), 1)
        first = packing.best_fit({}, counts, 100)
        best = packing.evolve([], counts, 100, 1)
        for packed in (first, best):
            used = np.zeros(101, np.int64)
            for pattern, n in packed.items():
                assert sum(pattern) <= 100
                for x in pattern:
                    used[x] += n
            assert (used == counts).all()
        assert packing.bins(best) <= packing.bins(first)


def test_genetic_search_improves_on_best_fit():
    counts = np.zeros(1001, np.int64)
    for x in (510, 490, 340, 330, 260, 250, 240, 80):
        counts[x] = 40
    rounds = packing.evolve([], counts, 1000, 3, generations=30)
    assert packing.bins(rounds) <= packing.bins(packing.best_fit({}, counts, 1000))


def test_encoder_equals_tokenizer():
    encoder = packing.Encoder(packing.tokenizer_file())
    texts = ["", " ", "a  b", "x\n\ny", " a", "it's $5.00\tok", "a b c", "<|endoftext|> x", "don't\nI'll 3rd x_y — ünï 日本 ² ½ ٣", "x\x1cy", "\U0001f600 hi", "we're w. (x) 'q' a... $$$ l'été x%y% b, '", "n\n a", "a \nb", "a\n"]
    for text in texts:
        assert encoder.encode(text) == encoder.whole(text), text


def check(rows, docs, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    assert sum(r["piece"] == 0 for r in rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], {})[r["piece"]] = r
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = [by[doc_id][k] for k in sorted(by[doc_id])]
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == capacity for r in own[1:])
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pack_cases(spark, make_docs):
    docs = [(i, "word " * (i % 40)) for i in range(200)] + [(300, None), (301, ""), (None, "x"), (302, "many words here " * 2000), (5, "word " * 5), (5, "word " * 5)]
    rows = packing.pack(make_docs(docs)).collect()
    n = check(rows, docs, 1024)
    assert n == -(-sum(r["length"] for r in rows) // 1024)
    assert packing.pack(make_docs(docs).limit(0)).count() == 0
