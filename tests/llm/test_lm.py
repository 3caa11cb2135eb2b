import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pricelens.llm import lm
from pricelens.llm.eliasfano import PARTS, EliasFano, Sequences, encode


def test_elias_fano_against_search():
    rng = np.random.default_rng(1)
    for n, top in ((0, 5), (1, 5), (10, 10), (1000, 10**6), (40_000, 10**9), (5, 2**40)):
        values = np.unique(rng.integers(0, top, n)).astype(np.uint64)
        sequence = EliasFano(encode(values))
        assert (sequence.access(np.arange(len(values))) == values).all()
        asked = np.concatenate([values, rng.integers(0, 2 * top, 50).astype(np.uint64)])
        place = {int(v): i for i, v in enumerate(values)}
        assert sequence.find(asked).tolist() == [place.get(int(x), -1) for x in asked]


def test_scores_against_counts(spark, make_docs):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["The", "the", "a", "b", "c,", "d\n", f"w{i}"], rng.integers(0, 30)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "a b"), (7, rows[7][1]), (502, "the " * 30_000)]
    got = lm.report(make_docs(rows)).collect()
    assert len(got) == len(rows)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    words, pairs = Counter(), Counter()
    for i, t in tokens:
        if not held[i]:
            words.update(t)
            pairs.update(zip([None, *t[:-1]], t, strict=True))
    n, v = sum(words.values()), len(words)
    by = {(r["doc_id"], r["n_tokens"]): r for r in got}
    for i, t in tokens:
        r = by[i, len(t)]
        assert (r["held_out"], r["train_tokens"], r["n_known"]) == (held[i], n, sum(words[w] > 0 for w in t))
        p = [(words[w] + 1) / (n + v + 1) for w in t]
        assert abs(r["base_score"] - sum(map(math.log10, p))) < 1e-6 * len(t)
        exact = sum(math.log10((pairs[u, w] + lm.MU * q) / (words[u] + lm.MU)) if words[u] else math.log10(q) for u, w, q in zip([None, *t[:-1]], t, p, strict=True))
        assert abs(r["score2"] - exact) < 0.02 * len(t)


def test_triples_against_counts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(lm, "TRIPLES_PER_RANGE", 300)  # several ranges
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "d", f"w{i}"], rng.integers(0, 30)))) for i in range(150)] + [(500, None), (501, "a b " * 20_000)]
    tokens = [(i, (t or "").split() + [None]) for i, t in rows]
    words, pairs, triples = Counter(), Counter(), Counter()
    for i, t in tokens:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            words.update(t)
            pairs.update(zip([None, *t], t, strict=False))
            triples.update(zip([None, *t], t, t[1:], strict=False))
    n, v = sum(words.values()), len(words)
    by = {r["doc_id"]: r for r in lm.report(make_docs(rows)).collect()}
    differs = 0
    for i, t in tokens:
        exact = 0.0
        for place, w in enumerate(t):
            p, u = (words[w] + 1) / (n + v + 1), t[place - 1] if place else None
            if words[u]:
                p = (pairs[u, w] + lm.MU * p) / (words[u] + lm.MU)
            two = (t[place - 2] if place > 1 else None, u)
            if place and pairs[two]:
                p = (triples[(*two, w)] + lm.MU * p) / (pairs[two] + lm.MU)
            exact += math.log10(p)
        assert abs(by[i]["score"] - exact) < 0.03 * len(t)
        differs += abs(by[i]["score2"] - exact) > 0.03 * len(t)
    assert differs > 50


def test_empty_parts(spark, make_docs):
    assert lm.report(make_docs([(1, "x")]).limit(0)).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm.report(make_docs([(alone, "x y")])).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"], row["score"]) == (0, 0, 0, 0)


def test_too_many_words_are_refused(make_docs, monkeypatch):
    monkeypatch.setattr(lm, "MOST_WORDS", 2)
    with pytest.raises(ValueError, match="32 bits"):
        lm.report(make_docs([(i, "a b c") for i in range(9)]))


def test_an_opened_sequence_keeps_no_memory_of_its_own():
    values = np.cumsum(np.random.default_rng(2).integers(0, 90, 50_000)).astype(np.uint64)
    opened = EliasFano(encode(values))
    mapped = {id(x) for x in (opened.high, opened.ones, opened.low_words)}
    present = np.unique(values)
    assert (values[opened.find(present)] == present).all() and (opened.access(np.arange(len(values))) == values).all()
    assert all(id(x) in mapped for x in vars(opened).values() if isinstance(x, np.ndarray))


def test_ranges_do_not_grow_with_the_corpus(make_docs, monkeypatch):
    monkeypatch.setattr(lm, "TRIPLES_PER_RANGE", 1)  # each range reads all ids
    stored, stage = [], lm.stage_table
    monkeypatch.setattr(lm, "stage_table", lambda df, name: stored.append(name) or stage(df, name))
    rows = [(i, f"a b c w{i} x{i % 7}") for i in range(60)]
    assert lm.report(make_docs(rows)).count() == len(rows)
    assert 1 < stored.count("lm_level3") <= 4


def test_lookups_do_not_go_shard_by_shard(make_docs, monkeypatch):
    monkeypatch.setattr(lm, "PAIRS_PER_SHARD", 300)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(40)], 60))) for i in range(200)] + [(None, "w1 w2 unseen"), (500, "w3 " * 2000)]
    trie, numbered = lm.train(lm.rows_of(make_docs(rows)))
    assert trie.pairs.shards == trie.triples.shards >= 32
    batch = numbered.select("_id", "ids").toArrow().combine_chunks().to_batches()[0]
    ids, sizes = lm.ids_of(batch)
    whole = trie.score(ids, sizes)
    calls, find = [], Sequences.find
    monkeypatch.setattr(Sequences, "find", lambda *args: calls.append(1) or find(*args))
    trie.score(ids, sizes)
    assert len(calls) <= 8
    monkeypatch.setattr(lm, "SCORED", 37)  # cuts within texts
    monkeypatch.setattr(lm, "ASKED", 5)
    cut = trie.score(ids, sizes)
    assert all(np.allclose(whole[name], cut[name], rtol=1e-12) for name in whole)


def test_sequences_in_one_space_against_search():
    rng = np.random.default_rng(7)
    lists = [np.sort(rng.integers(0, int(10 ** rng.uniform(0.5, 15)), int(rng.integers(1, 3000)))).astype(np.uint64) for _ in range(30)]
    lists += [np.zeros(500, np.uint64), np.repeat(np.array([3, 10**12], np.uint64), 400), np.zeros(0, np.uint64)]
    encoded = [encode(x) for x in lists]
    data, starts = [], []
    for arrays in encoded:
        row = []
        for part in PARTS:
            row.append(sum(map(len, data)) // arrays[part].itemsize)
            data.append(arrays[part].tobytes() + bytes(-arrays[part].nbytes % 8))
        starts.append(row)
    space = np.frombuffer(b"".join(data), np.uint64)
    half = space.view(np.uint32)
    together = Sequences([space, half, half, half, space], np.array([x["meta"] for x in encoded]), np.array(starts))
    s = rng.permutation(np.repeat(np.arange(len(lists) - 1), 60))
    i = np.array([rng.integers(0, len(lists[k])) for k in s])
    values = np.array([lists[k][j] for k, j in zip(s, i, strict=True)], np.uint64)
    assert (together.access(s, i) == values).all()
    inner = np.flatnonzero([j + 1 < len(lists[k]) for k, j in zip(s, i, strict=True)])
    assert together.steps(s[inner], i[inner]).tolist() == [int(lists[k][j + 1] - lists[k][j]) for k, j in zip(s[inner], i[inner], strict=True)]
    asked = np.where(rng.random(len(s)) < 0.5, values, values + rng.integers(0, 9, len(s)).astype(np.uint64))
    for found, k, x in zip(together.find(s, asked), s, asked, strict=True):
        assert (found >= 0) == (x in lists[k]) and (found < 0 or lists[k][found] == x)
    assert (together.find(len(lists) - 1, asked) == -1).all()


def test_shards_come_back_from_packed_rows():
    rng = np.random.default_rng(8)
    shard = np.sort(rng.integers(0, 9, 1000))
    columns = [rng.integers(0, 1 << 32, 1000, dtype=np.uint32) for _ in range(3)]
    got = list(lm.unpacked([lm.packed(shard, columns)], 3))
    assert [k for k, _ in got] == np.unique(shard).tolist()
    assert all((np.concatenate([c[j] for _, c in got]) == columns[j]).all() for j in range(3))


def test_keys_that_share_hash_bits_are_not_merged():
    key = np.array([5, 7, 5, 7, 7], np.uint32)
    same = np.zeros(5, np.uint64)
    one, place = lm.groups_of(same, key)
    assert (key[one][place] == key).all()
    which, counts = lm.summed(same, None, key)
    assert {k: int(counts[key[which] == k].sum()) for k in (5, 7)} == {5: 2, 7: 3}
    assert not lm.distinct(same[which], len(same))
