import hashlib

import numpy as np
import pytest

from pricelens.llm import induced, jaccard, suffix

RNG = np.random.default_rng(5)


def prose(n):
    return [f"w{x}" for x in RNG.integers(0, 5000, n)]


def brute_components(docs):
    sets = []
    for _, text in docs:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    part = list(range(len(docs)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                part[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d[0], len(s), least.get(find(i)) if s else d[0]) for i, (d, s) in enumerate(zip(docs, sets, strict=True))]


def copies(base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(RNG.integers(0, edits + 1)):
            words[RNG.integers(len(words))] = f"e{RNG.integers(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("frequent", [64, 2])
def test_join_against_brute_force(spark, make_docs, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 4)
    line = " ".join(prose(12))
    texts = copies(prose(120), 60, 6) + copies(prose(30), 20, 2) + [f"{line} {' '.join(prose(20))}" for _ in range(30)] + [" ".join(prose(7))] * 5
    texts += [" ".join(prose(k)) for k in (1, 2, 3, 4, 4, 5, 6)] + ["One two", "one  TWO", "x " * 20_000, "X\n" * 20_000]
    docs = [*enumerate(texts), (900, None), (901, ""), (902, " \n"), (None, texts[0]), (None, "only null ids"), (3, texts[3]), (4, texts[90])]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.report(make_docs(docs)).collect()]
    assert sorted(got, key=str) == sorted(brute_components(docs), key=str)


def test_keep_one(make_docs):
    base = prose(100)
    docs = make_docs([(5, " ".join(base)), (3, " ".join(base).upper()), (9, " ".join([*base, "end"])), (7, None), (8, "other words here"), (None, "no id")])
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 7, 8]
    assert jaccard.report(docs.limit(0)).count() == 0 and jaccard.keep_one(docs.limit(0)).count() == 0


def test_induced_order_and_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(150):
        n, letters, depth = int(rng.integers(1, 80)), int(rng.choice([1, 2, 3, 5])), int(rng.choice([3, 8, 20, 200]))
        text = rng.integers(1, letters + 1, n)
        text[rng.random(n) < (0.1 if trial % 3 == 0 else 0)] = 0
        if n > 10:
            text[n // 2 : n // 2 + n // 3] = text[: n // 3]
        text = np.append(text, 0).astype(np.uint16)
        parts = list(induced.sorted_suffixes(text, depth, memory=int(rng.choice([0, 100, 1 << 20]))))
        at, prefix = (np.concatenate(x) for x in zip(*parts, strict=True))
        suffixes = [tuple(text[i : i + depth].tolist()) for i in at]
        assert sorted(at.tolist()) == list(range(len(text)))
        assert all(a >= b for a, b in zip(suffixes, suffixes[1:], strict=False))
        for j in range(1, len(at)):
            a, b = text[at[j - 1] :], text[at[j] :]
            m = min(len(a), len(b), depth)
            differ = np.flatnonzero(a[:m] != b[:m])
            assert prefix[j] == (differ[0] if len(differ) else m)


def brute_removed(texts):
    seen, out = {}, []
    for i, b in enumerate(texts):
        for p in range(len(b) - 199):
            seen.setdefault(b[p : p + 200], []).append((i, p))
    covered = [np.zeros(len(b), bool) for b in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                covered[i][p : p + 200] = True
    for b, c in zip(texts, covered, strict=True):
        kept = np.frombuffer(b, np.uint8)[~c].tobytes()
        runs = int((np.diff(np.concatenate([[0], c.astype(np.int8)])) == 1).sum())
        out.append((len(b), int(c.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_against_brute_force(make_docs):
    passage, other = " ".join(prose(60)), " ".join(prose(45))
    whole = " ".join(prose(150))
    texts = [f"{' '.join(prose(40))} {passage} {' '.join(prose(30))}" for _ in range(12)]
    texts += [f"{passage[: 150 + k]} {' '.join(prose(20))}" for k in range(0, 120, 7)]
    texts += [whole, whole, whole[37:], whole + "é", other + " mid " + other, "ab" * 300, "a" * 700, "a" * 199, "a" * 200, "", "é" * 250]
    texts += copies(whole.split(" "), 8, 3)
    docs = [*enumerate(texts), (500, None), (None, passage), (2, texts[2])]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.report(make_docs(docs)).collect())
    want = brute_removed([(t or "").encode() for _, t in docs])
    assert got == sorted((str(i), *w) for (i, _), w in zip(docs, want, strict=True))


def test_remove_repeats(make_docs):
    passage = " ".join(prose(60))
    docs = make_docs([(1, f"first {passage} tail"), (2, f"second {passage}"), (3, None), (4, "plain")])
    cut = suffix.remove_repeats(docs)
    assert cut.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert passage[5:] not in left[1] and left[1].startswith("first") and left[1].endswith("tail") and left[4] == "plain" and left[3] is None
    assert suffix.report(docs.limit(0)).count() == 0


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(5)
    for n, m, common in ((3, 2, 1), (40, 45, 38), (500, 620, 480), (64, 65, 64), (1000, 1250, 0)):
        both = np.unique(rng.integers(0, 1 << 63, n + m - common, dtype=np.uint64))
        one, two = both[:n], both[n - common :]
        least = jaccard.least_difference(jaccard.parity(one), jaccard.parity(two))
        assert least <= len(one) + len(two) - 2 * common
    assert jaccard.least_difference(jaccard.parity(one), jaccard.parity(one)) == 0 and least > (1000 + 1250) // 9


def test_a_shared_passage_makes_no_pairs_to_test(spark, make_docs, monkeypatch):
    """60 texts that share a passage and nothing else, too few for the passage to be frequent beforehand."""
    passage = [f"p{i}" for i in range(20)]
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(15)] + passage + [f"b{i}x{j}" for j in range(15)])) for i in range(60)]
    tested = []
    verified = jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda classes, sets, pairs, percent: tested.append(pairs.count()) or verified(classes, sets, pairs, percent))
    assert {r.doc_id: r.component_id for r in jaccard.report(make_docs(rows)).collect()} == {i: i for i in range(60)}
    assert sum(tested) == 0
