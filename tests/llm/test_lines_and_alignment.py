"""Line dedup and token alignment against plain Python; the minimal perfect hash."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pricelens.llm import align, lines, mph
from pricelens.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- minimal perfect hash ------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 65, 5000])
def test_places_are_a_permutation(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 50, n).astype(np.uint64), np.arange(n, dtype=np.uint64)
    hashed = mph.build(high, low)
    assert sorted(mph.places(hashed, high, low).tolist()) == list(range(n))
    assert hashed["words"].nbytes * 8 < 5 * n + 2000
    foreign = mph.places(hashed, high, low + np.uint64(1 << 40))
    assert (foreign >= -1).all() and (foreign < max(n, 1)).all()


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="distinct"):
        mph.build(np.ones(2, np.uint64), np.ones(2, np.uint64))


# --- line dedup ------------------------------------------------------------------


def sifted(texts, min_docs=10, min_chars=1):
    def key(line):
        kept = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in kept)

    split = [(t or "").split("\n") for t in texts]
    counts = Counter(k for part in split for k in {key(x) for x in part})
    return [[x for x in part if len(key(x)) < min_chars or counts[key(x)] < min_docs] for part in split], split


def test_lines_of_whole_tables(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    kept, split = sifted([r.text for r in rows])
    want = {r.doc_id: (len(s), len(s) - len(k), sha("\n".join(k))) for r, k, s in zip(rows, kept, split, strict=True)}
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op11_line_dedup"](spark, small_dir).collect()}
    assert found == want and any(x[1] for x in want.values())


CASES = [
    None, "", "\n", "Menu\nown 1", "menu \r\nown 2", "\tMENU\x0b", "Menu", "own 3\n\n\nmenu\nmenu", "é\nÉ", "é", "é", "É",
    "x" * 300_000 + "\nmenu", "a ", "a", " a", "ab", "ab", "ab",
]


@pytest.mark.parametrize(("min_docs", "min_chars"), [(3, 1), (3, 2), (1, 1), (2, 0)])
def test_lines_defined_cases(make_docs, monkeypatch, min_docs, min_chars):
    monkeypatch.setattr(lines, "FLUSH_KEYS", 3)
    texts = CASES * 2 if min_docs == 3 else CASES
    docs = make_docs([(i if i else None, t) for i, t in enumerate(texts)])
    found = {r.doc_id: r for r in lines.drop_lines(docs, min_docs, min_chars).collect()}
    kept, _ = sifted(texts, min_docs, min_chars)
    for i, (text, want) in enumerate(zip(texts, kept, strict=True)):
        row = found[i if i else None]
        assert row.text == (None if text is None else "\n".join(want)), i
        assert (row.n, row.k, row.source) == ("x", "x", "src0")
    assert lines.drop_lines(docs.limit(0)).columns == docs.columns


def test_lines_over_many_shards(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "shard_count", lambda n: 7)
    texts = [f"shared {i % 40}\nown {i}\nshared {i % 7}" for i in range(300)]
    rows = lines.report(make_docs(list(enumerate(texts))), 10).collect()
    kept, _ = sifted(texts)
    assert {r.doc_id: r.kept_sha256 for r in rows} == {i: sha("\n".join(k)) for i, k in enumerate(kept)}


def test_empty_tables(make_docs):
    none = make_docs([(1, "a")]).limit(0)
    assert lines.report(none).count() == 0 and align.report(none).count() == 0


# --- alignment -------------------------------------------------------------------


def byte_ranges(parts):
    at, found = 0, []
    for x in parts:
        found.append((at, at + len(x)))
        at += len(x)
    return found


def brute(texts):
    """Alignment of whole texts by the definition, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    from pricelens.llm.packing import byte_letters, tokenizer_file

    a = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    letters = {v: k for k, v in byte_letters().items()}
    entries = {v: k for k, v in a.get_vocab().items()}
    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts_a = [bytes(letters[c] for c in entries[i]) for i in ids_a]
        parts_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        whole = (" " + text).encode()
        if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            docs.append(None)
            continue
        ra, rb = byte_ranges(parts_a), byte_ranges(parts_b)
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups = []
        for low, high in zip([0, *ends], ends, strict=False):
            groups.append(
                ",".join(str(i) for i, (s, e) in zip(ids_a, ra, strict=True) if low < e <= high)
                + "|" + ",".join(str(i) for i, (s, e) in zip(ids_b, rb, strict=True) if low < e <= high)
            )
        links = [(i, j) for i, (s, e) in zip(ids_a, ra, strict=True) for j, (u, v) in zip(ids_b, rb, strict=True) if s < v and u < e]
        docs.append((len(ids_a), len(ids_b), groups, links))
    counts = Counter(x for d in docs if d for x in d[3])
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        top = sum(counts[x] == best[x[1]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), top, sum(counts[x] for x in links), sha(";".join(groups))))
    return out


TEXTS = [
    None, "", " ", "plain words here", "plain  two spaces", "tab\there", "a\nb\n\nc", "line one\nline two, (quoted) \"x\"", "naïve café — 東京 🙂 ok",
    "<|endoftext|> and <s> </s> <0x41>", "▁lower", "é combining", "ends ", " starts", "word\n", "\nword", "don't we'll I'm",
    "123 4567 89.01", "x" * 3000, " nbsp", "a　b", "﻿bom", "\x00zero", "camelCaseWords andSo_on", "plain words here",
    "​zero width", "ﬁ ligature", "wörter größer straße", "слова на русском", "ab\rcd", "(((]]]", "!? ... --", "a b",
]


def as_rows(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r.doc_id: tuple(r[c] for c in names) for r in df.collect()}


def test_alignment_defined_cases(make_docs):
    found = as_rows(align.report(make_docs(list(enumerate(TEXTS)))))
    assert found == dict(enumerate(brute(TEXTS)))


def test_alignment_over_shards_slices_and_a_tree(make_docs, monkeypatch):
    monkeypatch.setattr(align, "FAN", 2)
    docs = make_docs(list(enumerate(TEXTS))).repartition(6)
    counts = align.count_pairs(docs, shard_keys=40, slice_rows=20)
    assert counts.index.shards > 3
    assert as_rows(align.aligned(docs, counts)) == dict(enumerate(brute(TEXTS)))


def test_alignment_of_whole_tables(spark, small_dir):
    rows = [r for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect() if len(r.text or "") < 4000]
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string").repartition(4)
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows]), strict=True))
    assert as_rows(align.report(docs)) == want
    assert as_rows(QUERIES["op12_alignment"](spark, small_dir)).keys() >= want.keys()
