"""Decontamination, licences, quality and toxicity on odd rows."""

import numpy as np

from pyspark.sql import functions as F

from pricelens.llm import decontaminate, licenses, quality, toxicity

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
ODD = [(1, None), (2, ""), (3, "  \n\t "), (None, "x y"), (7, "a b"), (7, "a b"), (8, "long " * 30_000)]


def by_id(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def test_decontamination_cases(spark, make_docs):
    bench = spark.createDataFrame([(10, ITEM), (2, "short item"), (None, "null id here"), (5, None), (6, "")], "item_id long, text string")
    docs = make_docs([*ODD, (20, f"pre {ITEM.upper()}! post"), (21, "a SHORT-item b short item"), (22, "null id here"), (23, ITEM.replace("eta", "x"))])
    rows = {r["doc_id"]: r for r in decontaminate.report(docs, bench).collect()}
    assert decontaminate.report(docs, bench).count() == len(ODD) + 4
    assert (rows[20]["n_hit"], rows[20]["n_items"]) == (11, 1)
    assert (rows[21]["n_hit"], rows[21]["n_words"]) == (4, 6)
    assert rows[22]["contaminated"] and rows[22]["n_items"] == 1
    assert not rows[23]["contaminated"] and not rows[1]["contaminated"] and rows[1]["n_words"] == 0
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ODD) + 1
    spans = {r["doc_id"]: r["spans"] for r in decontaminate.contamination(docs, bench).collect()}
    assert [tuple(s) for s in spans[21]] == [(1, 2), (4, 2)]
    clean = {r["doc_id"]: r["clean_words"] for r in decontaminate.cut_spans(docs, bench).collect()}
    assert clean[20] == ["pre", "post"] and clean[21] == ["a", "b"]


def test_decontamination_in_blocks_and_empty(spark, make_docs, monkeypatch):
    bench = spark.createDataFrame([(i, f"{ITEM} w{i} v{i}") for i in range(9)], "item_id long, text string")
    docs = make_docs([(i, f"q {ITEM} w{i} v{i}") for i in range(9)] + [(99, None)])
    whole = by_id(decontaminate.report(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "MAX_WINDOWS", 4)
    assert by_id(decontaminate.report(docs, bench).collect()) == whole
    assert decontaminate.report(docs.limit(0), bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_decontamination_of_a_copied_benchmark(spark, make_docs):
    """Ten thousand copies of an item: the window table stays small, the items are still listed."""
    words = " ".join(f"w{i}" for i in range(12))
    copies = spark.range(10_000).select(F.concat(F.lit("i"), "id").alias("item_id"), F.lit(words).alias("text"))
    docs = make_docs([(1, f"a {words} b"), (2, "clean text"), (None, words)])
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, copies).collect()}
    assert len(found[1]["items"]) == len(found[None]["items"]) == 10_000 and found[2]["items"] == []
    assert (found[1]["n_hit"], found[None]["n_hit"], found[2]["n_hit"]) == (12, 12, 0)
    hits = decontaminate.window_hits(docs, copies)
    assert "item" not in hits.columns and hits.filter("pos > 0").count() == 6


def test_cut_spans_with_clashing_columns(spark, make_docs):
    words = " ".join(f"w{i}" for i in range(10))
    docs = make_docs([(1, f"a {words} b"), (2, "Clean"), (None, None)])
    docs = docs.withColumns({c: F.lit("own") for c in ("spans", "_words", "_id", "_k1", "row", "clean")})
    bench = spark.createDataFrame([("x", words)], "item_id string, text string")
    rows = {r["doc_id"]: r for r in decontaminate.cut_spans(docs, bench).collect()}
    assert rows[1]["clean_words"] == ["a", "b"] and rows[2]["clean_words"] == ["clean"] and rows[None]["clean_words"] == []
    assert all(r["spans"] == r["row"] == r["_id"] == "own" for r in rows.values())


def test_license_cases(make_docs):
    docs = make_docs(
        [
            *ODD,
            (20, "Released under the MIT License. under the mit license"),
            (21, "intro\nThis work is licensed under the GNU General Public License, version 3.\nend"),
            (22, "Permission is hereby granted, free of charge, to any person obtaining this software, a copy of"),
            (23, "the license of this work is not granted"),
            (24, "cc by nc cc by nc"),
        ]
    )
    rows = {r["doc_id"]: r for r in licenses.license_scan(docs).collect()}
    assert licenses.license_scan(docs).count() == len(ODD) + 5
    assert (rows[20]["n_base"], rows[20]["first_word"], rows[20]["last_word"], rows[20]["labels"]) == (2, 1, 5, "mit")
    assert (rows[21]["labels"], rows[21]["base_labels"], rows[21]["first_word"]) == ("gpl-3", "", None)
    assert rows[22]["labels"] == "mit" and 0.9 <= rows[22]["score"] <= 1
    assert rows[23]["labels"] == "" and rows[23]["score"] == 0
    assert (rows[24]["n_base"], rows[24]["last_word"]) == (2, 3)
    assert licenses.license_scan(docs.limit(0)).count() == 0


def test_license_join_is_exact(make_docs):
    rng = np.random.default_rng(3)
    sets = licenses.template_sets()
    words = sorted({w for _, t in sets for w in t})
    docs = [(i, " ".join(rng.choice(words, rng.integers(3, 60)))) for i in range(150)]
    docs += [(200 + i, " ".join(w for w in t if rng.random() < 0.93)) for i, (_, t) in enumerate(sets * 6)]
    for threshold in (0.7, 0.9):
        found = {(r["_id"], r["label"]) for r in licenses.matching_blocks(make_docs(docs), threshold=threshold).collect()}
        want = {
            (i, label) for i, text in docs for label, t in sets
            if len(set(text.split()) & set(t)) >= licenses.needed(len(t), threshold)
        }
        assert found == want


def test_wrapped_license_notices(make_docs):
    docs = make_docs(
        [
            (1, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"),
            (2, "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that"),
            (3, "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License"),
            (4, "permission is hereby granted\n" + "and so on " * 40 + "\nfree of charge to any person\n" + "x " * 90 + "\nobtaining a copy of this software"),
            (5, "Released\nunder the\n\nMIT License."),
            (6, None),
            (7, " ".join(x for w in licenses.template_words(licenses.TEMPLATES[1][0]) for x in [w, *["far"] * 60])),
            (8, "prose " * 200 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software" + " prose" * 200),
        ]
    )
    rows = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.license_scan(docs).collect()}
    assert rows[1][0] == "mit" and rows[2][0] == "bsd" and rows[3][0] == "gpl"
    assert rows[1][1] == rows[2][1] == rows[3][1] == 1
    assert rows[4] == ("", 0)  # all words of a notice, but scattered over the lines
    assert rows[5][0] == "mit" and rows[6] == ("", 0)
    assert rows[7] == ("", 0)  # and over one long line
    assert rows[8] == ("mit", 1)


def test_quality_cases(spark, make_docs):
    rng = np.random.default_rng(1)
    good = [" ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)) for _ in range(60)]
    docs = make_docs(
        [(i, t, "en", f"src{i % 3}") for i, t in enumerate(good)]
        + [(100 + i, "SALE!! " * 20 + good[i], "en", f"src{i % 3}") for i in range(30)]
        + [(200, None, None, None), (201, ""), (202, "x" * 100_000)]
    )
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(20)] + [(5, None, 1)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality.report(docs, labels).collect()}
    assert len(rows) == 93
    assert all(rows[i]["keep"] for i in range(60)) and not any(rows[100 + i]["keep"] for i in range(30))
    assert all(0 < r["path_posterior"] < 1 for r in rows.values())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["keep"]}
    assert quality.report(docs, labels.limit(0)).filter("keep").count() == 93
    assert quality.report(docs.limit(0), labels).count() == 0


def test_site_shrinkage(spark):
    sums = spark.createDataFrame([("a", "x", 0.9)] * 50 + [("b", "x", 0.1)] * 50 + [("c", "x", 0.1)], "_host string, _path string, _p double")
    sites, mean = quality.posteriors(sums)
    rows = {r["_site_host"]: r for r in sites.collect()}
    assert abs(mean - (50 * 0.9 + 51 * 0.1 + 1) / 103) < 1e-12
    host = {h: (r["_k_host"] * mean + r["_hs"]) / (r["_k_host"] + r["_hn"]) for h, r in rows.items()}
    assert host["b"] < host["c"] < mean < host["a"]  # the sparse site stays nearer to the mean


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    n, k = 3000, 4
    x = rng.random((n, k)) < 0.3
    linear = x @ np.array([2.0, 1.0, 0.0, -1.0]) + rng.logistic(size=n)
    grades = (linear > 0.5).astype(int) + (linear > 2.0)
    rows, cols = np.nonzero(x)
    weights, cuts = toxicity.fit_ordinal(rows, cols, np.ones(len(rows)), grades, k, 3)
    assert np.abs(weights - [2, 1, 0, -1]).max() < 0.3 and np.abs(cuts - [0.5, 2.0]).max() < 0.3
    assert cuts[0] < cuts[1]


def test_toxicity_cases(spark, make_docs):
    rng = np.random.default_rng(2)
    plain = [" ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(30)) for _ in range(400)]
    rows = [(i, t + (" nasty. vileword1" if i % 4 == 0 else "") + (" nasty nasty" if i % 8 == 0 else "")) for i, t in enumerate(plain)]
    docs = make_docs([*rows, (1000, None), (1001, ""), (1002, "clean " * 50_000), (1002, "clean " * 50_000)])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)] + [(3, 1, None)], "doc_id long, quality int, toxic int")
    found = toxicity.report(docs, labels).collect()
    assert len(found) == 404
    by = {r["doc_id"]: r for r in found}
    assert all(by[i]["toxic"] == (i % 4 == 0) for i in range(400))  # 100 of them not labelled
    assert all(by[i]["grade"] == 2 for i in range(0, 400, 8))
    assert not by[1000]["toxic"] and by[1000]["n_words"] == 0 and all(0 <= r["severity"] <= 2 for r in found)
    assert toxicity.report(docs, labels.limit(0)).count() == 404
    assert toxicity.report(docs.limit(0), labels).count() == 0


def test_rare_toxic_words_with_few_labels(spark, make_docs):
    """A word of five flagged texts has a weight; thousands of plain words do not drown it."""
    rng = np.random.default_rng(6)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(30)) for _ in range(120)]
    docs = make_docs([(i, t + (" rarevile" if i < 10 else "")) for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, int(i < 5)) for i in range(5)] + [(i, 1, 0) for i in range(10, 100)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r["toxic"] for r in toxicity.report(docs, labels).collect()}
    assert all(found[i] == (i < 10) for i in range(120))


def test_held_out_flags(spark):
    """Half of the labels are for the fit, the others for the figures."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.fit(docs, labels.filter(half))
    scored = toxicity.score(docs, model).join(labels.filter(~half).withColumnRenamed("toxic", "flag"), "doc_id").toPandas()
    flagged = scored["flag"] > 0
    assert flagged.sum() > 5 and scored[flagged]["toxic"].mean() >= 0.65 and scored[~flagged]["toxic"].mean() <= 0.02
