"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

The model is P(grade >= j | x) = sigmoid(w.x - t_j): one weight vector shared by
all thresholds t_1 < t_2 < ..., which are kept in order by adding up positive
gaps. Features are words and word beginnings (``PREFIXES`` letters and a star) whose
presence differs between graded and clean labelled texts, so that inflected forms
share a weight; a feature is 1 + ln(count). The fit reads a bounded sample of labelled
texts (``SAMPLE_ROWS``, taken by a hash of the id). Every term of it that is in
``LEAST_TEXTS`` texts or more, and whose presence differs by more than chance would
(``LEAST_G2``: one term in ten thousand), is a feature, however many there are; a word
in five flagged texts and no clean one is, unless half of all texts are flagged. Scoring
reads whole texts of all documents, row by row, without a shuffle.

``labels`` has a flag, not a grade. ``report`` grades flagged texts by the marks
they hold, a mark being a use of a word that flagged texts hold far more often
than clean ones: 2 (severe) from ``SEVERE_MARKS`` on, else 1.

Defined cases: a NULL or empty text has no features and the base probability of
its grade. Label rows without a flag are left out. With labels of one kind or
none, every text gets the smoothed shares of the grades. Repeated rows are scored
once each; ties do not occur. An empty table gives an empty result. Only the
named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.text import alnum_words
from pricelens.session import stage_table

SAMPLE_ROWS = 20_000
PREFIXES = (4, 5)
LEAST_TEXTS = 5
#: Least likelihood-ratio statistic of a word's presence against the flag.
LEAST_G2 = 15.0
#: Log-odds of presence from which a word counts as a mark.
MARK_LOG_ODDS = 3.0
SEVERE_MARKS = 3
L2 = 1e-4
ROUNDS = 400


@dataclass
class OrdinalModel:
    words: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, linear: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j from 1, a column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - linear[:, None], -500, 500)))


# --- features ----------------------------------------------------------------

_SPACES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c) in string.digits + string.ascii_lowercase else 32 for c in range(256)
)


def plain_words(text: str | None) -> list[str]:
    """The words of ``text.alnum_words``."""
    spaced = (text or "").encode("utf-8", "replace").translate(_SPACES)
    return [w for w in spaced.decode().split(" ") if w]


def terms(words: Column) -> Column:
    """Words and their beginnings."""
    longer = F.filter(words, lambda w: F.length(w) > max(PREFIXES))
    return F.concat(words, *[F.transform(longer, beginning(n)) for n in PREFIXES])


def beginning(n: int) -> Callable[[Column], Column]:
    """A word's first ``n`` letters and a star; ``transform`` would give a second parameter the word's place."""
    return lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))


def used_terms(words: list[str], place: dict[str, int]) -> dict[int, int]:
    """How often each term of the model occurs among the words."""
    found: Counter[int] = Counter()
    for word, n in Counter(words).items():
        if word in place:
            found[place[word]] += n
        if len(word) > max(PREFIXES):
            for k in PREFIXES:
                if (start := f"{word[:k]}*") in place:
                    found[place[start]] += n
    return dict(sorted(found.items()))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, label_col: str) -> DataFrame:
    """Words and flag of the different texts among ``rows`` labelled ones, stored.

    A text that was copied counts once, so that its words do not pass for typical.
    """
    known = labels.select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("_flag")).filter("_flag is not null")
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "_flag").limit(rows)
    texts = docs.select(F.col(id_col).alias("_doc"), F.col("text"))
    joined = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    words = joined.select("_flag", alnum_words(F.col("text")).alias("_w"))
    once = words.groupBy(F.xxhash64("_w").alias("_k")).agg(F.max("_flag").alias("_flag"), F.any_value("_w").alias("_w"))
    return stage_table(once.drop("_k"), "toxicity_sample")


def telling_words(sample: DataFrame) -> list[tuple[str, float]]:
    """Terms of the bounded sample by how much their presence tells about the flag, with log-odds."""
    flagged, n = sample.agg(F.coalesce(F.sum("_flag"), F.lit(0)), F.count("*")).first()
    if flagged in (0, n):
        return []
    per_word = (
        sample.select("_flag", F.explode(F.array_distinct(terms(F.col("_w")))).alias("w"))
        .groupBy("w")
        .agg(F.sum("_flag").alias("a"), F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_TEXTS)
    )
    a, c = F.col("a").cast("double"), (F.col("n") - F.col("a")).cast("double")
    b, d = flagged - a, n - flagged - c
    odds = F.ln((a + 0.5) / (b + 0.5)) - F.ln((c + 0.5) / (d + 0.5))

    def part(seen, row, column):
        return F.when(seen > 0, seen * F.ln(seen * n / (row * column))).otherwise(0.0)

    g2 = 2 * (part(a, a + c, F.lit(flagged)) + part(b, b + d, F.lit(flagged)) + part(c, a + c, F.lit(n - flagged)) + part(d, b + d, F.lit(n - flagged)))
    scored = per_word.select("w", odds.alias("odds"), g2.alias("g2")).filter(F.col("g2") >= LEAST_G2)
    return [(r.w, r.odds) for r in scored.orderBy(F.desc("g2"), "w").collect()]


# --- fit ---------------------------------------------------------------------


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, rounds: int = ROUNDS, l2: float = L2):
    """Weights and ordered thresholds by accelerated gradient descent.

    ``rows``, ``cols`` and ``values`` are the nonzero features. A gap between two
    thresholds is the exponential of a free parameter, so order holds throughout.
    """
    n, k = len(grades), n_grades - 1
    share = np.array([(grades >= j).sum() + 1 for j in range(1, n_grades)]) / (n + 2)
    start = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(k))
    free = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, rounds + 1):
        w, cuts = free[:n_features], free[n_features] + np.concatenate([[0], np.cumsum(np.exp(free[n_features + 1 :]))])
        linear = np.bincount(rows, values * w[cols], minlength=n)
        upper = np.column_stack([np.ones(n), 1 / (1 + np.exp(np.clip(cuts[None, :] - linear[:, None], -500, 500))), np.zeros(n)])
        own = np.maximum(upper[np.arange(n), grades] - upper[np.arange(n), grades + 1], 1e-12)
        slope = upper * (1 - upper)  # with respect to linear; minus that for the cut
        toward = (slope[np.arange(n), grades] - slope[np.arange(n), grades + 1]) / own
        by_cut = np.zeros(k)
        for j in range(1, n_grades):
            by_cut[j - 1] = (slope[grades == j, j] / own[grades == j]).sum() - (slope[grades == j - 1, j] / own[grades == j - 1]).sum()
        gradient = np.empty_like(free)
        gradient[:n_features] = -np.bincount(cols, values * toward[rows], minlength=n_features) / n + l2 * w
        gradient[n_features] = by_cut.sum() / n
        gradient[n_features + 1 :] = np.cumsum(by_cut[::-1])[::-1][1:] / n * np.exp(free[n_features + 1 :])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        free = free - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return free[:n_features], free[n_features] + np.concatenate([[0], np.cumsum(np.exp(free[n_features + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Learn words, marks, grades and the ordinal model from the labelled sample."""
    sample = labelled_sample(docs, labels, sample_rows, id_col, label_col)
    chosen = telling_words(sample)
    place = {w: i for i, (w, _) in enumerate(chosen)}
    marks = {i for i, (_, odds) in enumerate(chosen) if odds >= MARK_LOG_ODDS}

    def counts(batches):
        for batch in batches:
            flags, texts = batch.column("_flag").to_pylist(), batch.column("_w").to_pylist()
            found = [used_terms(words, place) for words in texts]
            yield pa.RecordBatch.from_pydict(
                {"flag": flags, "i": [[*f] for f in found], "n": [[*f.values()] for f in found]},
                pa.schema([("flag", pa.int32()), ("i", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]),
            )

    table = sample.mapInArrow(counts, "flag int, i array<int>, n array<int>").toPandas()  # SAMPLE_ROWS at most
    n = len(table)
    sizes = np.array([len(x) for x in table["i"]], dtype=np.int64)
    rows = np.repeat(np.arange(n), sizes)
    cols = np.concatenate([*table["i"], []]).astype(np.int64)
    uses = np.concatenate([*table["n"], []]).astype(np.float64)
    marked = np.bincount(rows, uses * np.isin(cols, list(marks)), minlength=n)
    grades = np.where(table["flag"].to_numpy(dtype=np.int64) > 0, 1 + (marked >= SEVERE_MARKS), 0).astype(np.int64) if n else np.zeros(0, np.int64)
    if not place:
        share = np.array([((grades >= j).sum() + 1) / (n + 2) for j in (1, 2)])
        cuts = np.maximum.accumulate(np.log((1 - share) / share))
        return OrdinalModel(place, np.zeros(0), cuts)
    weights, cuts = fit_ordinal(rows, cols, 1 + np.log(uses), grades, len(place), 3)
    return OrdinalModel(place, weights, cuts)


# --- scoring -----------------------------------------------------------------


def linear_score(words: list[str], model: OrdinalModel) -> float:
    return float(sum(model.weights[i] * (1 + np.log(n)) for i, n in used_terms(words, model.words).items()))


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the chance of each grade or more, and what follows."""
    names = [f"p_grade_{j}" for j in range(1, len(model.thresholds) + 1)]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def grade(batches):
        for batch in batches:
            words = [plain_words(t) for t in batch.column("_text").to_pylist()]
            chance = model.at_least(np.array([linear_score(w, model) for w in words]))
            columns = [batch.column("_id"), pa.array([len(w) for w in words], pa.int64())]
            columns += [pa.array(chance[:, j]) for j in range(chance.shape[1])]
            columns += [pa.array(chance.sum(axis=1)), pa.array((chance >= 0.5).sum(axis=1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n_words", *names, "severity", "grade"])

    schema = f"_id {id_type}, n_words long, {', '.join(f'{n} double' for n in names)}, severity double, grade int"
    scored = rows.mapInArrow(grade, schema)
    return scored.select(F.col("_id").alias(id_col), "n_words", *names, "severity", "grade", (F.col("grade") >= 1).alias("toxic"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled sample and score every document."""
    return score(docs, fit(docs, labels))
