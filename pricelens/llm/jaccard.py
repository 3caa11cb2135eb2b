"""N-gram Jaccard join by vertical partitioning, up to connected components.

A document's set holds the 64-bit hashes of its distinct ``SHINGLE``-word runs.
Documents with equal sets form a class; the join works on classes.

Candidates. The global n-gram order goes by hash, with frequent n-grams moved to the
end, the rarer first. Two sets with a Jaccard similarity of t or more share an
n-gram among the first ``n - ceil(t n) + 1`` of each, whatever the order; so only
these prefixes are compared. Classes that share a prefix n-gram form a bucket. A task
emits each class once, however many copies it meets, and sorted partitions are read as
a stream: a bucket of one class drops out, one of at most ``SMALL_BUCKET`` classes
gives its pairs there and then, distinct ones only, and rows of larger buckets pass
through. The first shared n-gram's places bound the overlap (position filter).

Order in rounds. Two classes that share a prefix n-gram of a small bucket are a pair by
then; all others that may link meet in larger buckets only. So the n-grams of these
buckets move to the end of the order as well, and the prefixes of their classes alone
are cut and compared anew, ``ORDER_ROUNDS`` times. A passage that many texts share
leaves their prefixes; what stays in large buckets are groups of near copies.

Parity filter. A class has a bit string of 2 n bits or more: each tells whether an odd
number of its n-grams falls on it. Two strings differ in no more bits than their sets
differ in n-grams, so pairs that differ in too many go before any set is read.

No pair need be tested within a component. So the pairs of small buckets are tested in
rounds: in each of ``NEAREST_ROUNDS``, every class is paired with one neighbour in
another component, the one of the least hash, which is the same for many classes; then
come the pairs that are still open. A group of near copies is joined up by a few tests
per class. Larger buckets are thinned by hubs: ``HUBS`` members are paired with the
others, and only pairs across the components found stay open. After ``HUB_ROUNDS`` all
pairs still open are generated, so that none is lost.

Verification. The n-gram order is cut into ``FRAGMENTS`` vertical fragments, and a
candidate's set into segments. Overlaps are counted fragment by fragment and summed
per pair, which is exact. The first fragment is counted alone: what it holds and what
the others can add at most decides for most candidates, and only pairs that may still
link have the other fragments cut and counted.

Tables of a step go when the next one is stored.

Defined cases: a text without words (NULL, empty or white space only) has the empty
set and is linked with nothing. With fewer than ``SHINGLE`` words the whole sequence
is the one n-gram. Rows with equal sets are linked at any size. A NULL id is never
the smallest; a component of NULL ids has component NULL. Repeated rows are
returned once each. An empty table gives an empty result. Only the named columns
are read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.graph import components
from pricelens.llm.hashing import chunks, mix, shingle_hashes, word_hashes
from pricelens.llm.text import text_rows
from pricelens.session import stage_table
from pricelens.storage import storage

SHINGLE = 5
#: Similarity in hundredths, so that the test is exact in whole numbers.
PERCENT = 80
FRAGMENTS = 8
SMALL_BUCKET = 16
HUBS, HUB_ROUNDS = 8, 2
NEAREST_ROUNDS = 2
ORDER_ROUNDS = 2
#: An n-gram is frequent if it occurs ``LOCAL`` times or more in some groups of about
#: ``GROUP_BYTES`` bytes of text, and ``FREQUENT`` times in these together; of these, at
#: most ``MOST_FREQUENT`` of the most frequent go last in the order. Any choice gives the
#: same result.
LOCAL, FREQUENT, GROUP_BYTES, MOST_FREQUENT = 3, 64, 4 << 20, 500_000
#: Candidate rows (16 bytes each) that may be broadcast to the text scan.
BROADCAST_ROWS = 1_000_000


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE):
    """The sorted distinct n-gram hashes of each text."""
    words, sizes = word_hashes(texts)
    ends = np.cumsum(sizes)
    for end, size in zip(ends, sizes, strict=True):
        yield np.unique(shingle_hashes(words[end - size : end], shingle))


def set_key(shingles: np.ndarray) -> int:
    """64 bits that tell sets apart."""
    return int(mix(np.array([mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])).view(np.int64)[0])


def parity(shingles: np.ndarray) -> bytes:
    """Of 2 n places or more, a power of two: whether an odd number of n-grams falls on each."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    return np.packbits(np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def least_difference(one: bytes, two: bytes) -> int:
    """Places at which two parities differ, the longer one folded to the shorter: the sets differ in so many n-grams at least."""
    a, b = sorted((one, two), key=len)
    while len(b) > len(a):
        half = len(b) // 2
        b = (int.from_bytes(b[:half]) ^ int.from_bytes(b[half:])).to_bytes(half)
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


class Order:
    """The global n-gram order: by hash, then the frequent ones by rising count."""

    def __init__(self, frequent: list[tuple[int, int]]):
        self.frequent = frequent
        known = np.array(frequent, np.int64).reshape(-1, 2)
        hashes = known[:, 0].copy().view(np.uint64)
        by_hash = np.argsort(hashes)
        self.hashes = hashes[by_hash]
        rank = np.empty(len(known), np.int64)
        rank[np.lexsort((hashes, known[:, 1]))] = np.arange(len(known))
        self.rank = rank[by_hash]

    def prefix(self, shingles: np.ndarray, percent: int) -> np.ndarray:
        size = prefix_length(len(shingles), percent)
        if not len(self.hashes):
            return shingles[:size]
        at = np.minimum(np.searchsorted(self.hashes, shingles), len(self.hashes) - 1)
        is_frequent = self.hashes[at] == shingles
        plain = shingles[~is_frequent][:size]
        if len(plain) == size:
            return plain
        last = shingles[is_frequent][np.argsort(self.rank[at[is_frequent]])]
        return np.concatenate([plain, last[: size - len(plain)]])


def set_sizes(rows: DataFrame, shingle: int) -> DataFrame:
    """``_id``, ``_k``, set size ``n``, set key ``c``, size ``first`` of the first fragment and ``parity`` of every row; stored."""
    edge = np.uint64((1 << 64) // FRAGMENTS)

    def sizes(batches):
        for batch in batches:
            n, c, first, odd = [], [], [], []
            for group in chunks(batch.column("_text").to_pylist()):
                for found in shingle_sets(group, shingle):
                    n.append(len(found))
                    c.append(set_key(found))
                    first.append(int(np.searchsorted(found, edge)))
                    odd.append(parity(found))
            columns = [batch.column("_id"), batch.column("_k"), *[pa.array(x, pa.int64()) for x in (n, c, first)], pa.array(odd, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_k", "n", "c", "first", "parity"])

    id_type = rows.schema["_id"].dataType.simpleString()
    return stage_table(rows.mapInArrow(sizes, f"_id {id_type}, _k long, n long, c long, first long, parity binary"), "set_sizes")


def global_order(rows: DataFrame, shingle: int) -> Order:
    """Count frequent n-grams over all texts; a bounded table reaches the driver."""

    def count(batches):
        parts, size = [], 0
        for batch in batches:
            for group in chunks(batch.column("_text").to_pylist()):
                parts += shingle_sets(group, shingle)
                size += sum(map(len, group))
                if size >= GROUP_BYTES:
                    yield often(parts)
                    parts, size = [], 0
        if parts:
            yield often(parts)

    def often(parts: list[np.ndarray]) -> pa.RecordBatch:
        kinds, counts = np.unique(np.concatenate(parts), return_counts=True)
        keep = counts >= LOCAL
        return pa.RecordBatch.from_arrays([pa.array(kinds[keep].view(np.int64)), pa.array(counts[keep])], ["g", "f"])

    counted = rows.select("_text").mapInArrow(count, "g long, f long").groupBy("g").agg(F.sum("f").alias("f"))
    top = counted.filter(F.col("f") >= FREQUENT).orderBy(F.desc("f"), "g").limit(MOST_FREQUENT)
    return Order([(r.g, r.f) for r in top.collect()])


def later(order: Order, large: DataFrame) -> Order:
    """The order with the n-grams of larger buckets among the frequent ones; a bounded table reaches the driver."""
    top = large.groupBy("g").agg(F.count("*").alias("f")).orderBy(F.desc("f"), "g").limit(MOST_FREQUENT)
    counts = dict(order.frequent)
    for r in top.collect():
        counts[r.g] = max(r.f, counts.get(r.g, 0))
    return Order(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:MOST_FREQUENT])


def prefix_rows(rows: DataFrame, order: Order, shingle: int, percent: int) -> DataFrame:
    """A row per class and prefix n-gram: ``g``, set key ``c``, set size ``n``, place ``i``; a task tells a class once."""
    shared = rows.sparkSession.sparkContext.broadcast((order.hashes, order.rank))  # MOST_FREQUENT entries at most

    def lead(batches):
        order = Order([])
        order.hashes, order.rank = shared.value
        told: set[int] = set()
        for batch in batches:
            for group in chunks(batch.column("_text").to_pylist()):
                found = {set_key(x): x for x in shingle_sets(group, shingle) if len(x)}
                found = {c: x for c, x in found.items() if c not in told}
                if not found:
                    continue
                told.update(found)
                parts = [order.prefix(x, percent) for x in found.values()]
                times = [len(p) for p in parts]
                keys = np.repeat(np.array(list(found), np.int64), times)
                sizes = np.repeat(np.array([len(x) for x in found.values()], np.int32), times)
                places = np.concatenate([np.arange(t, dtype=np.int32) for t in times])
                columns = [pa.array(np.concatenate(parts).view(np.int64)), pa.array(keys), pa.array(sizes), pa.array(places)]
                yield pa.RecordBatch.from_arrays(columns, ["g", "c", "n", "i"])

    return rows.select("_text").mapInArrow(lead, "g long, c long, n int, i int")


class Buckets:
    """Reads rows ``g, c, n, i`` in the order of g and c: pairs of small buckets, rows of larger ones."""

    def __init__(self, percent: int, small: int):
        self.percent, self.small = percent, small
        self.held = np.zeros((0, 4), np.int64)
        self.large: int | None = None  # the n-gram of a larger bucket that is not over yet
        self.last = 0

    def read(self, rows: np.ndarray, over: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``c, n, c2, n2`` and rows of larger buckets that are settled; the last bucket may go on."""
        rows = np.concatenate([self.held, rows])
        same = np.zeros(len(rows), bool)
        same[1:] = (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1])
        rows = rows[~same]
        passed = rows[:0]
        if self.large is not None:
            on = rows[:, 0] == self.large
            passed = rows[on & (rows[:, 1] != self.last)]
            if len(passed):
                self.last = int(passed[-1, 1])
            if not on.all():
                self.large = None
            rows = rows[~on]
        starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])) if len(rows) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(rows)))
        self.held = rows[:0]
        if len(sizes) and not over:
            if sizes[-1] <= self.small:
                self.held = rows[starts[-1] :].copy()
                starts, sizes = starts[:-1], sizes[:-1]
            else:
                self.large, self.last = int(rows[-1, 0]), int(rows[-1, 1])
        big = np.repeat(sizes > self.small, sizes)
        found = [self._pairs(rows, starts[sizes == m], m) for m in range(2, self.small + 1) if (sizes == m).any()]
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)
        return pairs, np.concatenate([passed, rows[: len(big)][big]])

    def _pairs(self, rows: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        left, right = np.triu_indices(size, 1)
        one, two = rows[(starts[:, None] + left).ravel()], rows[(starts[:, None] + right).ravel()]
        n1, n2, p = one[:, 2], two[:, 2], self.percent
        needed = -(-(n1 + n2) * p // (100 + p))
        most = np.minimum(n1 - one[:, 3], n2 - two[:, 3])
        keep = (n1 * p <= n2 * 100) & (n2 * p <= n1 * 100) & (most >= needed)
        return np.column_stack([one[keep, 1], n1[keep], two[keep, 1], n2[keep]])


def buckets(leads: DataFrame, percent: int) -> DataFrame:
    """Pairs ``c, n, c2, n2`` of small buckets (``g`` NULL) and rows ``g, c, n, i`` of larger ones; stored."""

    def sift(batches):
        reader = Buckets(percent, SMALL_BUCKET)
        for batch in chain(batches, [None]):
            rows = np.zeros((0, 4), np.int64) if batch is None else np.column_stack([x.to_numpy().astype(np.int64) for x in batch.columns])
            pairs, large = reader.read(rows, batch is None)
            if len(pairs) + len(large):
                none = [pa.nulls(len(pairs), pa.int64()), pa.nulls(len(large), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([a, b])
                        for a, b in zip(
                            [none[0], *[pa.array(pairs[:, j]) for j in (0, 1)], none[0], *[pa.array(pairs[:, j]) for j in (2, 3)]],
                            [*[pa.array(large[:, j]) for j in range(4)], none[1], none[1]],
                            strict=True,
                        )
                    ],
                    ["g", "c", "n", "i", "c2", "n2"],
                )

    ordered_ = leads.repartition("g").sortWithinPartitions("g", "c")
    return stage_table(ordered_.mapInArrow(sift, "g long, c long, n long, i long, c2 long, n2 long"), "buckets")


def may_link(percent: int) -> Column:
    """Length and position filter for sizes n1, n2 and places i1, i2."""
    n1, n2, i1, i2 = map(F.col, ("n1", "n2", "i1", "i2"))
    needed = F.ceil((n1 + n2) * percent / (100 + percent) - 1e-9)
    return (n1 * percent <= n2 * 100) & (n2 * percent <= n1 * 100) & (F.least(n1 - i1, n2 - i2) >= needed)


def ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with ``a`` below ``b`` and their sizes."""
    swap = F.col("c1") > F.col("c2")
    pick = lambda yes, no: F.when(swap, F.col(yes)).otherwise(F.col(no))
    columns = [pick("c2", "c1").alias("a"), pick("c1", "c2").alias("b"), pick("n2", "n1").alias("na"), pick("n1", "n2").alias("nb")]
    return pairs.select(*columns).distinct()


def parity_filter(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parities differ in no more places than linked sets may."""
    wanted = pairs.select(F.col("a").alias("_p")).unionAll(pairs.select("b")).distinct()
    known = sizes.select("c", "parity").join(wanted, F.col("c") == F.col("_p"), "left_semi").groupBy("c").agg(F.any_value("parity").alias("parity"))
    known = stage_table(known, "parities")
    one = pairs.join(known.select(F.col("c").alias("_a"), F.col("parity").alias("_one")), F.col("a") == F.col("_a")).drop("_a")
    both = one.join(known.select(F.col("c").alias("_b"), F.col("parity").alias("_two")), F.col("b") == F.col("_b")).drop("_b")

    def near(batches):
        for batch in batches:
            na, nb, one, two = (batch.column(x).to_pylist() for x in ("na", "nb", "_one", "_two"))
            keep = [least_difference(x, y) <= n + m - 2 * -(-(n + m) * percent // (100 + percent)) for n, m, x, y in zip(na, nb, one, two, strict=True)]
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "na", "nb", "_one", "_two").mapInArrow(near, pairs.select("a", "b", "na", "nb").schema)


def class_texts(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text (``c``, ``_text``) of each wanted class ``c``.

    The rows to read, one per class, are broadcast below ``BROADCAST_ROWS`` of them and
    otherwise joined by shuffle.
    """
    chosen = classes.join(wanted.select(F.col("c").alias("_p")).distinct(), F.col("c") == F.col("_p"), "left_semi")
    chosen = stage_table(chosen.select(F.col("_one._id").alias("_wid"), F.col("_one._k").alias("_wk"), "c"), "candidates")
    side = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    return rows.join(side, (F.col("_k") == F.col("_wk")) & F.col("_id").eqNullSafe(F.col("_wid"))).select("c", "_text")


def class_sets(rows: DataFrame, classes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """Segments (``c``, ``fragment``, ``part``) of one text of each wanted class ``c``; stored, the first fragments apart."""
    texts = class_texts(rows, classes, wanted)
    edges = np.array([(i << 64) // FRAGMENTS for i in range(1, FRAGMENTS)], np.uint64)

    def cut(batches):
        for batch in batches:
            keys, at = batch.column("c").to_pylist(), 0
            for group in chunks(batch.column("_text").to_pylist()):
                c, fragment, part = [], [], []
                for found in shingle_sets(group, shingle):
                    ends = [0, *np.searchsorted(found, edges).tolist(), len(found)]
                    for f in range(FRAGMENTS):
                        if ends[f + 1] > ends[f]:
                            c.append(keys[at])
                            fragment.append(f)
                            part.append(found[ends[f] : ends[f + 1]].view(np.int64))
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()), pa.array(fragment, pa.int32()), pa.array(part, pa.list_(pa.int64()))], ["c", "fragment", "part"]
                )

    parts = texts.mapInArrow(cut, "c long, fragment int, part array<long>").withColumn("head", F.col("fragment") == 0)
    return stage_table(parts, "class_sets", ["head"])


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Per pair, the common n-grams ``o`` in the fragments of ``parts``, counted one by one and summed.

    Only segments of the pairs' own classes are shuffled: up to ``BROADCAST_ROWS`` of
    these are told to every task that reads segments.
    """
    paired = pairs.select(F.col("a").alias("_p")).unionAll(pairs.select("b")).distinct()
    if 2 * pairs.count() <= BROADCAST_ROWS:
        parts = parts.join(F.broadcast(paired), F.col("c") == F.col("_p"), "left_semi")
    left = pairs.select("a", "b").join(parts, F.col("a") == F.col("c")).select("a", "b", "fragment", F.col("part").alias("_pa"))
    right = parts.select(F.col("c").alias("_c"), F.col("fragment").alias("_f"), F.col("part").alias("_pb"))
    both = left.join(right, (F.col("b") == F.col("_c")) & (F.col("fragment") == F.col("_f")))
    counted = both.select("a", "b", "fragment", F.size(F.array_intersect("_pa", "_pb")).alias("o"))
    # The row that stands for a class may be repeated, id and text alike: its segments count once.
    once = counted.groupBy("a", "b", "fragment").agg(F.max("o").alias("o"))
    return once.groupBy("a", "b").agg(F.sum("o").alias("o"))


def verified(classes: DataFrame, sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose overlaps, summed over the fragments, reach the similarity; stored."""
    with storage(pairs.sparkSession) as own:
        size = classes.select(F.col("c").alias("_c"), F.col("first").alias("_first"))
        sized = pairs.join(size, F.col("a") == F.col("_c")).withColumnRenamed("_first", "_fa").drop("_c")
        sized = sized.join(size, F.col("b") == F.col("_c")).withColumnRenamed("_first", "_fb").drop("_c")
        one = overlaps(pairs, sets.filter("head")).withColumnsRenamed({"a": "_a", "b": "_b"})
        begun = sized.join(one, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left").withColumn("o", F.coalesce("o", F.lit(0)))
        most = F.col("o") + F.least(F.col("na") - F.col("_fa"), F.col("nb") - F.col("_fb"))
        open_ = own.stage(begun.filter(100 * most >= percent * (F.col("na") + F.col("nb") - most)).select("a", "b", "na", "nb", "o"), "open_pairs")
        rest = overlaps(open_, sets.filter("not head")).select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("o").alias("_o"))
        total = open_.join(rest, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left").withColumn("o", F.col("o") + F.coalesce("_o", F.lit(0)))
        linked = 100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))
        return own.result(total.filter(linked).select("a", "b"), "pair_links")


def hub_pairs(large: DataFrame, labels: DataFrame, percent: int, round_: int) -> DataFrame | None:
    """Pairs of ``HUBS`` members of each larger bucket with all others, across components; all pairs after the last round."""
    now = large.join(labels, F.col("c") == F.col("node"), "left").select("g", "c", "n", "i", F.coalesce("label", "c").alias("label"))
    member = F.struct(*[F.col(x).alias(f"{x}2") for x in ("c", "n", "i", "label")])
    hubs = F.array(*[F.min_by(member, F.xxhash64("c", F.lit(round_ * HUBS + j))) for j in range(HUBS)])
    grouped = now.groupBy(F.col("g").alias("g2")).agg(F.min("label").alias("_l1"), F.max("label").alias("_l2"), hubs.alias("_hubs"))
    hub = F.explode(F.array_distinct("_hubs")).alias("_hub")
    open_ = stage_table(grouped.filter("_l1 <> _l2").select("g2", hub).select("g2", "_hub.*"), "open_buckets")
    if not open_.limit(1).count():
        return None
    one = now.select("g", *[F.col(x).alias(f"{x}1") for x in ("c", "n", "i", "label")])
    open_pair = (F.col("g") == F.col("g2")) & (F.col("label1") != F.col("label2")) & may_link(percent)
    if round_ < HUB_ROUNDS:
        return one.join(open_, open_pair)
    two = stage_table(one.join(open_.select(F.col("g2").alias("_g")).distinct(), F.col("g") == F.col("_g"), "left_semi"), "open_members")
    other = two.select(*[F.col(x).alias(f"{x[:-1]}2" if x != "g" else "g2") for x in two.columns])
    return two.join(other, open_pair & (F.col("c1") < F.col("c2")))


def nearest(pairs: DataFrame) -> DataFrame:
    """For each class of the pairs the one with the neighbour of the least hash; a pair once."""
    row = F.struct("a", "b", "na", "nb")
    ends = pairs.select(F.col("a").alias("c"), F.xxhash64("b").alias("h"), row.alias("pair")).unionAll(pairs.select("b", F.xxhash64("a"), row))
    return ends.groupBy("c").agg(F.min(F.struct("h", "pair")).alias("best")).select("best.pair.*").distinct()


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose classes are not known to be in one component."""
    known = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    one = pairs.join(known, F.col("a") == F.col("_node"), "left").withColumn("_la", F.coalesce("_label", "a")).drop("_node", "_label")
    two = one.join(known, F.col("b") == F.col("_node"), "left").withColumn("_lb", F.coalesce("_label", "b"))
    return two.filter("_la <> _lb").select(*pairs.columns)


def small_pairs(found: DataFrame) -> DataFrame:
    return found.filter("c2 is not null").select(F.col("c").alias("c1"), F.col("n").alias("n1"), "c2", "n2")


def large_rows(found: DataFrame) -> DataFrame:
    return found.filter("c2 is null").select("g", "c", "n", "i")


def class_links(rows: DataFrame, sizes: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Components of the classes (``node``, ``label``) and one row per class."""
    classes = sizes.filter("n > 0").groupBy("c").agg(
        F.min("_id").alias("least"), F.min(F.struct("_id", "_k")).alias("_one"), F.min("first").alias("first")
    )
    classes = stage_table(classes, "classes")
    order = global_order(rows, shingle)
    found = buckets(prefix_rows(rows, order, shingle, percent), percent)
    small, large = small_pairs(found), large_rows(found)
    for _ in range(ORDER_ROUNDS):
        if large.isEmpty():
            break
        order = later(order, large)
        found = buckets(prefix_rows(class_texts(rows, classes, large), order, shingle, percent), percent)
        small, large = small.unionAll(small_pairs(found)), large_rows(found)
    labels = rows.sparkSession.createDataFrame([], "node long, label long")

    def tested(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        links = verified(classes, sets, pairs, percent)
        if links.isEmpty():
            return labels
        # What is known goes in as stars, so only the new links make further rounds.
        return components(links.unionAll(labels.filter("node <> label").select("node", "label")))

    small = stage_table(ordered(small), "small_pairs")
    pairs = stage_table(parity_filter(small, sizes, percent), "small_pairs")
    wanted = pairs.select(F.col("a").alias("c")).unionAll(pairs.select("b")).unionAll(large.select("c"))
    sets = class_sets(rows, classes, wanted, shingle)
    for round_ in range(NEAREST_ROUNDS + 1):
        if pairs.isEmpty():
            break
        chosen = pairs if round_ == NEAREST_ROUNDS else stage_table(nearest(pairs), "nearest_pairs")
        labels = tested(chosen, labels)
        if round_ < NEAREST_ROUNDS:
            left = pairs.join(chosen.select("a", "b"), ["a", "b"], "left_anti")
            pairs = stage_table(across(left, labels), "small_pairs")
    done = small.select("a", "b")
    if not large.isEmpty():
        for round_ in range(HUB_ROUNDS + 1):
            met = hub_pairs(large, labels, percent, round_)
            if met is None:
                break
            pairs = stage_table(ordered(met).join(done, ["a", "b"], "left_anti"), "candidate_pairs")
            labels = tested(stage_table(parity_filter(pairs, sizes, percent), "candidate_pairs"), labels)
            done = done.unionAll(pairs.select("a", "b"))
    return labels, classes


def join_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``_id``, ``_k``, set size ``n``, class ``c``, ``component``."""
    rows = text_rows(docs, id_col, text_col)
    with storage(docs.sparkSession) as own:
        sizes = set_sizes(rows, shingle)
        labels, classes = class_links(rows, sizes, shingle, percent)
        named = classes.join(labels, F.col("c") == F.col("node"), "left").select(F.col("c").alias("_c"), "least", F.coalesce("label", "c").alias("label"))
        named = stage_table(named, "class_labels")
        least = named.groupBy(F.col("label").alias("_label")).agg(F.min("least").alias("component"))
        found = named.join(least, F.col("label") == F.col("_label")).select("_c", "component")
        joined = sizes.join(found, F.col("c") == F.col("_c"), "left")
        component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("_id")).alias("component")
        return own.result(joined.select("_id", "_k", "n", "c", component), "set_components")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its set's size and its component."""
    return join_components(docs).select(F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the near copies of a smaller id, with all columns.

    A component keeps the rows whose id is its smallest; documents without words
    are kept.
    """
    found = join_components(docs, id_col=id_col, text_col=text_col)
    gone = stage_table(found.filter("n > 0 and component <> _id").select("_id", "_k").distinct(), "near_copies")
    key = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(gone, (docs[id_col] == gone["_id"]) & (key == gone["_k"]), "left_anti")
