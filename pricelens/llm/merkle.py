"""Merkle manifest of a dataset: leaf, subroot per source, root, and proofs.

Leaves get their places from bitmaps. The ids of a source are bits; one aggregation
with partial results ORs them into 64-bit words, and words make containers of 65,536
ids that leave out empty words and carry the number of leaves before each word (a
popcount directory). A leaf's place is a rank query: the start of its container, the
directory entry of its word, and the bits below its own. So no document is sorted; only
containers are put in order, a few per 65,536 ids.

Levels are reduced ``DEPTH`` at a time: the nodes of a tree whose places agree in the
upper digits (base ``ARITY``) fill one slot array of at most ``ARITY ** DEPTH`` hashes,
which is folded level by level. The sources' subroots are the leaves of one more tree,
reduced by the same function. Paths go back down one row per slot array, joined by its
key, and a leaf's proof and its check against a tampered text come from its array and
its path, without a join of leaves.

Defined cases: any column may be NULL, and a NULL differs from an empty text. Leaves
with a NULL id come first in their source, equal ids in the order of their leaves, and
equal leaves in any order. A NULL id is never tampered with. The only document of the
only source has no siblings: its proof is the hash of nothing. Columns beyond the five
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.operators.ranking import sums_before
from pricelens.session import join_on, stage_table
from pricelens.storage import storage

ARITY = 3
DEPTH = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(docs: DataFrame, **changed: Column) -> Column:
    return digest(F.concat(*[field(changed.get(c, docs[c])) for c in FIELDS]))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, leaf, tampered`` and a row number; ``tree`` names the source without NULL, in its order.

    ``tampered`` is the leaf of the text without line feeds where the id's checksum is
    even, else NULL.
    """
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.translate("text", "\n", "")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        leaf_of(docs).alias("leaf"),
        F.when(even & F.contains("text", F.lit("\n")), leaf_of(docs, text=cut)).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )


# --- places ------------------------------------------------------------------


def bit_of(low: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(low, F.lit(64)).cast("int"))


def below(word: Column, low: Column) -> Column:
    """Bits set in ``word`` below the place of ``low``."""
    above = F.call_function("shiftleft", F.lit(-1).cast("long"), F.pmod(low, F.lit(64)).cast("int"))
    return F.bit_count(word.bitwiseAND(F.bitwise_not(above)))


def words(marked: DataFrame) -> DataFrame:
    """Bitmap words of each tree: ``tree, block, word, bits, n``; ``n`` counts rows, repeated ids too."""
    low = F.col("doc_id").bitwiseAND(F.lit(0xFFFF).cast("long"))
    return (
        marked.filter("doc_id is not null")
        .groupBy("tree", F.shiftright("doc_id", 16).alias("block"), F.floor(low / 64).cast("int").alias("word"))
        .agg(F.bit_or(bit_of(low)).alias("bits"), F.count("*").alias("n"))
    )


def containers(marked: DataFrame, repeats: DataFrame) -> DataFrame:
    """Compressed bitmaps: ``tree, block, at, bits, before, more, n``.

    ``at`` lists the words that hold ids, ``bits`` their bits, ``before`` the leaves of
    the container before each, and ``more`` the ids that have further leaves.
    """
    entry = F.array_sort(F.collect_list(F.struct("word", "bits", "n")))
    packed = words(marked).groupBy("tree", "block").agg(entry.alias("e"), F.sum("n").alias("n"))
    more = (
        repeats.filter("doc_id is not null")
        .groupBy("tree", F.shiftright("doc_id", 16).alias("block"))
        .agg(F.collect_list(F.struct("doc_id", (F.col("copies") - 1).alias("n"))).alias("more"))
    )
    zero = F.array(F.lit(0).cast("long"))
    sums = F.aggregate("e", zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["n"])))
    return packed.join(more, ["tree", "block"], "left").select(
        "tree", "block", F.col("e.word").alias("at"), F.col("e.bits").alias("bits"), sums.alias("before"), "more", "n"
    )


def starts(packed: DataFrame, marked: DataFrame) -> DataFrame:
    """Containers with ``start``, the place of their first leaf in the tree; leaves without id come before."""
    placed = sums_before(packed, ["tree", "block"], "n", "global")
    first = placed.groupBy("tree").agg(F.min("global").alias("first"))
    nameless = marked.filter("doc_id is null").groupBy("tree").agg(F.count("*").alias("nameless"))
    return (
        placed.join(first, "tree")
        .join(nameless, "tree", "left")
        .withColumn("start", F.col("global") - F.col("first") + F.coalesce("nameless", F.lit(0)))
        .drop("global", "first", "nameless", "n")
    )


def rank() -> Column:
    """Place of ``doc_id`` in its tree, from its container."""
    low = F.col("doc_id").bitwiseAND(F.lit(0xFFFF).cast("long"))
    position = F.array_position("at", F.floor(low / 64).cast("int")).cast("int")
    inside = below(F.element_at("bits", position), low)
    # Further leaves of smaller ids in the same word; those in earlier words are in the directory.
    near = F.filter("more", lambda x: (F.shiftright(x["doc_id"], 6) == F.shiftright("doc_id", 6)) & (x["doc_id"] < F.col("doc_id")))
    further = F.aggregate(near, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    return F.col("start") + F.element_at("before", position) + inside + F.coalesce(further, F.lit(0))


def tie_places(marked: DataFrame, repeats: DataFrame) -> DataFrame:
    """``row, shift``: the place among leaves of one id, by leaf, then by stored row.

    No window holds an id's rows: distinct leaves are numbered within a slice of the
    hash range, copies of a leaf within the part of the table they are stored in.
    """
    key = ["tree", "doc_id"]
    tied = join_on(marked, repeats.select(*key), key).select(*key, "leaf", "row", F.shiftright("row", 33).alias("part"))
    tied = stage_table(tied.withColumn("slice", F.substring("leaf", 1, 4)), "ties")
    copies = stage_table(tied.groupBy(*key, "slice", "leaf", "part").agg(F.count("*").alias("n")), "tie_copies")

    def earlier(group: list[str], order: str) -> Column:
        window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    by_slice = copies.groupBy(*key, "slice").agg(F.sum("n").alias("n")).withColumn("a", earlier(key, "slice")).drop("n")
    by_leaf = copies.groupBy(*key, "slice", "leaf").agg(F.sum("n").alias("n")).withColumn("b", earlier([*key, "slice"], "leaf")).drop("n")
    by_part = copies.withColumn("c", earlier([*key, "leaf"], "part")).drop("n")
    shifts = join_on(join_on(by_part, by_leaf, [*key, "slice", "leaf"]), by_slice, [*key, "slice"])
    number = F.row_number().over(Window.partitionBy(*key, "leaf", "part").orderBy("row")) - 1
    numbered = join_on(tied.withColumn("d", number), shifts, [*key, "slice", "leaf", "part"])
    return numbered.select("row", (F.col("a") + F.col("b") + F.col("c") + F.col("d")).alias("shift"))


def placed_leaves(marked: DataFrame) -> DataFrame:
    """Leaves with ``i``, the place in their tree, and ``n``, the size of the tree."""
    repeats = stage_table(marked.groupBy("tree", "doc_id").agg(F.count("*").alias("copies")).filter("copies > 1 or doc_id is null"), "repeats")
    index = stage_table(starts(containers(marked, repeats), marked), "containers")
    named = marked.filter("doc_id is not null").withColumn("block", F.shiftright("doc_id", 16))
    ranked = named.join(index, ["tree", "block"]).select(*marked.columns, rank().alias("i"))
    first = marked.filter("doc_id is null").withColumn("i", F.lit(0).cast("long"))
    every = ranked.unionByName(first)
    if not repeats.isEmpty():
        shifted = every.join(tie_places(marked, repeats), "row", "left")
        every = shifted.withColumn("i", F.col("i") + F.coalesce("shift", F.lit(0))).drop("shift")
    sizes = marked.groupBy("tree").agg(F.count("*").alias("n"))
    return every.join(sizes, "tree")


# --- levels ------------------------------------------------------------------

WIDTH = ARITY**DEPTH


def next_level(nodes: Column) -> Column:
    """Hash of each run of ``ARITY`` nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda r: digest(F.array_join(F.slice(nodes, r * ARITY + 1, F.lit(ARITY)), "")))


def slot_arrays(nodes: DataFrame, *carried: str) -> DataFrame:
    """Nodes ``tree, i, n, h`` gathered by their upper digits: ``tree, i, n, slots, levels``.

    ``levels`` holds the array's hashes from the nodes up, as many levels as the tree
    still has, ``DEPTH`` at most; the last one's only hash is the node above if the
    tree is wider than the array, and the tree's root if not.
    """
    slot = F.struct(F.pmod("i", F.lit(WIDTH)).cast("int").alias("slot"), "h", *carried)
    gathered = nodes.groupBy("tree", F.floor(F.col("i") / WIDTH).alias("i")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(slot)).alias("slots")
    )
    height = sum(((F.col("n") > ARITY**j).cast("int") for j in range(DEPTH)), F.lit(0))
    steps = F.slice(F.array(*[F.lit(j) for j in range(DEPTH)]), F.lit(1), height)
    levels = F.aggregate(
        steps, F.array(F.col("slots.h")), lambda acc, _: F.concat(acc, F.array(next_level(F.element_at(acc, -1))))
    )
    return gathered.withColumn("levels", levels)


def nodes_above(arrays: DataFrame) -> DataFrame:
    top = F.element_at(F.element_at("levels", -1), 1)
    return arrays.select("tree", "i", F.ceil(F.col("n") / WIDTH).alias("n"), top.alias("h"))


def path_in(slot: Column) -> Column:
    """Runs that hold a slot, level by level, and its place in each."""
    digits = F.array(*[F.lit(ARITY**j) for j in range(DEPTH)])
    known = F.slice(digits, F.lit(1), F.size("levels") - 1)

    def step(width: Column, j: Column) -> Column:
        at = F.floor(slot / width).cast("int")
        run = F.slice(F.get("levels", j), at - F.pmod(at, F.lit(ARITY)) + 1, F.lit(ARITY))
        return F.struct(F.pmod(at, F.lit(ARITY)).alias("at"), run.alias("run"))

    return F.transform(known, step)


EMPTY_PATH = "array<struct<at:int,run:array<string>>>"


def reduced(nodes: DataFrame, height: int, name: str, *carried: str) -> list[DataFrame]:
    """Stored slot arrays, from the nodes up to one array a tree."""
    stored = [stage_table(slot_arrays(nodes, *carried), f"{name}_0")]
    for level in range(1, height):
        stored.append(stage_table(slot_arrays(nodes_above(stored[-1])), f"{name}_{level}"))
    return stored


def rounds(nodes: DataFrame) -> int:
    """Slot arrays on the way from a node to the root of the largest tree."""
    most, found = nodes.agg(F.max("n")).first()[0] or 1, 1
    while most > WIDTH:
        most, found = -(-most // WIDTH), found + 1
    return found


def paths_down(arrays: list[DataFrame], tops: DataFrame, *carried: str) -> DataFrame:
    """The lowest arrays with ``up``, the path from their node to the root of ``tops``."""
    keep = ["up", *carried]
    above = tops.select("tree", F.lit(0).cast("long").alias("i"), *keep)
    for level in range(len(arrays) - 1, 0, -1):
        joined = arrays[level].join(above, ["tree", "i"])
        slots = F.transform(
            "slots", lambda s: F.struct(s["slot"].alias("slot"), F.concat(path_in(s["slot"]), F.col("up")).alias("up"))
        )
        above = joined.select("tree", (F.col("i") * WIDTH).alias("base"), *carried, F.explode(slots).alias("s")).select(
            "tree", (F.col("base") + F.col("s.slot")).alias("i"), F.col("s.up").alias("up"), *carried
        )
    return arrays[0].join(above, ["tree", "i"])


def roots(arrays: list[DataFrame]) -> DataFrame:
    return nodes_above(arrays[-1]).select("tree", "h")


def source_tops(subroots: DataFrame) -> DataFrame:
    """Per source ``tree, subroot, root, up``, with ``up`` the path from the subroot to the root."""
    ranked = sums_before(subroots.withColumn("one", F.lit(1)), ["tree"], "one", "i")
    n = F.lit(subroots.count()).cast("long").alias("n")
    nodes = stage_table(ranked.select(F.lit("").alias("tree"), "i", n, "h", F.col("tree").alias("source")), "subroots")
    arrays = reduced(nodes, rounds(nodes), "top", "source")
    top = roots(arrays).select("tree", F.col("h").alias("root"), F.array().cast(EMPTY_PATH).alias("up"))
    down = paths_down(arrays, top, "root")
    entry = F.transform(
        "slots",
        lambda s: F.struct(
            s["source"].alias("tree"), s["h"].alias("subroot"), F.concat(path_in(s["slot"]), F.col("up")).alias("path")
        ),
    )
    return down.select("root", F.explode(entry).alias("s")).select("s.tree", "s.subroot", "root", F.col("s.path").alias("up"))


def proof_of(path: Column) -> Column:
    """Hash of all siblings of a path, from the leaf up, left to right."""
    others = F.transform(path, lambda p: F.array_join(F.filter(p["run"], lambda x, i: i != p["at"]), ""))
    return digest(F.array_join(others, ""))


def fold(path: Column, leaf: Column) -> Column:
    """Root that a leaf and a path lead to."""
    return F.aggregate(
        path, leaf, lambda h, p: digest(F.array_join(F.transform(p["run"], lambda x, i: F.when(i == p["at"], h).otherwise(x)), ""))
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: leaf, subroot, root, proof, the root its (tampered) text folds to, and whether that is the root."""
    with storage(docs.sparkSession) as own:
        marked = stage_table(leaves(docs), "leaves")
        nodes = placed_leaves(marked).withColumnRenamed("leaf", "h")
        nodes = stage_table(nodes.select("tree", "i", "n", "h", "doc_id", "tampered"), "nodes")
        arrays = reduced(nodes, rounds(nodes), "levels", "doc_id", "tampered")
        tops = stage_table(source_tops(stage_table(roots(arrays), "roots")), "tops")
        down = paths_down(arrays, tops, "subroot", "root")

        def with_path(s: Column) -> Column:
            return F.struct(s.alias("s"), F.concat(path_in(s["slot"]), F.col("up")).alias("path"))

        def checked(x: Column) -> Column:
            s = x["s"]
            return F.struct(
                s["doc_id"].alias("doc_id"),
                s["h"].alias("leaf"),
                proof_of(x["path"]).alias("proof_sha256"),
                fold(x["path"], F.coalesce(s["tampered"], s["h"])).alias("folded_root"),
            )

        entries = down.select("subroot", "root", F.explode(F.transform(F.transform("slots", with_path), checked)).alias("s"))
        checks = entries.select(
            "s.doc_id", "s.leaf", "subroot", "root", "s.proof_sha256", "s.folded_root",
            (F.col("s.folded_root") == F.col("root")).alias("verified"),
        )
        return own.result(checks, "manifest")
