"""Near-duplicates by bottom-k sketches, with exact Jaccard similarity on full sets.

Documents with equal shingle sets are one class.  A class keeps the k smallest hashes
of its set.  Inverted lists of these values give pairs that overlap; the sketch of
their union estimates the similarity; full sets decide.

Sketch values are ordered from rare to frequent.  Linked sets share at least half of
their sketches (for k = 48 fewer is as unlikely as one in 10^7 at a similarity of 0.8,
and impossible for sets that the sketch holds whole), so linked sets meet in the rare
part of their sketches, and values of common passages are never listed unless a
document has little else.  Lists that are long all the same belong to large groups of
copies; ``_cells`` links those without forming all pairs, and without a cap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import on_arrow, same, stored, texts
from .components import components

SKETCH = 48
#: Part of a sketch that linked sets share at least.
OVERLAP = 0.5
#: How far the estimate may be below the limit: of pairs exactly at 0.8 (0.85) it drops 3 in 10^8 (2 in 10^9) at k = 48.
SLACK = 0.35
#: Sketch lists, and lists inside a group of copies, of which all pairs are compared.
SHORT_LIST, SHORT_CELL_LIST = 24, 128
#: How often the long lists inside a group are divided further before their pairs are compared,
#: and the part of the members that may be left for it.
MOST_LEVELS = 3
LEAST_GAIN = 0.5
REMEMBERED = 100_000
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]
_HASHES: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_HASHES) > REMEMBERED:
        _HASHES.clear()
    for word in set(words).difference(_HASHES):
        _HASHES[word] = xxhash.xxh3_64_intdigest(word)
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str, n: int) -> np.ndarray:
    """Sorted 63-bit hashes of the distinct n-word shingles; of fewer words, of the whole sequence."""
    # bytes.lower() folds A-Z only, bytes.split() cuts at x20 and x09 to x0D.
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    hashes = _word_hashes(words)
    size = min(n, len(words))
    mixed = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : len(words) - size + 1 + i]) * _MIX[i % len(_MIX)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed >> np.uint64(1)).view(np.int64)


def _sketcher(n: int, k: int):
    kind = pa.struct([("n", pa.int64()), ("signature", pa.binary()), ("sketch", pa.list_(pa.int64()))])

    @on_arrow(kind)
    def sketch_text(text: pa.Array) -> pa.Array:
        sets = (shingle_set(t, n) for t in text.to_pylist())
        return pa.array([{"n": len(s), "signature": xxhash.xxh3_128_digest(s.tobytes()), "sketch": s[:k]} for s in sets], kind)

    return sketch_text


def _setter(n: int):
    @on_arrow(pa.list_(pa.int64()))
    def set_of(text: pa.Array) -> pa.Array:
        return _lists([shingle_set(t, n) for t in text.to_pylist()])

    return set_of


def _arrays(lists: pa.Array) -> list[np.ndarray]:
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64)))


@on_arrow(pa.int64())
def shared_count(left: pa.Array, right: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets."""
    return pa.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(_arrays(left), _arrays(right))], pa.int64())


@on_arrow(pa.list_(pa.int64()))
def difference(left: pa.Array, right: pa.Array) -> pa.Array:
    """Symmetric difference of two sets."""
    return _lists([np.setxor1d(a, b, assume_unique=True) for a, b in zip(_arrays(left), _arrays(right))])


def sketches(docs: DataFrame, words: int, k: int = SKETCH) -> DataFrame:
    return texts(docs).select("doc_id", _sketcher(words, k)("text").alias("s")).select("doc_id", "s.*")


def _rare_values(classes: DataFrame) -> DataFrame:
    """rep, value and list_size: the shared values in the rare part of each sketch."""
    c = F.col
    values = classes.select("rep", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = values.groupBy(c("value").alias("of")).agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # No longer than a sketch.
    own = values.join(shared, c("value") == c("of")).groupBy("rep").agg(
        F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("often", "value"))).alias("own")
    )
    # Values that no other set has come first; what is left of the rare part goes to shared ones.
    take = F.expr(f"size - cast(ceil(size * {OVERLAP}) as int) + 1 - (size - size(own))")
    entries = own.select("rep", F.explode(F.slice("own", F.lit(1), F.greatest(take, F.lit(0)))).alias("v")).select("rep", "v.value")
    entries = stored(entries, "entries")
    sizes = entries.groupBy(c("value").alias("of")).agg(F.count(F.lit(1)).alias("list_size")).where("list_size > 1")
    return stored(entries.join(sizes, c("value") == c("of")).drop("of"), "lists")


def _pairs_within(lists: DataFrame, keys: list[str], condition: Column | None = None) -> DataFrame:
    """Pairs a < b of the members (column rep) of each list."""
    left = lists.select(*[F.col(x).alias(f"a_{x}") for x in lists.columns])
    right = lists.select(*[F.col(x).alias(f"b_{x}") for x in lists.columns])
    on = F.col("a_rep") < F.col("b_rep")
    for key in keys:
        on = on & (F.col(f"a_{key}") == F.col(f"b_{key}"))
    return left.join(right, on if condition is None else on & condition).select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b"))


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs whose union sketch does not rule the similarity out."""
    own = classes.select("rep", "sketch")
    both = pairs.join(own.toDF("a", "left"), "a").join(own.toDF("b", "right"), "b")
    union = F.slice(F.array_sort(F.array_union("left", "right")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect("union", "left"), "right"))
    return both.withColumn("union", union).where(common >= (percent / 100 - SLACK) * F.size("union")).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    own = sets.select("rep", "items")
    both = pairs.join(own.toDF("a", "left"), "a").join(own.toDF("b", "right"), "b")
    both = both.select("a", "b", (F.size("left") + F.size("right")).alias("total"), shared_count("left", "right").alias("shared"))
    return both.where(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))).select("a", "b")


def _merged(lists: DataFrame, keys: list[str]) -> DataFrame:
    """cell and rep: lists that share members are one cell, so every member is in one cell."""
    first = lists.groupBy(*keys).agg(F.min("rep").alias("b"))
    edges = lists.select(F.col("rep").alias("a"), *keys).join(first, keys).select("a", "b")
    return stored(components(edges).select(F.col("component").alias("cell"), F.col("node").alias("rep")), "cells")


def _cells(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that connect all linked sets of each cell; ``cells`` has cell and rep.

    A cell's centre is the set of items that most of its members have.  With d the
    difference of a member to the centre and D that of two members, D is at most
    d1 + d2, and two sets are linked if and only if
    (100 + percent) * D <= (100 - percent) * (n1 + n2).  So with
    g = (100 + percent) * d - (100 - percent) * n, members with g1 + g2 <= 0 are linked.
    The member of least g is the hub, and everyone is paired with it.  Whoever is not
    linked for certain with the hub ("far") is not linked for certain with anyone; a
    link of a far member needs at least (g1 + g2) / (2 * (100 + percent)) common items
    in the differences.  Items of differences are ordered from rare to frequent, and
    far members are paired with those they meet in the part that such a link can't miss.
    Long lists of that kind make up new cells, with centres of their own.
    """
    c, up, down = F.col, 100 + percent, 100 - percent
    found = None
    for level in range(MOST_LEVELS):
        members = cells.join(sets, "rep").select("cell", "rep", "items")
        sizes = cells.groupBy(c("cell").alias("of")).agg(F.count(F.lit(1)).alias("members"))
        often = members.select("cell", F.explode("items").alias("item")).groupBy("cell", "item").agg(F.count(F.lit(1)).alias("often"))
        # At most twice as many items as a member has on average.
        centre = often.join(sizes, c("cell") == c("of")).where(2 * c("often") > c("members"))
        centre = centre.groupBy(c("cell").alias("of")).agg(F.sort_array(F.collect_list("item")).alias("centre"))
        deltas = members.join(centre, c("cell") == c("of"), "left").select(
            "cell", "rep", F.size("items").alias("n"), difference("items", F.coalesce("centre", F.array().cast("array<bigint>"))).alias("delta")
        )
        # Members of a hot cell come from few tasks; deal them out by number.
        deltas = deltas.repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        deltas = stored(deltas.withColumn("d", F.size("delta")).withColumn("g", (up * c("d") - down * c("n")).cast("bigint")), "deltas")
        hubs = deltas.groupBy(c("cell").alias("of")).agg(F.min(F.struct("g", "rep")).alias("hub"))
        deltas = deltas.join(hubs, c("cell") == c("of")).select(
            "cell", "rep", "delta", "d", "g", c("hub.g").alias("hub_g"), c("hub.rep").alias("hub"), (c("g") + c("hub.g") > 0).alias("far")
        )
        star = deltas.where(c("rep") != c("hub")).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))

        items = deltas.select("cell", "rep", "d", "g", "hub_g", "far", F.explode("delta").alias("item"))
        shared = items.groupBy(c("cell").alias("of"), c("item").alias("what")).agg(
            F.count(F.lit(1)).alias("often"), F.max("far").alias("any_far")
        ).where("often > 1 and any_far")
        # No longer than a difference.
        own = items.join(shared, (c("cell") == c("of")) & (c("item") == c("what"))).groupBy("cell", "rep", "d", "g", "hub_g", "far").agg(
            F.sort_array(F.collect_list(F.struct("often", "item"))).alias("own")
        )
        # The least overlap that a link with any partner needs: near members only have far partners here.
        least = F.ceil((c("g") + F.when(c("far"), c("hub_g")).otherwise(1 - c("hub_g"))) / F.lit(2.0 * up))
        take = (c("d") - F.greatest(least, F.lit(1)) + 1 - (c("d") - F.size("own"))).cast("int")
        ranked = own.select("cell", "rep", "d", "g", "far", F.size("own").alias("m"), F.posexplode(F.slice("own", F.lit(1), F.greatest(take, F.lit(0)))).alias("at", "v"))
        ranked = ranked.select("cell", c("v.item").alias("item"), "rep", "d", "g", "far", (c("d") - c("m") + c("at") + 1).alias("rank"))
        lengths = ranked.groupBy(c("cell").alias("of"), c("item").alias("what")).agg(F.count(F.lit(1)).alias("length")).where("length > 1")
        lists = stored(ranked.join(lengths, (c("cell") == c("of")) & (c("item") == c("what"))).drop("of", "what"), "cell-lists")

        need = F.ceil((c("a_g") + c("b_g")) / F.lit(2.0 * up))
        meets = (c("a_far") | c("b_far")) & (c("a_rank") <= c("a_d") - need + 1) & (c("b_rank") <= c("b_d") - need + 1)
        long = lists.where(c("length") > SHORT_CELL_LIST)
        # Divide further as long as that halves what is left.
        left = long.agg(F.countDistinct("rep")).first()[0]
        last = level == MOST_LEVELS - 1 or left > cells.count() * LEAST_GAIN
        short = lists if last else lists.where(c("length") <= SHORT_CELL_LIST)
        pairs = _pairs_within(short.drop("length"), ["cell", "item"], meets)
        made = stored(star.unionByName(pairs).distinct(), "cell-pairs")
        found = made if found is None else found.unionByName(made)
        if last or not left:
            return found
        cells = _merged(long, ["cell", "item"])
    return found


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int, k: int) -> DataFrame:
    """Links (a, b) between classes, enough of them to connect all that are linked."""
    c = F.col
    lists = _rare_values(classes)
    pairs = _pairs_within(lists.where(c("list_size") <= SHORT_LIST).select("value", "rep"), ["value"]).distinct()
    pairs = stored(_estimated(pairs, classes, percent, k), "pairs")
    long = lists.where(c("list_size") > SHORT_LIST).select("value", "rep")
    hot = not long.isEmpty()
    needed = pairs.select(c("a").alias("need")).unionByName(pairs.select(c("b").alias("need")))
    if hot:
        needed = needed.unionByName(long.select(c("rep").alias("need")))
    needed = needed.distinct().hint("shuffle_hash")
    rows = texts(docs)
    sets = rows.join(needed, c("doc_id") == c("need"), "left_semi").select(c("doc_id").alias("rep"), _setter(words)("text").alias("items"))
    sets = stored(sets.where(F.size("items") > 0), "sets")
    if hot:
        pairs = pairs.unionByName(_cells(_merged(long, ["value"]), sets, percent)).distinct()
    return _linked(pairs, sets, percent)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows are linked when the Jaccard similarity of their sets of ``words``-word
    shingles is ``percent`` of a hundred or more; a component's id is its smallest
    doc_id, whose rows are kept.  Null, empty and blank texts have no shingles and are
    linked with nothing.  Rows with a null doc_id are linked with nothing, have a null
    component_id and are kept; rows that repeat a doc_id are one document.  Columns
    other than doc_id and text are left out.
    """
    c = F.col
    rows = stored(sketches(docs, words, k), "sketches")
    named = rows.where((c("n") > 0) & c("doc_id").isNotNull())
    reps = named.groupBy("signature").agg(F.min("doc_id").alias("rep"))
    speaking = named.join(reps.withColumnRenamed("signature", "of"), (c("signature") == c("of")) & (c("doc_id") == c("rep")), "left_semi")
    classes = stored(speaking.select(c("doc_id").alias("rep"), "signature", "sketch").dropDuplicates(["rep", "signature"]), "classes")
    found = stored(links(docs, classes.select("rep", "sketch"), words, percent, k), "links")
    # A document that is in several classes, by repeated rows, connects them.
    own = named.select(c("doc_id").alias("a"), "signature").join(reps, "signature").where(c("a") != c("rep"))
    twice = named.groupBy("doc_id").agg(F.countDistinct("signature").alias("sets")).where("sets > 1").select(c("doc_id").alias("a"))
    found = found.unionByName(own.join(twice, "a").select("a", c("rep").alias("b")))
    roots = components(found)
    placed = rows.join(reps.withColumnRenamed("signature", "of"), (c("signature") == c("of")) & (c("n") > 0) & c("doc_id").isNotNull(), "left")
    placed = placed.join(roots, c("rep") == c("node"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    return placed.select("doc_id", c("n").alias("n_shingles"), F.when(c("doc_id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", same(c("doc_id"), c("component_id"))
    )
