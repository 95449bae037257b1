"""Near-duplicate groups: fast similarity sketching, banding, exact verification, connected components.

Method. A text is the set of its word shingles, each a 64-bit hash. A sketch has T coordinates. In round i < T every shingle is
hashed into one coordinate with the value i plus a fraction; in round T + j every shingle is put into coordinate j; a coordinate
keeps its smallest value, and a text stops as soon as no coordinate is empty, after 2T rounds at the latest. Equal sketches
share coordinates with the probability of the Jaccard similarity, with concentration. Texts that agree on a whole band of
coordinates meet in a bucket.

All pairs of a bucket are never made. Texts with equal shingle sets are one node. In every bucket the node with the smallest id
is the pivot, and the others are compared with it on full sets. That yields components, and for each node its exact distance
to its pivots. Nodes of one pivot that are still in different components could only be linked if their distances to the pivot
differ by no more than the allowed distance (the triangle inequality of the Jaccard distance). Those are compared on full sets,
in blocks of bounded size that are spread over the tasks; a block returns only links that join components. So no link found by a
bucket is lost, whatever its size.

Copies stay outside the graph: labels spread over distinct sets alone, and each document then looks up its set's label. Sets with
more than a ten-thousandth of all documents, at most ten thousand of them, are looked up in a broadcast list, so no task gets the
copies of one set.

At a similarity of 0.85, the chance that a link meets in none of the 42 bands of 7 is (1 - 0.85^7)^42, about 9e-8.

Defined cases. Texts with fewer words than a shingle have one shingle, the whole sequence. NULL texts and texts without words have
an empty set and are linked with nothing. Rows with the same id are one node: the union of their links counts. A NULL id is linked
with nothing, its component is NULL and `kept` is true. Only the id and the text are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import Words, bit_table, in_slices, marked, mix, seed, stored, texts_of, window_hashes


# A key with more than one in so many rows is frequent; there are at most so many such keys.
FREQUENT = 10_000
SET = ["set_a", "set_b", "n"]


@dataclass(frozen=True)
class Rule:
    """Shingles of `words` words are linked from `percent` hundredths of Jaccard similarity; sketches have bands * rows coordinates."""

    words: int = 3
    percent: int = 85
    bands: int = 42
    rows: int = 7
    # Members of a pivot that one task compares with it, and the sides of a block of the second comparison.
    group: int = 256
    block: int = 256

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def linked(self, shared: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Whether sets with `shared` common and `total` added sizes are linked."""
        return 100 * shared >= self.percent * (total - shared)


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash) pairs, sorted by text and hash."""
    found = Words(pc.ascii_lower(texts))
    values = found.hashes()[found.codes] if len(found.codes) else np.zeros(0, np.uint64)
    at = found.windows(words)
    doc, made = [found.doc[at]], [window_hashes(values, at, words)]
    for n in range(1, words):
        short = np.flatnonzero(found.counts == n)
        doc.append(short)
        made.append(window_hashes(values, found.starts[short], n))
    docs, sets = np.concatenate(doc), np.concatenate(made)
    order = np.lexsort((sets, docs))
    docs, sets = docs[order], sets[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (sets[1:] != sets[:-1])
    return docs[new], sets[new]


def sketch(docs: np.ndarray, sets: np.ndarray, texts: int, size: int) -> np.ndarray:
    """One row of `size` coordinates per text; rows of empty sets stay at the maximum."""
    out = np.full(texts * size, np.iinfo(np.uint64).max, np.uint64)
    live_docs, live = docs, sets
    for i in range(2 * size):
        if not len(live):
            break
        drawn = mix(live ^ seed(1000 + i))
        if i < size:
            place = ((drawn >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            drawn = mix(drawn)
        else:
            place = np.full(len(live), i - size)
        value = (np.uint64(i) << np.uint64(50)) | (drawn >> np.uint64(14))
        np.minimum.at(out, live_docs * size + place, value)
        if i % 4 == 3 or i >= size:
            open_rows = (out.reshape(texts, size) == np.iinfo(np.uint64).max).any(axis=1)
            keep = open_rows[live_docs]
            if not keep.all():
                live_docs, live = live_docs[keep], live[keep]
    return out.reshape(texts, size)


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, and one hash per band (none for empty sets)."""

    def work(texts: pa.Array, others: dict[str, pa.Array]) -> dict[str, object]:
        doc, sets = shingles(texts, rule.words)
        n = np.bincount(doc, minlength=len(texts))
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        whole = [np.zeros(len(texts), np.uint64) for _ in range(2)]
        if len(first):
            for k in range(2):
                whole[k][doc[first]] = np.add.reduceat(mix(sets ^ seed(50 + k)), first)
        bands = band_hashes(sketch(doc, sets, len(texts), rule.size), rule)
        ends = np.cumsum(np.concatenate([[0], np.where(n > 0, rule.bands, 0)])).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[n > 0].ravel().view(np.int64)))
        return {"doc_id": others["doc_id"], "n": n, "set_a": whole[0].view(np.int64), "set_b": whole[1].view(np.int64), "bands": listed}

    return in_slices(docs, ["doc_id", "text"], "doc_id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>", work)


def band_hashes(coordinates: np.ndarray, rule: Rule) -> np.ndarray:
    parts = coordinates.reshape(len(coordinates), rule.bands, rule.rows)
    total = np.broadcast_to(mix(np.arange(rule.bands, dtype=np.uint64) + np.uint64(77)), parts.shape[:2]).copy()
    for k in range(rule.rows):
        total = mix(total ^ parts[:, :, k]) + np.uint64(k)
    return total


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of undirected edges (a, b).

    Labels spread along edges and jump to the label of their label, until nothing changes.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        far = step.select(F.col("node").alias("at"), F.col("new").alias("far"))
        jumped = stored(
            step.join(far, F.col("new") == F.col("at"), "left").select("node", "old", F.least("new", F.coalesce("far", "new")).alias("component")), "labels"
        )
        labels = jumped.select("node", "component")
        if jumped.where("old != component").isEmpty():
            return labels


def compare_to_pivot(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """(node, pivot, n, shared) for pairs (node, pivot, n): the exact size of the intersection of their sets.

    The members of a pivot are dealt over groups of about `rule.group`; the pivot's text goes to each of its groups.
    """
    sized = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / rule.group).cast("int").alias("parts"))
    members = pairs.join(sized, "pivot").select(F.col("node").alias("doc_id"), "pivot", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"), "n")
    pivots = sized.select(F.col("pivot").alias("doc_id"), "pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(-1).cast("bigint").alias("n"))
    placed = members.unionByName(pivots).join(docs, "doc_id").select("doc_id", "pivot", "part", "n", "text")

    def group(rows: pa.Table) -> pa.Table:
        is_pivot = pc.equal(rows["doc_id"], rows["pivot"])
        doc, sets = shingles(texts_of(rows["text"].combine_chunks()), rule.words)
        own = sets[is_pivot.to_numpy()[doc]]
        hit = np.isin(sets, own)
        shared = np.bincount(doc[hit], minlength=len(rows))
        out = pa.table({"node": rows["doc_id"], "pivot": rows["pivot"], "n": rows["n"], "shared": pa.array(shared, pa.int64()), "pivot_n": pa.array(np.full(len(rows), len(own)), pa.int64())})
        return out.filter(pc.invert(is_pivot))

    return placed.groupBy("pivot", "part").applyInArrow(group, "node bigint, pivot bigint, n bigint, shared bigint, pivot_n bigint")


def open_blocks(compared: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """(pivot, i, j, side, node, d, component): nodes of one pivot that the pivot has not settled, dealt into blocks.

    Members outside the pivot's component are the queries (side 0); they meet all members of the pivot (side 1). Within a pivot,
    a node lies in a cell of the width of the allowed distance; only neighbouring cells can hold links, so a query goes to its own
    cell and the two beside it, and both sides are cut into blocks.
    """
    far = (100 - rule.percent) / 100
    d = 1 - F.col("shared") / (F.col("n") + F.col("pivot_n") - F.col("shared"))
    own = labels.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_component"))
    members = (
        compared.withColumn("d", d).join(labels, "node", "left").join(own, "pivot", "left")
        .select("pivot", "node", "d", F.coalesce("component", "node").alias("component"), F.coalesce("pivot_component", "pivot").alias("pivot_component"))
        .withColumn("cell", F.floor(F.col("d") / far).cast("int"))
    )
    members = stored(members, "members")
    queries = members.where("component != pivot_component")
    beside = queries.select("pivot", "node", "d", "component", F.explode(F.array(*[F.col("cell") + k for k in (-1, 0, 1)])).alias("cell"))
    # Cells in which all belong to one component have nothing to join.
    cells = (
        beside.groupBy("pivot", "cell").agg(F.count("*").alias("queries"), F.min("component").alias("low"), F.max("component").alias("high"))
        .join(
            members.groupBy("pivot", "cell").agg(F.count("*").alias("members"), F.min("component").alias("first"), F.max("component").alias("last")),
            ["pivot", "cell"],
        )
        .where("least(low, first) != greatest(high, last)")
        .select("pivot", "cell", F.ceil(F.col("queries") / rule.block).cast("int").alias("qs"), F.ceil(F.col("members") / rule.block).cast("int").alias("ms"))
    )
    left = beside.join(cells, ["pivot", "cell"]).select(
        "pivot", "cell", F.pmod(F.xxhash64("node"), "qs").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("ms") - 1)).alias("j"), F.lit(0).alias("side"), "node", "d", "component"
    )
    right = members.join(cells, ["pivot", "cell"]).select(
        "pivot", "cell", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("i"), F.pmod(F.xxhash64("node"), "ms").cast("int").alias("j"), F.lit(1).alias("side"), "node", "d", "component"
    )
    return left.unionByName(right)


def compare_blocks(docs: DataFrame, blocks: DataFrame, rule: Rule) -> DataFrame:
    """Edges (a, b) between nodes of different components, on full sets; of each block only those that join components."""
    far = (100 - rule.percent) / 100 + 1e-9
    placed = blocks.join(docs.withColumnRenamed("doc_id", "node"), "node").select("pivot", "cell", "i", "j", "side", "node", "d", "component", "text")

    def group(rows: pa.Table) -> pa.Table:
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        side = rows["side"].to_numpy()
        q, m = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(q) or not len(m):
            return empty
        doc, sets = shingles(texts_of(rows["text"].combine_chunks()), rule.words)
        node, d, comp = (rows[c].to_numpy() for c in ("node", "d", "component"))
        n = np.bincount(doc, minlength=len(rows))
        ends = np.searchsorted(doc, np.arange(len(rows) + 1))
        # Shingles of the members, sorted, so that one query finds all its partners at once.
        in_m = side[doc] == 1
        order = np.argsort(sets[in_m], kind="stable")
        keys, owner = sets[in_m][order], doc[in_m][order]
        found: dict[int, int] = {}

        def root(c: int) -> int:
            while found.get(c, c) != c:
                c = found[c]
            return c

        a, b = [], []
        for k in q:
            own = sets[ends[k] : ends[k + 1]]
            lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            size = hi - lo
            take = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            shared = np.bincount(owner[take], minlength=len(rows))
            linked = rule.linked(shared, n + n[k]) & (shared > 0) & (side == 1) & (comp != comp[k]) & (np.abs(d - d[k]) <= far)
            for other in np.flatnonzero(linked):
                x, y = root(int(comp[k])), root(int(comp[other]))
                if x != y:
                    found[max(x, y)] = min(x, y)
                    a.append(int(node[k]))
                    b.append(int(node[other]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.groupBy("pivot", "cell", "i", "j").applyInArrow(group, "a bigint, b bigint")


def candidates(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with these ids. A bit table of 16 bits an id, 8 MB at most, keeps most of the others out of the shuffle."""
    words = 1 << min(20, max(10, (ids.count() // 4).bit_length()))
    table = bit_table(ids.selectExpr("xxhash64(node) AS h"), words)
    likely = marked(docs.withColumn("id_hash", F.xxhash64("doc_id")), "id_hash", table, words).drop("id_hash")
    return likely.join(ids, F.col("doc_id") == F.col("node"), "left_semi")


def looked_up(rows: DataFrame, values: DataFrame, key: list[str], frequent: DataFrame) -> DataFrame:
    """`rows` with the columns of `values`, which has one row per key; the keys of `frequent`, FREQUENT at most, are broadcast."""
    few, many = (values.join(F.broadcast(frequent), key, how) for how in ("left_semi", "left_anti"))
    rest = rows.join(F.broadcast(frequent), key, "left_anti")
    return rows.join(F.broadcast(few), key).unionByName(rest.join(many, key))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = stored(sketches(docs, rule), "sketches")
    known = made.where("doc_id IS NOT NULL AND n > 0")
    # Equal sets are one node, the smallest id. Combined in the map tasks: a set with a third of all documents sends one row a task.
    nodes = stored(known.groupBy(*SET).agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("node"), F.count("*").alias("copies")), "nodes")
    frequent = stored(nodes.where(F.col("copies") * FREQUENT > known.count()).select("node", *SET), "frequent")
    placed = stored(looked_up(known.select("doc_id", *SET), nodes.select(*SET, "node"), SET, frequent.select(*SET)).select("doc_id", "n", "node"), "placed")
    banded = nodes.select("node", "n", F.explode("bands").alias("band"))
    pivots = banded.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("c")).where("c > 1").select("band", "pivot")
    pairs = stored(banded.join(pivots, "band").where("node != pivot").select("node", "pivot", "n").distinct(), "pairs")
    texts = stored(candidates(docs, stored(pairs.select("node").union(pairs.select("pivot")).distinct(), "ids")), "candidates")
    compared = stored(compare_to_pivot(texts, pairs, rule), "compared")
    star = compared.where(f"100 * shared >= {rule.percent} * (n + pivot_n - shared)").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    # An id with several sets links their nodes.
    several = placed.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("doc_id", "low")
    same = placed.join(several, "doc_id").where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    edges = stored(star.unionByName(same).distinct(), "links")
    labels = components(edges)
    more = stored(compare_blocks(texts, open_blocks(compared, labels, rule), rule), "more")
    if not more.isEmpty():
        labels = components(edges.unionByName(more))
    label = nodes.select("node").distinct().join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    found = stored(looked_up(placed, label, ["node"], frequent.select("node").distinct()).select("doc_id", "n", "component"), "found")
    # Empty sets have the component of their id's other texts, if there are any.
    by_id = found.groupBy("doc_id").agg(F.min("component").alias("component"))
    empty = made.where("doc_id IS NOT NULL AND n = 0").select("doc_id", "n").join(by_id, "doc_id", "left")
    unnamed = made.where("doc_id IS NULL").select("doc_id", "n", F.lit(None).cast("bigint").alias("component"))
    component = F.coalesce("component", "doc_id")
    return (
        found.unionByName(empty).unionByName(unnamed)
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    )


def one_of_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """The rows of `docs` with the smallest id of their group; of several rows with that id, one of each text.

    Rows without an id are all kept. NULL is a text of its own.
    """
    lost = near_duplicates(docs, rule).where("NOT kept").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(lost, "doc_id", "left_anti").select(*docs.columns)
    return named.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))
