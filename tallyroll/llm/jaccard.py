"""Exact Jaccard join of shingle sets by prefix trees.

1. Equal sets become one (their key is a checksum of the set).
2. All shingles are put in one global order, by the number of documents that have them and then
   by hash. Two linked sets have one of their first n - t n + 1 shingles in common. Shingles of
   one document alone can't be it, so only those of several are kept with their sets; a
   set whose first ones are all its own links with nothing, which settles most sets.
   Sets with a first shingle in common, and sizes that allow a link, are connected to the least of
   them; connected sets are one family.
3. In a family the sets, ordered by how many members have a shingle, are stored in a prefix
   tree. A set walks the tree once, sharing overlaps of common beginnings, and leaves subtrees
   whose remaining lengths can't reach the threshold, or whose members it is already linked
   with.
4. Components of the links found.

A family of more than `block` shingles is cut into blocks that all hold one common member, which is
enough where copies are alike; members still apart then meet block by block. So a task's
memory is bounded and nothing is dropped. Shingles are 64-bit hashes.

Defined cases. Text null or without words: no shingles, linked with nothing. Fewer than k
words: one shingle of all. Repeated ids: each row goes by its own text. Id null: component null,
and the row links nothing. Ties of the global order go by hash. Very long texts: a set is held
whole by one task. Empty table: no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroll.llm.components import components
from tallyroll.llm.shared import stored
from tallyroll.llm.shingles import mix, shingle_sets, sums_by

#: Rows of a batch that are worked on at once, by bytes of text.
_CHUNK = 1 << 20


def size_classes(num: int, den: int, most: int) -> list[int]:
    """Least sizes of classes such that linked sets are in one class or in neighbours."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, (out[-1] - 1) * den // num + 1))
    return [*out, max(out[-1] + 1, (out[-1] - 1) * den // num + 1)]


class _Node:
    __slots__ = ("segment", "children", "members", "least", "most", "one")

    def __init__(self, segment, size, member):
        self.segment, self.children, self.members = segment, {}, []
        self.least = self.most = size
        self.one = member


class Tree:
    """A prefix tree of sets of ranks, with the links that walking it finds."""

    def __init__(self, num: int, den: int, ranks: int):
        self.num, self.den = num, den
        self.root = _Node(np.zeros(0, np.int64), 0, None)
        self.root.least = 1 << 60
        self.has = np.zeros(ranks, bool)
        self.parent: list[int] = []

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def _enough(self, node: _Node, size: int, overlap: int, depth: int, rest: int) -> bool:
        """Can any set below reach the threshold? The best length is where both rests are equal."""
        best = min(max(rest + depth, node.least), node.most)
        possible = overlap + min(rest, best - depth)
        return (self.num + self.den) * possible >= self.num * (size + best)

    def links(self, x: np.ndarray, me: int) -> Iterator[int]:
        """Members linked with the set x, without those already connected to `me`."""
        self.has[x] = True
        stack = [(self.root, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            if node.one is not None and self.find(node.one) == self.find(me):
                continue
            if len(node.segment):
                overlap += int(np.count_nonzero(self.has[node.segment]))
                depth += len(node.segment)
                rest = len(x) - int(np.searchsorted(x, node.segment[-1], side="right"))
            else:
                rest = len(x)
            if not self._enough(node, len(x), overlap, depth, rest):
                continue
            if node.members and (self.num + self.den) * overlap >= self.num * (len(x) + depth):
                for other in node.members:
                    if self.find(other) != self.find(me):
                        yield other
                        self.parent[self.find(other)] = self.find(me)
            stack += [(child, overlap, depth) for child in node.children.values()]
        self.has[x] = False

    def insert(self, x: np.ndarray, me: int) -> None:
        node, at = self.root, 0
        while True:
            node.least, node.most = min(node.least, len(x)), max(node.most, len(x))
            if node.one is not None and self.find(node.one) != self.find(me):
                node.one = None
            if at == len(x):
                node.members.append(me)
                return
            child = node.children.get(int(x[at]))
            if child is None:
                leaf = _Node(x[at:], len(x), me)
                leaf.members.append(me)
                node.children[int(x[at])] = leaf
                return
            span = min(len(child.segment), len(x) - at)
            differ = np.flatnonzero(child.segment[:span] != x[at : at + span])
            same = int(differ[0]) if len(differ) else span
            if same < len(child.segment):
                upper = _Node(child.segment[:same], child.least, child.one)
                upper.most = child.most
                child.segment = child.segment[same:]
                upper.children[int(child.segment[0])] = child
                node.children[int(x[at])] = upper
                child = upper
            node, at = child, at + same


def join_family(
    sets: list[np.ndarray], groups: list[int], num: int, den: int
) -> list[tuple[int, int]]:
    """Links between the sets (positions), enough to connect all that are connected. Sets of
    one group (>= 0) count as linked already."""
    out = []
    for part in split_family(sets, num, den):
        found = _walk([sets[i] for i in part], [groups[i] for i in part], num, den)
        out += [(part[i], part[j]) for i, j in found]
    return out


def split_family(sets: list[np.ndarray], num: int, den: int) -> list[list[int]]:
    """Parts of a family that can hold links: by the family's order, rarest shingles first, two
    linked sets share one of their first n - t n + 1. Sets that share none are alone and left out."""
    size = np.array([len(s) for s in sets])
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.lexsort((rank[inverse], owner))
    within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    first = size + num * size // -den + 1
    order = order[(within < first[owner]) & (count[inverse[order]] > 1)]
    order = order[np.argsort(inverse[order], kind="stable")]
    token, own = inverse[order], owner[order]
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for at in np.flatnonzero(token[1:] == token[:-1]).tolist():
        parent[find(int(own[at]))] = find(int(own[at + 1]))
    parts: dict[int, list[int]] = {}
    for i in range(len(sets)):
        parts.setdefault(find(i), []).append(i)
    return [p for p in parts.values() if len(p) > 1]


def _walk(sets: list[np.ndarray], groups: list[int], num: int, den: int) -> list[tuple[int, int]]:
    flat = np.concatenate(sets)
    values, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(values))
    ranked = np.split(rank[inverse], np.cumsum([len(s) for s in sets])[:-1])
    tree, out, first = Tree(num, den, len(values)), [], {}
    tree.parent = [first.setdefault(g, i) if g >= 0 else i for i, g in enumerate(groups)]
    for me, x in enumerate(ranked):
        x = np.sort(x)
        out += [(me, other) for other in tree.links(x, me)]
        tree.insert(x, me)
    return out


def jaccard_components(
    docs: DataFrame,
    k: int = 3,
    num: int = 90,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = 2_000_000,
    passes: int = 2,
) -> DataFrame:
    """(id, n_shingles, component_id): components of "Jaccard >= num/den" over all documents.
    Shingles are counted in `passes` shares, to use less disk at a time."""
    id_type = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches):
            h, begin = shingle_sets(some.column("text"), k)
            keys = [pa.array(key.view(np.int64)) for key in _set_keys(h, begin)]
            yield pa.RecordBatch.from_arrays(
                [some.column("id"), pa.array(np.diff(begin), pa.int64()), *keys], names=["id", "n", "k1", "k2"]
            )

    signed = stored(own.mapInArrow(sign, f"id {id_type}, n long, k1 long, k2 long"), "jaccard-signed")

    first = _first_shingles(own, k, num, den, passes)
    rows = stored(first.select("k1", F.explode(_signatures(num, den)).alias("sig")).distinct(), "jaccard-first")
    shared = rows.groupBy("sig").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo < hi")
    # both sides shuffled on the signature at any size: shared ones grow with the input
    found = rows.join(shared.select("sig", "lo").hint("merge"), "sig").filter("k1 != lo")
    candidates = stored(found.select(F.col("k1").alias("a"), F.col("lo").alias("b")).distinct(), "jaccard-pairs")
    families = stored(components(candidates), "jaccard-families")

    sets = signed.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"))
    members = stored(
        sets.join(families, sets["k1"] == families["node"]).filter("rep IS NOT NULL")
        .select("rep", "n", "component", (F.col("k1") == F.col("component")).alias("pivot")),
        "jaccard-members",
    )
    sizes = members.groupBy("component").agg(F.sum("n").alias("shingles"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches):
            h, begin = shingle_sets(some.column("text"), k)
            lists = pa.ListArray.from_arrays(begin.astype(np.int32), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(some.column(c) for c in ("rep", "component", "pivot", "blocks")), lists],
                names=["rep", "component", "pivot", "blocks", "shingles"],
            )

    placed = members.join(sizes, "component").select(
        "rep", "component", "pivot", F.ceil(F.col("shingles") / block).cast("int").alias("blocks")
    )
    schema = f"rep {id_type}, component long, pivot boolean, blocks int, shingles array<long>"
    with_sets = stored(
        placed.hint("merge").join(own, placed["rep"] == own["id"])
        .select("rep", "component", "pivot", "blocks", "text")
        .mapInArrow(shingle, schema),
        "jaccard-sets",
    )
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    first = with_sets.withColumn("block", F.explode(F.when(F.col("pivot"), everywhere).otherwise(F.array(mine))))
    links = stored(_joined(first.withColumn("own", F.lit(-1).cast("long")), id_type, num, den), "jaccard-links")

    large = with_sets.filter("blocks > 1")
    if large.limit(1).count():
        done = components(links)
        apart = (
            large.join(done, large["rep"] == done["node"], "left")
            .withColumn("cluster", F.coalesce(done["component"], large["rep"]))
            .drop("node", done["component"])
        )
        spread = apart.groupBy("component").agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi")).filter("lo < hi")
        open_ = apart.join(spread.select("component"), "component").withColumn("mine", mine)
        pairs = F.transform(
            F.filter(everywhere, lambda b: b != F.col("mine")),
            lambda b: F.least(b, F.col("mine")) * F.col("blocks") + F.greatest(b, F.col("mine")),
        )
        second = open_.withColumn("block", F.explode(pairs)).withColumn("own", F.xxhash64("cluster"))
        links = stored(links.union(_joined(second, id_type, num, den)), "jaccard-links")
    found = components(links)

    by_set = sets.join(found, sets["rep"] == found["node"], "left").select(
        "k1", "k2", F.col("n").alias("set_n"), F.coalesce(found["component"], F.col("rep")).alias("set_component")
    )
    slim = signed.select("id", "n", "k1", "k2")
    same = (slim["k1"] == by_set["k1"]) & (slim["k2"] == by_set["k2"]) & (slim["n"] == by_set["set_n"])
    return slim.join(by_set, same, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("set_component", "id")).alias("component_id"),
    )


def _set_keys(h: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """Two checksums of each set."""
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    return [sums_by(owner, mix(h, s), len(begin) - 1) for s in (20, 21)]


def _first_shingles(own: DataFrame, k: int, num: int, den: int, passes: int) -> DataFrame:
    """(k1, n, first): for each set with any, those of its first n - t n + 1 shingles in the global order
    that several documents have.

    Each share of the shingles is shuffled once, on the shingle, and counted where it arrives: a
    count beforehand would shuffle all of them a second time. A window spills what a frequent
    shingle has too many of."""

    def shingles(share: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some in _chunks(batches):
                h, begin = shingle_sets(some.column("text"), k)
                n, key = np.diff(begin), _set_keys(h, begin)[0]
                owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
                if passes > 1:
                    chosen = h % np.uint64(passes) == share
                    h, owner = h[chosen], owner[chosen]
                columns = [h.view(np.int64), key.view(np.int64)[owner], n.astype(np.int32)[owner]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "k1", "n"])

        return own.select("text").mapInArrow(run, "h long, k1 long, n int")

    several = None
    for share in range(passes):
        docs = F.count(F.lit(1)).over(Window.partitionBy("h"))
        found = shingles(share).withColumn("docs", docs).filter("docs > 1").select("k1", "n", "docs", "h").distinct()
        found = stored(found, "jaccard-several")
        several = found if several is None else several.union(found)
    sets = several.groupBy("k1", "n").agg(F.sort_array(F.collect_list(F.struct("docs", "h"))).alias("several"))
    # as many of the first ones as are no set's own; the others come before them
    most = F.expr(f"n - (n * {num}L + {den - 1}) div {den} + 1 - (n - size(several))").cast("int")
    return (
        sets.withColumn("most", most)
        .filter("most > 0")
        .select("k1", "n", F.expr("transform(slice(several, 1, most), x -> x.h)").alias("first"))
    )


def _signatures(num: int, den: int) -> Column:
    """For each of a set's first shingles, one value for its size class and one for the class
    below: sizes of linked sets are in one class or in neighbours."""
    borders = ", ".join(f"{b}L" for b in size_classes(num, den, 1 << 31))
    # the class is worked out once, as the element of an array
    both = "c -> flatten(transform(first, h -> array(xxhash64(h, c), xxhash64(h, c - 1))))"
    return F.expr(f"flatten(transform(array(size(filter(array({borders}), b -> b <= n))), {both}))")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts have about `_CHUNK` bytes, or one row."""
    for batch in batches:
        column = batch.column("text").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1].tolist()
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, bisect.bisect_right(offsets, offsets[at] + _CHUNK) - 1)
            yield batch.slice(at, end - at)
            at = end


def _joined(rows: DataFrame, id_type: str, num: int, den: int) -> DataFrame:
    """Links (a, b) within each (component, block)."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reps, sets, groups = None, [], [], []

        def links() -> pa.RecordBatch:
            numbers = {g: i for i, g in enumerate(sorted({g for g in groups if g is not None}))}
            found = join_family(sets, [numbers.get(g, -1) for g in groups], num, den) if len(sets) > 1 else []
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([reps[i] for i, _ in found], kind), "b": pa.array([reps[j] for _, j in found], kind)}
            )

        kind = None
        for batch in batches:
            kind = batch.schema.field("rep").type
            columns = (batch.column(c).to_pylist() for c in ("component", "block", "rep", "own"))
            for component, block, rep, own, s in zip(*columns, batch.column("shingles"), strict=True):
                if (component, block) != key:
                    if len(reps) > 1:
                        yield links()
                    key, reps, sets, groups = (component, block), [], [], []
                reps.append(rep)
                sets.append(s.values.to_numpy().view(np.uint64))
                groups.append(None if own == -1 else own)
        if len(reps) > 1:
            yield links()

    keyed = rows.select("component", "block", "rep", "own", "shingles")
    return keyed.repartition("component", "block").sortWithinPartitions("component", "block", "rep").mapInArrow(
        walk, f"a {id_type}, b {id_type}"
    )


def first_of_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents that are the first (least id) of their component, with all their columns.
    Rows with a null id stay. An id with several texts stays with those that are first. Of rows alike
    in id and text one stays, by the least checksum of all columns."""
    found = jaccard_components(docs, id_col=id_col, text_col=text_col, **options)
    by_id = stored(
        found.filter(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(F.col("component_id") < F.col(id_col)).alias("later"), F.count(F.lit(1)).alias("rows"))
        .filter("later OR rows > 1"),
        "jaccard-later",
    )
    single = docs.join(by_id.hint("merge"), docs[id_col] == by_id["id"], "left_anti")
    names = [f"c{i}" for i in range(len(docs.columns))]
    own, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    several = docs.toDF(*names).join(by_id.filter("NOT later").select("id"), F.col(own) == F.col("id"), "left_semi")
    order = Window.partitionBy(own, F.xxhash64(text), F.md5(F.col(text).cast("binary"))).orderBy("_row")
    kept = several.withColumn("_row", F.xxhash64(*names)).withColumn("_first", F.row_number().over(order) == 1)
    return single.unionByName(kept.filter("_first").select(*names).toDF(*docs.columns))


def jaccard(spark, sf_dir: str) -> DataFrame:
    """Query op5: components of documents whose 3-word shingles are 90 % the same."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
