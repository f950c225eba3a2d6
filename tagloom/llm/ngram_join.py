"""Set-similarity self-join on word n-grams (Jaccard), with a count-vector R-tree.

Exact, in four steps, none of which gathers a group in one place unsplit:

1. Candidates. Documents fall into bands by set size. Within a band each
   document's n-grams are hashed into more groups than two linked documents can
   differ in, so linked documents have a non-empty group with equal content
   (see ``Bands``). Hashes of (band, group, content) go through one exchange,
   packed into blocks. Documents with an equal hash form a cell; cells with the
   same members are one. In a cell, group counts are points in an R-tree: a
   pair of nodes is passed over when the summed minima of its largest counts is
   too small for any link, and pairs whose own summed minima allow a link are
   joined to candidate clusters. So documents that share only a passage part.
   Very large cells are passed over by documents that must meet any partner in
   another cell too (``Bands``); those of the others are joined unseen.
2. Equal sets become one class (its smallest id); only classes in a cluster with
   others are looked at again; their texts are fetched once.
3. Join. Each cluster is dealt into blocks of bounded size. In a block the
   R-tree's pairs are verified on the sets, unless already connected. Every
   block of a cluster also holds the same few pivots, which connects what is
   alike across blocks.
4. Where a cluster of several blocks has not become one component, the classes
   outside its largest component are joined with every block of the cluster.

Edge cases: null and empty texts have the empty set and link with nothing; with
fewer words than n the whole sequence is the one element; rows that repeat an id
count as one document; a null id has a null component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, written
from .components import Forest, components
from .hashing import WordHasher, mix


@dataclass(frozen=True)
class JoinSpec:
    n: int = 4
    #: Two sets link when den * |intersection| >= num * |union|.
    num: int = 85
    den: int = 100
    #: Points of a leaf, children of a node.
    leaf: int = 32
    fan: int = 8
    #: Members of a cell that are looked at together.
    cell: int = 2_000
    #: Set elements in a block of a cluster, classes that all its blocks share.
    block_elements: int = 2_000_000
    pivots: int = 16
    #: Signatures that a task holds before it packs them.
    buffer: int = 400_000


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-gram hashes of a document's word hashes."""
    if not len(words):
        return np.empty(0, np.uint64)
    k = min(n, len(words))
    m = len(words) - k + 1
    h = np.full(m, np.uint64(k))
    for i in range(k):
        h = mix(h + words[i : i + m])
    return np.unique(h)


def groups_of(n: int) -> int:
    """Groups of a count vector: enough that unrelated sets of this size fall below the bound. Powers of four; a smaller vector is a fold of a larger."""
    g = 64
    while g < 0.04 * n and g < 4096:
        g *= 4
    return g


def counts(s: np.ndarray, g: int) -> np.ndarray:
    return np.bincount((mix(s) % np.uint64(g)).astype(np.int64), minlength=g).astype(np.int32)


class Bands:
    """Size bands and the number of groups in each.

    For linked sets a, b with |a| in a band and |b| not smaller, the symmetric
    difference has at most H elements. With H + 1 + e groups at least e + 1
    agree, so unless both sets leave more than e groups empty, a non-empty one
    does. A set with more than e empty groups emits its empty groups as well.
    Groups whose content very many sets share count like empty ones: up to e of
    both together may be passed over. What is left of e is the set's slack.
    """

    def __init__(self, spec: JoinSpec):
        self.spec, self.low, self.k, self.e = spec, [], [], []
        x = spec.num / spec.den
        low = 1
        while low < 2**31:
            high = max(low + 1, int(low * 1.6)) if low > 5 else low + 1
            # na <= high - 1, nb <= na / x
            nb = (high - 1) * spec.den // spec.num
            differ = int((high - 1 + nb) * (1 - x) / (1 + x) + 1e-9)
            e = 0
            if differ:
                e = next((e for e in range(0, 2 * differ + 4, 1 + differ // 50) if e >= self._empty(low, differ + 1 + e)), 2 * differ + 4)
            self.low.append(low)
            self.k.append(differ + 1 + e)
            self.e.append(e)
            low = high
        self.low = np.array(self.low)

    @staticmethod
    def _empty(n: int, k: int) -> float:
        """Four standard deviations above the mean number of k groups that n elements leave empty."""
        mean, load = k * (1 - 1 / k) ** n, n / k
        return mean + 4 * max(0.0, k * np.exp(-load) * (1 - (1 + load) * np.exp(-load))) ** 0.5

    def signatures(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """Signatures of a set in its bands, and its slack (-1: none of its groups may be passed over)."""
        n = len(s)
        if not n:
            return np.empty(0, np.uint64), -1
        b = int(np.searchsorted(self.low, n, "right")) - 1
        mixed = mix(s ^ np.uint64(0x2545F4914F6CDD1D))
        out = [self._of_band(s, mixed, b)]
        if b and self.spec.den * (self.low[b] - 1) >= self.spec.num * n:  # it may link with a set of the band below
            out.append(self._of_band(s, mixed, b - 1))
        return np.concatenate([x for x, _ in out]), min(slack for _, slack in out)

    def _of_band(self, s: np.ndarray, mixed: np.ndarray, b: int) -> tuple[np.ndarray, int]:
        k = self.k[b]
        group = ((s >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # s is sorted, and so is this
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sums, groups = np.add.reduceat(mixed, starts), group[starts]
        slack = max(-1, self.e[b] - (k - len(starts)))
        if slack < 0:
            empty = np.setdiff1d(np.arange(k, dtype=np.uint64), groups)
            sums, groups = np.concatenate((sums, np.zeros(len(empty), np.uint64))), np.concatenate((groups, empty))
        return mix(sums ^ mix(np.uint64(b << 40) + groups + np.uint64(1))), slack


def _key(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return tuple(x - (1 << 64) if x >> 63 else x for x in (d >> 64, d & ((1 << 64) - 1)))


def _pairs(sigs: list[np.ndarray], nodes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (signature, node), sorted."""
    sig, node = np.concatenate(sigs), np.concatenate(nodes)
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.concatenate(([True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])))
    return sig[new], node[new]


def _blocks(p: int, sig: np.ndarray, node: np.ndarray) -> list[tuple[int, bytes]]:
    """(bucket, packed signatures and nodes); buckets are ranges of signatures, which are sorted."""
    bucket = ((sig >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)
    cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(sig)])) if len(sig) else [0]
    return [(int(bucket[i]), sig[i:j].tobytes() + node[i:j].tobytes()) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _cells(sig: np.ndarray, node: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of cells with several members: cell number and member, each member list once; and, as pairs, signature and member of cells over the limit."""
    starts = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(sig)])))
    number = mix(np.add.reduceat(mix(node.view(np.uint64)), starts) ^ sizes.astype(np.uint64)).view(np.int64)
    _, first = np.unique(number, return_index=True)
    chosen = np.zeros(len(starts), bool)
    chosen[first] = True
    small, large = np.repeat(chosen & (sizes > 1) & (sizes <= limit), sizes), np.repeat(sizes > limit, sizes)
    return np.repeat(number, sizes)[small], node[small], np.stack((sig.view(np.int64), node), 1)[large]


FOUND = "kind byte, a long, b long, n long, lo long, slack long, counts binary"


def _found(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    nothing = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), nothing, nothing, nothing, pa.nulls(len(a), pa.binary())], ["kind", "a", "b", "n", "lo", "slack", "counts"])


def _candidates(docs: DataFrame, spec: JoinSpec, parts: int) -> DataFrame:
    """Rows of FOUND. Kind 1: cell a has node b. Kind 2: document a has node b, set size n, the other key half lo, its slack and its count vector. Kind 3: very large cell a has node b."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bands = WordHasher(), Bands(spec)
        sigs, nodes, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            rows = [(p, data, None, None, None, None) for p, data in (_blocks(parts, *_pairs(sigs, nodes)) if sigs else ())]
            rows += [((doc or 0) % parts, None, doc, hi, n, (lo, slack, vec)) for doc, hi, n, lo, slack, vec in ids]  # by id: copies have one key
            kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            columns += [pa.array([r[5] and r[5][i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["p", "data", "a", "b", "n", "lo", "slack", "counts"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingles(hasher.of(text, lower=True), spec.n)
                hi, lo = _key(s)
                found, slack = bands.signatures(s)
                ids.append((doc, hi, len(s), lo, slack, counts(s, groups_of(len(s))).tobytes()))
                if len(s):
                    sigs.append(found)
                    nodes.append(np.full(len(sigs[-1]), hi, np.int64))
                    held += len(sigs[-1])
                if held >= spec.buffer or len(ids) >= 20_000:
                    yield flush()
                    sigs, nodes, ids, held = [], [], [], 0
        if ids:
            yield flush()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, nodes = [], []
        for b in batches:
            for data in b.column(1).drop_null().to_pylist():
                half = len(data) // 2
                sigs.append(np.frombuffer(data[:half], np.uint64))
                nodes.append(np.frombuffer(data[half:], np.int64))
            own = b.filter(b.column(1).is_null())
            if own.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(own.num_rows, 2, np.int8)), *own.columns[2:]], ["kind", "a", "b", "n", "lo", "slack", "counts"])
        if sigs:
            sig, node = _pairs(sigs, nodes)
            sigs, nodes = [], []
            cell, member, large = _cells(sig, node, spec.cell)
            if len(cell):
                yield _found(1, cell, member)
            if len(large):
                yield _found(3, large[:, 0], large[:, 1])

    packed = docs.transform(mapped, pack, "p int, data binary, a long, b long, n long, lo long, slack long, counts binary").repartition(parts, "p")
    return packed.transform(mapped, unpack, FOUND)


def _clusters(found: DataFrame, spec: JoinSpec) -> DataFrame:
    """node, root of the candidate clusters: components of the pairs in a cell whose count vectors allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, now, rows = Forest(), None, []

        def finish() -> list[tuple[int, int]]:
            if len({forest.root(r[0]) for r in rows}) < 2:
                return []
            g = min(len(r[2]) for r in rows)
            points = np.array([r[2].reshape(-1, g).sum(0) for r in rows])
            tree = CountTree(points, np.array([r[1] for r in rows], np.int64), spec)
            out = []
            for i, (node, _, _) in enumerate(rows):
                for j in tree.near(i).tolist():
                    if forest.join(node, rows[j][0]):
                        out.append((node, rows[j][0]))
            return out

        def batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

        for b in batches:
            out: list[tuple[int, int]] = []
            for cell, node, n, vec in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if cell != now:
                    out += finish() if len(rows) > 1 else []
                    now, rows = cell, []
                rows.append((node, n, np.frombuffer(vec, np.int32)))
            yield batch(out)
        if len(rows) > 1:
            yield batch(finish())

    nodes = found.filter("kind = 2").groupBy(F.col("b").alias("node")).agg(F.first("n").alias("n"), F.first("slack").alias("slack"), F.first("counts").alias("counts"))
    cells = found.filter("kind = 1").select(F.col("a").alias("cell"), F.col("b").alias("node")).distinct()
    members = cells.join(nodes, "node").select("cell", "node", "n", "counts").repartition("cell").sortWithinPartitions("cell", "node")
    seen = members.transform(mapped, run, "a long, b long")
    # Very large cells: who has no more of them than its slack meets its partners elsewhere.
    large = found.filter("kind = 3").select(F.col("a").alias("cell"), F.col("b").alias("node"))
    bound_to = large.groupBy("node").agg(F.count(F.lit(1)).alias("c")).join(nodes, "node").filter("c > slack").select("node")
    kept = large.join(bound_to, "node")
    heads = kept.groupBy("cell").agg(F.min("node").alias("head"))
    unseen = kept.join(heads, "cell").filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return components(seen.union(unseen))


class CountTree:
    """R-tree over count vectors: nodes hold the largest count of each group and the smallest set size below them."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, spec: JoinSpec):
        self.spec, self.points, self.sizes = spec, points, sizes
        # Packed bottom-up: by size, then within runs of sizes by the first counts.
        order = np.lexsort((self.points[:, 2], self.points[:, 1], self.points[:, 0], self.sizes))
        self.order = order
        high, low = self._level(self.points[order], self.sizes[order], spec.leaf)
        self.levels = [(high, low)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._level(*self.levels[-1], spec.fan))

    @staticmethod
    def _level(high: np.ndarray, low: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
        starts = np.arange(0, len(low), fan)
        return np.maximum.reduceat(high, starts), np.minimum.reduceat(low, starts)

    def may_link(self, point: np.ndarray, size: int, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Whether anything below each node can link: intersection >= num / (num + den) * (sum of sizes) is needed."""
        most = np.minimum(high, point).sum(1)
        return (self.spec.num + self.spec.den) * most >= self.spec.num * (size + low)

    def near(self, i: int) -> np.ndarray:
        """Members whose bound allows a link with member i."""
        point, size = self.points[i], self.sizes[i]
        nodes = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low = self.levels[depth]
            nodes = nodes[self.may_link(point, size, high[nodes], low[nodes])]
            fan = self.spec.leaf if depth == 0 else self.spec.fan
            nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
            nodes = nodes[nodes < (len(self.sizes) if depth == 0 else len(self.levels[depth - 1][1]))]
            if not len(nodes):
                return nodes
        found = self.order[nodes]
        return found[self.may_link(point, size, self.points[found], self.sizes[found])]


def block_links(ids: list[int], sets: list[np.ndarray], asks: list[bool], spec: JoinSpec, forest: Forest) -> list[tuple[int, int]]:
    """Links that connect what the block's links connect: pairs with an asking member that are not connected yet are verified."""
    if len(ids) < 2:
        return []
    g = min(256, groups_of(max(map(len, sets))))
    tree = CountTree(np.array([counts(s, g) for s in sets]), np.array([len(s) for s in sets], np.int64), spec)
    # Elements as small numbers, so that an intersection is a sum over marks.
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(tree.sizes)
    starts = ends - tree.sizes
    mark = np.zeros(int(flat.max()) + 1, np.int32)
    out = []
    ask = np.array(asks)
    for i in range(len(ids)):
        if not asks[i]:
            continue
        near = tree.near(i)
        near = near[(near != i) & ~(ask[near] & (near < i))]
        root = forest.root(ids[i])
        near = [j for j in near.tolist() if forest.root(ids[j]) != root]
        if not near:
            continue
        mine = flat[starts[i] : ends[i]]
        mark[mine] = 1
        for j in near:
            both = int(mark[flat[starts[j] : ends[j]]].sum())
            if spec.den * both >= spec.num * (tree.sizes[i] + tree.sizes[j] - both) and forest.join(ids[i], ids[j]):
                out.append((ids[i], ids[j]))
        mark[mine] = 0
    return out


def _linked(members: DataFrame, docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """Links (a, b) within each (cluster, block) of members(doc, node, lo, comp, places array<struct<cluster, block, asks>>); comp is the component known so far.

    Texts travel, not sets: they are smaller. The sets are computed where they are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, hasher = None, [], WordHasher()

        def finish() -> list[tuple[int, int]]:
            forest = Forest()
            for doc, comp, _, _ in rows:
                forest.join(doc, comp)
            return block_links([r[0] for r in rows], [r[3] for r in rows], [r[2] for r in rows], spec, forest)

        def batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

        for b in batches:
            out: list[tuple[int, int]] = []
            for cluster, block, doc, comp, asks, node, lo, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (cluster, block) != now:
                    out += finish() if rows else []
                    now, rows = (cluster, block), []
                if rows and rows[-1][0] == doc:
                    continue
                s = shingles(hasher.of(text, lower=True), spec.n)
                if _key(s) == (node, lo):  # else another row with this id
                    rows.append((doc, comp, asks, s))
            yield batch(out)
        if rows:
            yield batch(finish())

    # A sort-merge join at every size: members grow with the input, and so would a broadcast.
    placed = docs.join(members.hint("merge"), "doc").select("doc", "comp", "node", "lo", "text", F.explode("places").alias("x"))
    placed = placed.select("x.cluster", "x.block", "doc", "comp", "x.asks", "node", "lo", "text")
    return placed.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "doc", F.desc("asks")).transform(mapped, run, "a long, b long")


def _place(block, asks: bool):
    return F.struct("cluster", block.cast("int").alias("block"), F.lit(asks).alias("asks"))


def linked_documents(docs: DataFrame, spec: JoinSpec = JoinSpec(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs; component_id is the smallest id reachable by links."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    # Blocks of the one large exchange follow the input: some tens of MB each, whatever its size.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * docs.rdd.getNumPartitions())
    found = written(_candidates(docs, spec, parts), "candidates")
    ids = found.filter("kind = 2").select(F.col("a").alias("doc"), F.col("b").alias("node"), "n", "lo")
    clusters = _clusters(found, spec).select("node", F.col("root").alias("cluster"))

    # Classes of equal sets in clusters, dealt into blocks by a hash.
    classes = ids.filter("n > 0 and doc is not null").groupBy("node", "lo").agg(F.min("doc").alias("doc"), F.first("n").alias("n")).join(clusters, "node")
    classes = written(classes.select("doc", "node", "lo", "n", "cluster"), "classes")
    sized = classes.groupBy("cluster").agg(F.sum("n").alias("all"), F.min(F.struct(F.xxhash64("doc").alias("h"), F.col("doc").alias("d"))).alias("least"), F.count(F.lit(1)).alias("members"))
    sized = sized.filter("members > 1").select("cluster", F.ceil(F.col("all") / spec.block_elements).cast("int").alias("nblocks"), (F.lit(spec.pivots) / F.col("members")).alias("share"))
    # A member of a split cluster is a pivot with the chance that makes about ``pivots`` of them.
    is_pivot = (F.col("nblocks") > 1) & (F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    members = classes.join(sized, "cluster").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("nblocks")).cast("int")).withColumn("pivot", is_pivot)
    every = F.sequence(F.lit(0), F.col("nblocks") - 1)
    first_round = members.select("doc", "node", "lo", F.col("doc").alias("comp"), F.transform(F.when(F.col("pivot"), every).otherwise(F.array("block")), lambda x: _place(x, True)).alias("places"))
    links = written(_linked(first_round, docs, spec), "links")

    # What is still apart in clusters of several blocks: the classes outside the largest component ask every block.
    split = members.filter("nblocks > 1")
    if not split.isEmpty():
        joined = components(links)
        state = written(split.join(joined, split["doc"] == joined["node"], "left").select(split["*"], F.coalesce("root", "doc").alias("comp")), "state")
        sizes = state.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
        total = sizes.groupBy("cluster").agg(F.max(F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("k")).filter("k > 1")
        small = sizes.join(total, "cluster").filter("comp <> top.comp").groupBy("cluster").agg(F.sum("w").alias("small"))
        rest = state.join(total.join(small, "cluster").select("cluster", F.col("top.comp").alias("top"), F.ceil(F.col("small") / spec.block_elements).cast("int").alias("nasks")), "cluster")
        q = F.pmod(F.xxhash64("doc", F.lit(3)), F.col("nasks")).cast("int")
        asked = F.transform(F.sequence(F.lit(0), F.col("nasks") - 1), lambda x: _place(x * F.col("nblocks") + F.col("block"), False))
        asking = F.when(F.col("comp") != F.col("top"), F.transform(every, lambda x: _place(q * F.col("nblocks") + x, True))).otherwise(F.array().cast("array<struct<cluster:bigint,block:int,asks:boolean>>"))
        links = links.union(_linked(rest.select("doc", "node", "lo", "comp", F.concat(asked, asking).alias("places")), docs, spec))

    roots = components(links)
    first = ids.filter("n > 0 and doc is not null").groupBy("node", "lo").agg(F.min("doc").alias("rep"))
    rooted = first.join(roots, first["rep"] == roots["node"], "left").select(first["node"], first["lo"], F.coalesce("root", "rep").alias("component"))
    whole = ids.join(rooted, ["node", "lo"], "left")
    return whole.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"))


def one_of_each(docs: DataFrame, spec: JoinSpec = JoinSpec(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the smallest id of their component, with all their columns.

    Of rows that repeat id and text one stays. Links are between ids: rows with one id and different texts all stay or all go.
    """
    kept = linked_documents(docs, spec, key, text).filter("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    whole = docs.filter(F.col(key).isNotNull()).join(kept, key, "left_semi")
    return whole.dropDuplicates([key, text]).unionByName(docs.filter(F.col(key).isNull()))
