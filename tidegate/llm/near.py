"""N-gram Jaccard join by chosen paths.

A document is the set of its runs of SHINGLE words; a text of fewer words, but not
none, is one run. Documents with equal sets are one node, so copies are never
compared with each other.

* Each of RUNS runs lets a set choose PICKS of its shingles on average, by a hash all
  documents share, and go into the bucket of each chosen one.
* Passages that many documents share make large buckets, and no node leaves one: the
  other buckets of a node may be of shingles that only it has, where it meets nobody.
* A bucket of more than SMALL nodes is split again on tokens that its members sampled
  (a minhash in each of SPLIT_BINS parts of hash space); all members use the same
  CHILDREN parts, chosen by the bucket. This is repeated while one of the parts shows
  that it saves more pairs than the rows it makes are worth, a row as much as ROW_PAIRS
  times SMALL pairs; groups of near copies stay together.
* Within a bucket, pairs are compared by brute force: lengths, then parities, then
  sketches, then the sets themselves. Parities (of the set's hashes in each of 64 parts
  of hash space) differ in no more bits than the sets in shingles, so they lose nothing.
  Sketches are for sets of SKETCH_LEAST shingles or more: in a smaller one many parts
  are empty and take another's bit, so that one shingle changes many bits. A bucket too large for one task is cut into blocks, and a task
  takes two of them. A pair is counted in the lowest bucket that it shares, so no list
  of pairs is ever made: a task returns how many links each node has, and a tree of
  links for each group that hangs together.
* Trees are joined to classes by rounds of star contraction.

A pair at the threshold shares a bucket with probability 1 - exp(-RUNS * PICKS * 0.8)
in the worst case, one set holding the other: RUNS is the least number that brings
this to RECALL. Sketches lost none of 240,000 simulated pairs at the threshold with 128
shingles in the smaller set; what splits lose is not measured.

Defined results: null and empty texts have no set, no links, and are their own class;
texts with equal sets are linked; a class has the smallest doc_id of its members,
nulls coming first; rows that repeat are documents of their own, linked to each other;
other columns are left alone.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.tasks import map_texts, ship_package
from tidegate.llm.text import Words, mix, signed
from tidegate.session import settle

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
PICKS = 2
RUNS = math.ceil(-math.log(1 - RECALL) / (PICKS * THRESHOLD))
SPLIT_BINS, CHILDREN, DEPTH = 16, 3, 4
SMALL = 128  # nodes of a bucket that is not split
ROW_PAIRS = 4  # a row made by splitting costs as much as comparing its node with so many times SMALL others
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 20  # what a task takes twice at most
SKETCH_BITS, SKETCH_DIFFERENCES = 64, 20  # a pair of long sets at the threshold differs in 6.4 on average
SKETCH_LEAST = 128  # shingles of a set that a sketch may decide on

SETS = "doc_id bigint, digest bigint, node binary, n int, parity bigint, sketch bigint, tokens array<int>, buckets array<bigint>"


class Sets:
    """The shingle sets of the texts of one run: sorted hashes, end to end, and where each set begins."""

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        sizes = np.diff(words.first)
        found, owners = [], []
        for size in range(1, SHINGLE + 1):
            hashes, at = words.shingles(size)
            owner = words.owner[at]
            fits = slice(None) if size == SHINGLE else sizes[owner] == size
            found.append(hashes[fits])
            owners.append(owner[fits])
        hashes, owner = np.concatenate(found), np.concatenate(owners)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.hashes, self.owner = hashes[new], owner[new]
        self.count = len(texts)
        self.sizes = np.bincount(self.owner, minlength=self.count)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))

    def nodes(self) -> list[bytes | None]:
        """128 bits that stand for a set; None for the empty one."""
        out = np.zeros((self.count, 2), np.uint64)
        some = np.flatnonzero(self.sizes)
        for i in range(2):
            if len(some):
                out[some, i] = np.add.reduceat(mix(self.hashes, 21 + i), self.first[some])
        return [row.tobytes() if size else None for row, size in zip(out, self.sizes)]

    def minhashes(self, bins: int, seed: int) -> np.ndarray:
        """The least hash in each of `bins` parts of hash space; an empty part takes the next one's."""
        scores = mix(self.hashes, seed)
        least = np.full((self.count, bins), np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least.reshape(-1), self.owner * bins + (scores % np.uint64(bins)).astype(np.int64), scores)
        empty = least == np.iinfo(np.uint64).max
        for j in [*range(bins - 1, -1, -1)] * 2:
            after = (j + 1) % bins
            least[:, j] = np.where(empty[:, j], least[:, after], least[:, j])
            empty[:, j] &= empty[:, after]
        return least

    def sketches(self) -> np.ndarray:
        bits = mix(self.minhashes(SKETCH_BITS, 31), 32) & np.uint64(1)
        return np.bitwise_or.reduce(bits << np.arange(SKETCH_BITS, dtype=np.uint64), axis=1)

    def parities(self) -> np.ndarray:
        """Whether the number of hashes in each of 64 parts of hash space is odd."""
        out = np.zeros(self.count, np.uint64)
        some = np.flatnonzero(self.sizes)
        if len(some):
            bits = np.uint64(1) << (mix(self.hashes, 33) % np.uint64(64))
            out[some] = np.bitwise_xor.reduceat(bits, self.first[some])
        return out

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all sets end to end, and where each set's begin and the last end."""
        share = np.minimum(PICKS / np.maximum(self.sizes, 1), 1.0)
        limits = np.where(share < 1, (share * 2.0**63).astype(np.uint64), np.uint64(1 << 63))[self.owner]
        ids, owners = [], []
        for run in range(RUNS):
            chosen = np.flatnonzero((mix(self.hashes, 100 + run) >> np.uint64(1)) < limits)
            ids.append(mix(self.hashes[chosen], 300 + run))
            owners.append(self.owner[chosen])
        ids, owner = np.concatenate(ids), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=self.count))))


def digest_column() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest_column().alias("digest"), "text")


def sketch_documents(documents: DataFrame) -> DataFrame:
    """Per document: its node, the size of its set, its sketch, its sampled tokens and its buckets."""

    def sketch(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        sets = Sets(texts)
        tokens = (sets.minhashes(SPLIT_BINS, 41) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        ids, bounds = sets.buckets()
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                rows.column("digest"),
                pa.array(sets.nodes(), pa.binary()),
                pa.array(sets.sizes, pa.int32()),
                pa.array(signed(sets.parities())),
                pa.array(signed(sets.sketches())),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(sets.count + 1) * SPLIT_BINS, pa.int32()), pa.array(tokens.reshape(-1))
                ),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(ids))),
            ],
            ["doc_id", "digest", "node", "n", "parity", "sketch", "tokens", "buckets"],
        )

    return map_texts(keyed(documents), sketch, SETS)


def child_of(leaf: str, i: int) -> Column:
    """The child of a bucket that its node goes to by one of the bucket's parts of hash space."""
    part = F.pmod(F.xxhash64(F.lit(i), leaf), F.lit(SPLIT_BINS)).cast("int")
    return F.xxhash64(leaf, part, F.get("tokens", part))


def split(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaf buckets (leaf, node), each with two nodes or more."""
    done = []
    for depth in range(DEPTH):
        sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        rows = settle(rows.join(sizes, "leaf"), "buckets", compact=True)
        large = rows.filter(F.col("m") > SMALL)
        if large.isEmpty():
            done.append(rows.select("leaf", "node"))
            return union(done)
        done.append(rows.filter(F.col("m") <= SMALL).select("leaf", "node"))
        tokens = large.join(nodes.select("node", "tokens"), "node")
        probe = tokens.groupBy("leaf", "m", child_of("leaf", 0).alias("child")).agg(F.count(F.lit(1)).alias("k"))
        work = probe.groupBy("leaf", "m").agg((CHILDREN * F.sum(F.col("k") * F.col("k"))).alias("work"))
        made = F.col("m") * (CHILDREN * ROW_PAIRS * SMALL)
        useful = settle(work.filter(F.col("work") + made < F.col("m") * F.col("m")).select("leaf"), "splits")
        done.append(large.join(useful, "leaf", "left_anti").select("leaf", "node"))
        children = F.array_distinct(F.array(*[child_of("leaf", i) for i in range(CHILDREN)]))
        rows = tokens.join(useful, "leaf", "left_semi").select("node", F.explode(children).alias("leaf"))
    sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    done.append(rows.join(sizes, "leaf").select("leaf", "node"))
    return union(done)


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def blocks(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of every task's group: a leaf, or two blocks of a large leaf."""
    facts = leaves.groupBy("node").agg(F.array_sort(F.collect_set("leaf")).alias("leaves")).join(
        nodes.select("node", "n", "parity", "sketch", "copies"), "node"
    )
    rows = leaves.join(facts, "node")
    # A bound on a leaf's blocks: by nodes and by shingles.
    cuts = rows.groupBy("leaf").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum(F.col("n").cast("bigint")) / BLOCK_SHINGLES)
        ).cast("int").alias("cuts")
    )
    block = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    return (
        rows.join(cuts, "leaf")
        .withColumn("block", block)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .select(
            "leaf", F.least("block", "with").alias("part"), F.greatest("block", "with").alias("other"),
            "node", "n", "parity", "sketch", "leaves", "copies", "block",
        )
    )


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut so that rows with equal keys, which follow one another, are together; with the groups' bounds."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = join_batches([*held, batch])
        bounds = group_bounds(whole, keys)
        cut = int(bounds[-2])
        if cut:
            yield whole.slice(0, cut), bounds[:-1]
        held = [whole.slice(cut)]
    if held:
        whole = join_batches(held)
        yield whole, group_bounds(whole, keys)


def join_batches(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def group_bounds(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.ones(batch.num_rows, bool)
    new[1:] = False
    for key in keys:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), batch.num_rows)


def list_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column end to end, and where each list begins and the last ends."""
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def incidence(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Lists by values as 0 and 1, without the values that only one list has."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    out = np.zeros((len(bounds) - 1, int(shared.sum())), np.float32)
    out[rows[keep], number[column[keep]]] = 1
    return out


def overlaps(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many values every two lists share; values in slices, to bound memory."""
    count = len(bounds) - 1
    total = np.zeros((count, count), np.float32)
    slices = max(1, len(values) // (1 << 16))
    part = (values.view(np.uint64) % np.uint64(slices)).astype(np.int64) if slices > 1 else None
    rows = np.repeat(np.arange(count), np.diff(bounds))
    for i in range(slices):
        chosen = slice(None) if part is None else part == i
        inner, owner = values[chosen], rows[chosen]
        if len(inner):
            table = incidence(inner, np.searchsorted(owner, np.arange(count + 1)))
            total += table @ table.T
    return total


class Group:
    """The nodes of one leaf, or of two of its blocks, and the pairs that are to be compared in it."""

    def __init__(self, leaf: int, apart: bool, rows: slice, columns: dict):
        self.size = rows.stop - rows.start
        n = columns["n"][rows].astype(np.float64)
        parity, sketch = columns["parity"][rows], columns["sketch"][rows]
        bounds = columns["leaf_bounds"][rows.start : rows.stop + 1]
        leaves = columns["leaves"][bounds[0] : bounds[-1]]
        candidate = np.triu(np.ones((self.size, self.size), bool), 1)
        candidate &= np.minimum(n[:, None], n) >= THRESHOLD * np.maximum(n[:, None], n) - 1e-9
        apart_most = (n[:, None] + n) * ((1 - THRESHOLD) / (1 + THRESHOLD)) + 1e-9  # shingles that only one of a linked pair has
        candidate &= np.bitwise_count(parity[:, None] ^ parity) <= apart_most
        short = n < SKETCH_LEAST
        candidate &= short[:, None] | short | (np.bitwise_count(sketch[:, None] ^ sketch) <= SKETCH_DIFFERENCES)
        if apart:  # pairs within a block belong to that block's own group
            block = columns["block"][rows]
            candidate &= block[:, None] != block
        if candidate.any():
            lower = leaves < leaf
            before = np.concatenate(([0], np.cumsum(lower)))[bounds - bounds[0]]
            candidate &= overlaps(leaves[lower], before) == 0
        self.candidate = candidate


def columns_of(batch: pa.RecordBatch) -> dict:
    leaves, leaf_bounds = list_arrays(batch.column("leaves"))
    return {
        "leaf": batch.column("leaf").to_numpy(),
        "part": batch.column("part").to_numpy(),
        "other": batch.column("other").to_numpy(),
        "block": batch.column("block").to_numpy(),
        "n": batch.column("n").to_numpy(),
        "parity": batch.column("parity").to_numpy().view(np.uint64),
        "sketch": batch.column("sketch").to_numpy().view(np.uint64),
        "copies": batch.column("copies").to_numpy(),
        "leaves": leaves,
        "leaf_bounds": leaf_bounds,
    }


GROUP = ["leaf", "part", "other"]


def groups_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict, slice, Group]]:
    for batch, bounds in groups_of(batches, GROUP):
        columns = columns_of(batch)
        for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if stop - start > 1:
                rows = slice(start, stop)
                apart = columns["part"][start] != columns["other"][start]
                yield batch, columns, rows, Group(int(columns["leaf"][start]), bool(apart), rows, columns)


def together(rows: DataFrame) -> DataFrame:
    """Rows of a group in one task, one after another."""
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)


def with_candidates(rows: DataFrame) -> DataFrame:
    """The rows that have a pair to compare in their group."""
    ship_package(rows.sparkSession)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chosen = None, []
        for batch, _, rows, group in groups_in(batches):
            if last is not None and batch is not last:
                yield last.take(pa.array(np.concatenate(chosen)))
                chosen = []
            last = batch
            used = group.candidate.any(axis=0) | group.candidate.any(axis=1)
            chosen.append(rows.start + np.flatnonzero(used))
        if last is not None:
            yield last.take(pa.array(np.concatenate(chosen)))

    return together(rows).mapInArrow(pick, rows.schema)


def read_sets(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of the given nodes, from one document of each."""
    texts = keyed(documents)
    wanted = nodes.select(F.col("first.doc_id").alias("id"), F.col("first.digest").alias("text_digest"), "node")
    same = texts["doc_id"].eqNullSafe(wanted["id"]) & (texts["digest"] == wanted["text_digest"])
    rows = texts.join(wanted, same).select("node", "text")

    def sets(rows: pa.RecordBatch, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        found = Sets(texts)
        lists = pa.ListArray.from_arrays(pa.array(found.first, pa.int32()), pa.array(signed(found.hashes)))
        yield pa.RecordBatch.from_arrays([rows.column("node"), lists], ["node", "shingles"])

    return map_texts(rows, sets, "node binary, shingles array<bigint>").dropDuplicates(["node"])


def compare(rows: DataFrame) -> DataFrame:
    """Per row: how many nodes and documents of its group it is linked to, and the root of its tree there."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, columns, rows, group in groups_in(batches):
            shingles, bounds = list_arrays(batch.column("shingles").slice(rows.start, group.size))
            left, right = np.nonzero(group.candidate)
            if not len(left):
                continue
            if len(left) <= 4 * group.size:
                shared = np.array([
                    len(np.intersect1d(shingles[bounds[i] : bounds[i + 1]], shingles[bounds[j] : bounds[j + 1]], True))
                    for i, j in zip(left, right)
                ])
            else:
                shared = overlaps(shingles, bounds)[left, right].astype(np.int64)
            n = np.diff(bounds)
            linked = shared >= THRESHOLD * (n[left] + n[right] - shared) - 1e-9
            left, right = left[linked], right[linked]
            if not len(left):
                continue
            copies = columns["copies"][rows]
            texts = np.bincount(left, minlength=group.size) + np.bincount(right, minlength=group.size)
            documents = np.bincount(left, copies[right], group.size) + np.bincount(right, copies[left], group.size)
            used = np.flatnonzero(texts)
            names = batch.column("node").slice(rows.start, group.size)
            roots = tree_roots(left, right, group.size)
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(used)),
                    names.take(pa.array(roots[used])),
                    pa.array(texts[used], pa.int64()),
                    pa.array(documents[used].astype(np.int64)),
                ],
                ["node", "root", "texts", "documents"],
            )

    return together(rows).mapInArrow(links, "node binary, root binary, texts bigint, documents bigint")


def tree_roots(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The lowest member of each member's component within one group."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) but the roots themselves.

    Alternates two contractions: larger neighbours move to a node's least neighbour,
    then smaller ones do. A node's neighbours are never gathered; its least one is an
    aggregate joined back to its edges.
    """
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        small = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        edges = settle(small, "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def find_near_copies(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, digest (of its text), class_id, class_digest, n_links (documents), n_equal (sets, with its own)."""
    sketched = settle(sketch_documents(documents), "sketches", compact=True)
    some = sketched.filter("node is not null")
    nodes = some.groupBy("node").agg(
        F.min(F.struct("doc_id", "digest")).alias("first"),
        F.count(F.lit(1)).alias("copies"),
        F.max("n").alias("n"),
        F.max("parity").alias("parity"),
        F.max("sketch").alias("sketch"),
        F.first("tokens").alias("tokens"),
        F.first("buckets").alias("buckets"),
    )
    nodes = settle(nodes, "nodes", compact=True)
    picks = nodes.select("node", F.explode(F.array_distinct("buckets")).alias("leaf"))
    leaves = settle(split(picks, nodes), "leaves", compact=True)
    rows = settle(with_candidates(blocks(leaves, nodes)), "candidates", compact=True)
    wanted = rows.select("node").distinct().join(nodes, "node")
    sets = settle(read_sets(documents, wanted), "sets", compact=True)
    links = settle(compare(rows.join(sets, "node")), "links", compact=True)
    counts = links.groupBy("node").agg(F.sum("documents").alias("documents"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = nodes.select("node", "first", "copies").join(roots, "node", "left").join(counts, "node", "left")
    placed = placed.select(
        "node", "first", F.coalesce("root", "node").alias("root"), F.col("copies"),
        (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
    )
    placed = settle(placed, "placed", compact=True)
    firsts = placed.groupBy("root").agg(F.min("first").alias("class"))
    classes = placed.join(firsts, "root").select("node", "class", "n_links", "copies")
    own = F.struct("doc_id", "digest")
    return sketched.select("doc_id", "digest", "node").join(classes, "node", "left").select(
        "doc_id",
        "digest",
        F.coalesce("class", own)["doc_id"].alias("class_id"),
        F.coalesce("class", own)["digest"].alias("class_digest"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("copies", F.lit(1).cast("bigint")).alias("n_equal"),
    )


def keep_one_each(documents: DataFrame) -> DataFrame:
    """The first document of each class, and with it rows that repeat its doc_id and text."""
    found = find_near_copies(documents)
    first = found["doc_id"].eqNullSafe(found["class_id"]) & (found["digest"] == found["class_digest"])
    kept = found.filter(first).select("doc_id", "digest").distinct()
    rows = documents.withColumn("digest of text", digest_column())
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["digest of text"] == kept["digest"])
    return rows.join(kept, same, "left_semi").drop("digest of text")
