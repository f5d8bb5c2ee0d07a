"""Near duplicates: a join of documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

1. Each text becomes its set of hashed five-word shingles, and a MinHash signature of that set. Texts with
   the same set are one class from here on, so that copies are never compared.
2. The signatures form an LSH forest: per tree, a sorted trie of ``DEPTH`` values each. Within a tree,
   matches are sought at the longest common prefix first; the prefix is shortened, and only texts that are
   not settled yet go on, down to the length at which the forest finds a pair at the threshold with the
   target recall.
3. A match makes two texts candidates of one cluster if their signatures agree well below the threshold.
   A text that nearly equals another one need not be compared further: by the triangle inequality, what
   is similar to it is not far from the other one.
4. Clusters of more than one part are split first, without losing a link: linked texts have one of their rarest
   shingles in common and sizes that the threshold allows. Only what such shingles connect stays together.
5. Within what is left all pairs are verified exactly, by matrix products over shared shingles, in tiles
   of bounded size. Only sums per text and a spanning forest leave a tile, never the pairs of a group.
6. Classes are the connected components of the verified links.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm.common import bounded_batches, query, slices, table
from visitmill.session import cut_lineage

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
# Trees of the forest and values per tree.
TREES, DEPTH = 20, 6
# Agreement of signatures from which a text counts as settled, and from which two texts share a cluster.
SETTLED, NEAR, NEAR_ROOTS = 0.85, 0.45, 0.3
# Members of a trie node that one task takes together; larger nodes are split. Up to ``ROOTS`` of their roots are merged
# by comparison, more are taken as one.
NODE = 256
ROOTS = 256
# Texts and shingles of a part; a tile holds two parts.
PART_TEXTS, PART_SHINGLES = 200, 800_000
# Texts and shingles of a cluster that tell which shingles are common there.
SAMPLE_TEXTS, SAMPLE_SHINGLES = 128, 200_000
# Edges up to which one task finds the components of a graph.
FEW_EDGES = 50_000
# Shared shingles per matrix product.
COLUMNS = 4_096
WORD = re.compile(r"\w+")
KNOWN_WORDS = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio, odd


def prefix_length(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold shares a node in some tree with this probability."""
    for k in range(depth, 0, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    return 1


class Words(dict):
    """Hash of each word; forgets all when it holds many."""

    def __missing__(self, word: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, known: Words, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one run; none without words."""
    found = WORD.findall((text or "").lower())
    if not found:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    span = min(words, len(found))
    h = np.full(len(found) - span + 1, span, np.uint64)
    for i in range(span):
        h *= MIX
        h ^= h >> np.uint64(31)
        h += ids[i : len(found) - span + 1 + i]
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    return np.unique(h)


class Forest:
    """Hash functions of the signature; keys of the shortest prefixes; one byte per value for estimates."""

    def __init__(self, trees: int, depth: int, prefix: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.trees, self.depth, self.prefix = trees, depth, prefix
        self.times = (rng.integers(0, 1 << 31, trees * depth, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint32)

    def signature(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(self.times), 0xFFFFFFFF, np.uint32)
        narrow = (x >> np.uint64(32)).astype(np.uint32) ^ x.astype(np.uint32)
        for at in range(0, len(narrow), 2048):
            np.minimum(out, (narrow[at : at + 2048, None] * self.times + self.plus).min(axis=0), out=out)
        return out

    def keys(self, signature: np.ndarray) -> np.ndarray:
        values = signature.reshape(self.trees, self.depth)[:, : self.prefix].astype(np.uint64)
        h = np.arange(1, self.trees + 1, dtype=np.uint64)
        for i in range(self.prefix):
            h *= MIX
            h ^= h >> np.uint64(30)
            h += values[:, i]
        h *= MIX
        h ^= h >> np.uint64(31)
        return h.view(np.int64)


def _halves(digest: int) -> tuple[int, int]:
    return (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)


def _marking(forest: Forest, words: int) -> Callable:
    """Task function: digest of the set, its size, keys and signature of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            for part in slices(batch, "text", 4 * 1024 * 1024):
                digests, sizes, keys, signatures = [], [], [], []
                for text in part.column("text").to_pylist():
                    x = shingles(text, known, words)
                    d = xxhash.xxh3_128_intdigest(x.tobytes())
                    digests.append(_halves(d))
                    sizes.append(len(x))
                    if len(x):
                        s = forest.signature(x)
                        keys.append(forest.keys(s))
                        signatures.append(s.astype(np.uint8).tobytes())
                    else:
                        keys.append(None)
                        signatures.append(None)
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array([a for a, _ in digests], pa.int64()), pa.array([b for _, b in digests], pa.int64()),
                     pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                    names=[*kept.schema.names, "d1", "d2", "size", "keys", "signature"],
                )

    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of batches that are sorted by ``keys``, as many at a time as a batch ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        changes = np.zeros(batch.num_rows, bool)
        for c in columns:
            changes[1:] |= c[1:] != c[:-1]
        changes[0] = bool(held) and any(held[-1].column(k)[held[-1].num_rows - 1].as_py() != batch.column(k)[0].as_py() for k in keys)
        at = np.flatnonzero(changes)
        if not len(at):
            held.append(batch)
            continue
        cut = int(at[-1])
        done = [*held, batch.slice(0, cut)] if cut else held
        if done:
            yield pa.Table.from_batches(done)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _bytes_matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def cluster_nodes(node: np.ndarray, signatures: np.ndarray, depth: int, prefix: int, settled: float, near: float, tree: np.ndarray) -> np.ndarray:
    """Root (a row) of each row, for rows grouped by ``node``: rows near each other in a node share a root.

    Goes from the longest common prefix to the shortest; one row of each run is compared with the rest
    of its run, and rows that nearly equal it are settled. At the shortest prefix this is repeated until
    a node is one cluster or has no unsettled row left.
    """
    n, width = len(node), signatures.shape[1]
    label = signatures.reshape(n, width // depth, depth)[np.arange(n), tree]
    order = np.lexsort([*(label[:, i] for i in range(depth - 1, -1, -1)), node])
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    active = order
    for length in [*range(depth, prefix - 1, -1)]:
        todo = active
        gone: list[np.ndarray] = []
        while len(todo) > 1:
            same = node[todo[1:]] == node[todo[:-1]]
            for i in range(prefix, length):
                same &= label[todo[1:], i] == label[todo[:-1], i]
            first = np.concatenate([[True], ~same])
            run = np.cumsum(first) - 1
            pivot = todo[np.flatnonzero(first)][run]
            rest = ~first
            if not rest.any():
                break
            a, b = todo[rest], pivot[rest]
            agree = np.empty(len(a))
            for at in range(0, len(a), 65_536):
                agree[at : at + 65_536] = (signatures[a[at : at + 65_536]] == signatures[b[at : at + 65_536]]).mean(axis=1)
            for i, j in zip(a[agree >= near].tolist(), b[agree >= near].tolist()):
                x, y = root(i), root(j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            gone.append(a[agree >= settled])
            if length > prefix:
                break
            # The pivots are through; so are settled rows, and nodes that are one cluster.
            left = todo[rest & ~np.isin(todo, gone[-1])]
            if not len(left):
                break
            roots = np.array([root(i) for i in todo.tolist()])
            low, high = np.full(n, n), np.full(n, -1)
            number = np.unique(node[todo], return_inverse=True)[1]
            np.minimum.at(low, number, roots)
            np.maximum.at(high, number, roots)
            mixed = dict(zip(node[todo].tolist(), (low[number] != high[number]).tolist()))
            todo = left[[mixed[k] for k in node[left].tolist()]]
        if gone:
            active = active[~np.isin(active, np.concatenate(gone))]
    return np.array([root(i) for i in range(n)])


def _clustering(forest: Forest, near: float) -> Callable:
    """Task function over rows sorted by node: (node, id, root) of each row, root by id."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("root", pa.int64()), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["key", "part"]):
            key, part, ids = (group.column(c).to_numpy() for c in ("key", "part", "id"))
            start = np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
            rows = _bytes_matrix(group.column("signature"), forest.trees * forest.depth)
            tree = group.column("tree").to_numpy()
            roots = cluster_nodes(np.cumsum(start), rows, forest.depth, forest.prefix, SETTLED, near, tree)
            own = roots == np.arange(len(ids))
            kept = [s if k else None for s, k in zip(group.column("signature").to_pylist(), own)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(ids), pa.array(ids[roots]), pa.array(kept, pa.binary())], schema=schema
            )

    return run


def candidate_edges(texts: DataFrame, forest: Forest) -> DataFrame:
    """(u, v): texts of one candidate cluster. ``texts`` has ``id, keys, signature``."""
    keyed = cut_lineage(texts.select("id", F.posexplode("keys").alias("tree", "key")))
    nodes = cut_lineage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    parts = F.ceil(F.col("n") / NODE).cast("int")
    members = skew.salted_join(keyed, nodes, ["key"], how="inner", row_id=["id", "tree"]).withColumn("part", F.pmod(F.xxhash64(F.lit(3), "id"), parts).cast("int"))
    signed = members.join(texts.select("id", "signature"), "id")
    columns = "key long, id long, root long, signature binary"
    ordered = signed.select("key", "part", "id", "tree", "signature", (F.col("n") > NODE).alias("large"))

    def clustered(rows: DataFrame, near: float) -> DataFrame:
        spread = rows.repartition("key", "part").sortWithinPartitions("key", "part")
        return spread.mapInArrow(_clustering(forest, near), columns)

    found = cut_lineage(clustered(ordered, NEAR))
    edges = found.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    # Nodes that were split: the roots of their parts meet once more, and are taken as one if too many.
    large = nodes.where(F.col("n") > NODE).select("key")
    roots = found.where("id = root").join(large, "key").select("key", "id", "signature")
    counted = cut_lineage(roots.join(keyed.select("key", "id", "tree"), ["key", "id"]))
    sizes = counted.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    joined = counted.join(sizes, "key")
    few = joined.where(F.col("n") <= ROOTS).select("key", F.lit(0).alias("part"), "id", "tree", "signature")
    merged = clustered(few, NEAR_ROOTS).where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    many = joined.where((F.col("n") > ROOTS) & (F.col("id") != F.col("least"))).select(F.col("id").alias("u"), F.col("least").alias("v"))
    return edges.unionByName(merged).unionByName(many)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the smallest id of the component of each vertex but that one itself."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    found = [(x, root(x)) for x in list(parent)]
    ids, roots = zip(*[(x, r) for x, r in found if x != r]) if any(x != r for x, r in found) else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(roots, pa.int64())], names=["id", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(id, root): smallest id of the connected component of each vertex of ``edges`` (u, v).

    Large-star and small-star steps in turn; each keeps the components and at most the number of edges, and the
    number of rounds grows with the logarithm of the graph. Sums are reduced before each shuffle.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = cut_lineage(pairs)
    if pairs.limit(FEW_EDGES + 1).count() <= FEW_EDGES:
        # A graph of checked small size takes one task, not rounds of jobs; the result is the same.
        return cut_lineage(pairs.coalesce(1).mapInArrow(_united, "id long, root long"))
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that both sides of the join are plain shuffles, which AQE splits at a hot vertex.
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = cut_lineage(large.where("u <> v").distinct())
        least = cut_lineage(pairs.groupBy("u").agg(F.min("v").alias("m")))
        small = pairs.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        pairs = cut_lineage(small.distinct())
        # Done when all that is left are stars: every vertex has one neighbour, and none of those has one itself.
        ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        ends = ends.unionByName(pairs.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        odd = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0)))
        if odd.isEmpty():
            break
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("root"))


def verified(sets: list[np.ndarray], side: np.ndarray, across: bool, threshold: float) -> np.ndarray:
    """Adjacency of texts whose sets reach the threshold; with ``across`` only between the two sides."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(n), sizes)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    rows, every = rows[order], every[order]
    first = np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else np.zeros(0, bool)
    number = np.cumsum(first) - 1
    shared = np.bincount(number) > 1
    keep = shared[number]
    rows, number = rows[keep], (np.cumsum(shared) - 1)[number[keep]]
    common = np.zeros((n, n), np.float32)
    total = int(shared.sum())
    for at in range(0, total, COLUMNS):
        a, b = np.searchsorted(number, [at, at + COLUMNS])
        block = np.zeros((n, min(COLUMNS, total - at)), np.float32)
        block[rows[a:b], number[a:b] - at] = 1
        common += block @ block.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if across:
        linked &= side[:, None] != side[None, :]
    return linked


def _tile_links(threshold: float, words: int) -> Callable:
    """Task function over rows sorted by tile: links of each text in the tile, and its root there."""
    schema = pa.schema([("id", pa.int64()), ("text_links", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("tiles", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["cluster", "a", "b"]):
            columns = [group.column(c).to_numpy() for c in ("cluster", "a", "b")]
            change = np.zeros(group.num_rows, bool)
            change[0] = True
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            bounds = [*np.flatnonzero(change), group.num_rows]
            out: list[tuple] = []
            for low, high in zip(bounds[:-1], bounds[1:]):
                tile = group.slice(low, high - low)
                ids, place = np.unique(tile.column("id").to_numpy(), return_index=True)
                if len(ids) < 2:
                    continue
                tile = tile.take(place)
                sets = [np.frombuffer(s, np.uint64) for s in tile.column("shingles").to_pylist()]
                a, b = int(columns[1][low]), int(columns[2][low])
                linked = verified(sets, tile.column("part").to_numpy(), a != b, threshold)
                copies = tile.column("copies").to_numpy()
                label = np.arange(len(ids))
                while True:
                    least = np.where(linked, label[None, :], len(ids)).min(axis=1)
                    new = np.minimum(label, least)
                    new = new[new]
                    if (new == label).all():
                        break
                    label = new
                has = np.flatnonzero(linked.any(axis=1))
                counts, sums = linked.sum(axis=1), linked @ copies
                tiles = int(tile.column("tiles")[0].as_py())
                out += [(int(ids[i]), int(counts[i]), int(sums[i]), int(ids[label[i]]), tiles) for i in has]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return run


def _shingling(words: int) -> Callable:
    """Task function: the set of each text as bytes; rows whose digest is not the one sought are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            for part in slices(batch, "text", 2 * 1024 * 1024):
                sets, keep = [], []
                for text, d1, d2 in zip(*[part.column(c).to_pylist() for c in ("text", "d1", "d2")]):
                    raw = shingles(text, known, words).tobytes()
                    keep.append(_halves(xxhash.xxh3_128_intdigest(raw)) == (d1, d2))
                    sets.append(raw)
                kept = part.drop_columns(["text", "d1", "d2"])
                made = pa.RecordBatch.from_arrays([*kept.columns, pa.array(sets, pa.binary())], names=[*kept.schema.names, "shingles"])
                yield made.filter(pa.array(keep))

    return run


def in_parts(members: DataFrame) -> DataFrame:
    """``members`` (``id, cluster, size``) with the number of ``parts`` of their cluster, and their ``part``."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    parts = F.greatest(F.ceil(F.col("n") / PART_TEXTS), F.ceil(F.col("total") / PART_SHINGLES)).cast("int")
    placed = skew.salted_join(members, sizes.select("cluster", parts.alias("parts")), ["cluster"], how="inner", row_id=["id"])
    return placed.withColumn("part", F.pmod(F.xxhash64(F.lit(4), "id"), F.col("parts")).cast("int"))


def prefix_keys(x: np.ndarray, common: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """Keys of which two sets have one in common if their similarity reaches the threshold.

    A set that is linked with ``x`` holds ``threshold`` of it, so it holds one of any ``len(x) - that + 1`` shingles; taken
    are the rarest, by the ``counts`` of the ``common`` ones (sorted) and then by value. Each stands twice,
    with the step of the set's size and the next one, as sizes of linked sets differ by one step at most.
    """
    at = np.minimum(np.searchsorted(common, x), max(0, len(common) - 1))
    often = np.where(common[at] == x, counts[at], 0) if len(common) else np.zeros(len(x), np.int64)
    many = len(x) - int(np.ceil(threshold * len(x) - 1e-6)) + 1
    rare = x[np.lexsort((x, often))[:many]]
    step = int(np.log(len(x)) / np.log(1.0001 / threshold))
    steps = np.array([step, step + 1], np.uint64)
    keys = (rare[:, None] ^ (steps * MIX)[None, :]).ravel() * MIX
    keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def _prefixes(threshold: float) -> Callable:
    """Task function over a part and its cluster's common shingles: the keys of each text."""

    def run(key: tuple, part: pa.Table, listed: pa.Table) -> pa.Table:
        common = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if listed.num_rows:
            tokens = listed.column("tokens")[0].as_py()
            found = np.array([t["token"] for t in tokens], np.int64).view(np.uint64)
            order = np.argsort(found)
            common = found[order], np.array([t["n"] for t in tokens], np.int64)[order]
        ids, keys = [], []
        for text, raw in zip(part.column("id").to_pylist(), part.column("shingles").to_pylist()):
            made = prefix_keys(np.frombuffer(raw, np.uint64), *common, threshold)
            ids.append(np.full(len(made), text, np.int64))
            keys.append(made)
        empty = [np.zeros(0, np.int64)]
        columns = [pa.array(np.concatenate(c or empty), pa.int64()) for c in (ids, keys)]
        cluster = pa.array(np.full(len(columns[0]), key[0].as_py()), pa.int64())
        return pa.table([cluster, *columns], names=["cluster", "id", "key"])

    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: (cluster, token) for each shingle of each text."""
    for batch in batches:
        for cluster, raw in zip(batch.column("cluster").to_pylist(), batch.column("shingles").to_pylist()):
            tokens = np.frombuffer(raw, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), cluster), pa.int64()), pa.array(tokens)], names=["cluster", "token"])


def split_clusters(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, cluster) of the texts that share a rare shingle with another one of their cluster; others are linked with none.

    ``sets`` has ``id, cluster, part, parts, size, shingles``. Which shingles are rare is told by a sample of each
    cluster; any order of them gives the same links, and a better one smaller clusters.
    """
    sizes = cut_lineage(sets.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.first("parts").alias("parts")))
    chance = F.least(F.lit(SAMPLE_TEXTS) / F.col("n"), F.lit(SAMPLE_SHINGLES) / F.col("total"))
    drawn = skew.salted_join(sets, sizes.select("cluster", chance.alias("chance")), ["cluster"], how="inner", row_id=["id"])
    drawn = drawn.where(F.pmod(F.xxhash64(F.lit(6), "id"), F.lit(1 << 30)) < F.col("chance") * (1 << 30))
    counted = drawn.select("cluster", "shingles").mapInArrow(_exploded, "cluster long, token long")
    common = counted.groupBy("cluster", "token").agg(F.count("*").alias("n")).where("n > 1")
    # About SAMPLE_SHINGLES / 2 tokens of a cluster at most, as each stands twice in the sample.
    lists = common.groupBy("cluster").agg(F.collect_list(F.struct("token", "n")).alias("tokens"))
    every = lists.join(sizes, "cluster").select("cluster", "tokens", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    keyed = cut_lineage(
        sets.select("cluster", "part", "id", "shingles").groupBy("cluster", "part")
        .cogroup(every.groupBy("cluster", "part")).applyInArrow(_prefixes(threshold), "cluster long, id long, key long")
    )
    least = keyed.groupBy("cluster", "key").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1")
    met = skew.salted_join(keyed, least.drop("n"), ["cluster", "key"], how="inner", row_id=["id"])
    edges = met.where(F.col("id") != F.col("least")).select(F.col("id").alias("u"), F.col("least").alias("v"))
    return _with_roots(components(edges)).distinct().withColumnRenamed("root", "cluster")


def text_hash(text_column: str) -> Column:
    """Hash that tells the texts of rows with one id apart."""
    return F.xxhash64(text_column)


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
    told_column: str | None = None,
) -> DataFrame:
    """``id_column, class_id, n_links, n_text_links``: a row per document; and ``told_column``, the text's hash, if named.

    Words are runs of letters, digits and underscores in lower case; a shingle is ``words`` of them in a
    row, and all of them where a text has fewer. Two documents are linked if their shingle sets have a
    Jaccard similarity of at least ``threshold``. ``class_id`` is the smallest id that a document is
    linked with, directly or through others; ``n_links`` counts the other documents linked directly,
    copies included, ``n_text_links`` the linked texts whose set differs. A pair at the threshold meets in
    the forest with probability ``recall``; what is linked is verified exactly.

    A text that is null or without words is linked with nothing. Rows that repeat an id are documents
    of their own; if their texts differ and are not linked, each has the links and class of its text, where two
    classes may have the same smallest id. Rows without id take part under a number made from their text, larger
    than other ids. The hash of a text is :func:`text_hash`. Other columns are not read; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    forest = Forest(TREES, DEPTH, prefix_length(threshold, recall))
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), text_hash(text_column).alias("told"))
    marks = cut_lineage(
        named.mapInArrow(
            _marking(forest, words),
            "doc_id long, told long, d1 long, d2 long, size int, keys array<long>, signature binary",
        )
    )
    number = F.coalesce("doc_id", F.shiftright("d1", 2) + F.lit(1 << 62))
    own = marks.withColumn("number", number)
    first = F.min(F.struct("number", "told", "doc_id"))
    # Texts get a number of their own, as an id may stand at several texts; a written one, so it stays the same.
    classes = cut_lineage(
        own.where("size > 0").groupBy("d1", "d2", "size").agg(first.alias("f"), F.count("*").alias("copies"))
        .select("d1", "d2", "size", "copies", "f.*").withColumn("id", F.monotonically_increasing_id())
    )
    chosen = marks.select("doc_id", "told", "d1", "d2", "keys", "signature")
    by_row = [chosen.doc_id.eqNullSafe(classes.doc_id), *[chosen[c] == classes[c] for c in ("told", "d1", "d2")]]
    texts = cut_lineage(
        classes.join(chosen, reduce(lambda a, b: a & b, by_row)).select(classes.id, "keys", "signature").dropDuplicates(["id"])
    )
    clusters = _with_roots(components(candidate_edges(texts, forest))).distinct().withColumnRenamed("root", "cluster")
    members = cut_lineage(clusters.join(classes, "id").select("id", "cluster", "size"))
    sought = classes.join(members.select("id"), "id").select("id", "copies", "size", "d1", "d2", "told", F.col("doc_id").alias("of"))
    met = named.join(sought, named.doc_id.eqNullSafe(sought.of) & (named.told == sought.told))
    sets = cut_lineage(
        met.select("id", "copies", "size", "d1", "d2", "text")
        .mapInArrow(_shingling(words), "id long, copies long, size int, shingles binary")
        .dropDuplicates(["id"])
    )
    placed = cut_lineage(in_parts(members))
    wide = placed.where("parts > 1")
    if not wide.isEmpty():
        split = split_clusters(cut_lineage(wide.join(sets, ["id", "size"])), threshold)
        narrow = placed.where("parts = 1").select("id", "cluster", "size")
        placed = in_parts(cut_lineage(narrow.unionByName(members.select("id", "size").join(split, "id"))))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tiles = placed.drop("size").join(sets, "id").select("*", other).select(
        "id", "cluster", "part", "copies", "shingles", F.col("parts").alias("tiles"),
        F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"),
    )
    spread = tiles.repartition("cluster", "a", "b").sortWithinPartitions("cluster", "a", "b")
    links = cut_lineage(
        spread.mapInArrow(_tile_links(threshold, words), "id long, text_links long, links long, root long, tiles int")
    )
    # A cluster of one tile is settled there; others go on with the roots of their tiles.
    single = links.where("tiles = 1").select("id", "root")
    split = links.where("tiles > 1").select(F.col("id").alias("u"), F.col("root").alias("v"))
    settled = single if split.isEmpty() else single.unionByName(_with_roots(components(split)))
    sums = links.groupBy("id").agg(F.sum("text_links").alias("n_text_links"), F.sum("links").alias("other_links"))
    rooted = cut_lineage(settled.groupBy("id").agg(F.min("root").alias("root")).join(classes.select("id", "number"), "id"))
    least = cut_lineage(rooted.groupBy("root").agg(F.min("number").alias("least")))
    named_classes = skew.lookup_join(rooted.select("id", "root"), least, ["root"], row_id=["id"], how="inner")
    found = (
        classes.select("d1", "d2", "id", "number", "copies")
        .join(named_classes.select("id", "least"), "id", "left")
        .join(sums, "id", "left")
        .select(
            "d1", "d2", F.coalesce("least", "number").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("other_links", F.lit(0))).alias("n_links"),
            F.coalesce("n_text_links", F.lit(0)).cast("long").alias("n_text_links"),
        )
    )
    light = own.select("doc_id", "number", "told", "size", "d1", "d2")
    joined = skew.lookup_join(light, cut_lineage(found), ["d1", "d2"], row_id=["number"])
    none = F.col("size") == 0
    return joined.select(
        F.col("doc_id").alias(id_column),
        F.when(none, F.col("number")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(none, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(none, 0).otherwise(F.col("n_text_links")).cast("long").alias("n_text_links"),
        *([] if told_column is None else [F.col("told").alias(told_column)]),
    )


def _with_roots(found: DataFrame) -> DataFrame:
    return found.unionByName(found.select(F.col("root").alias("id"), "root").distinct())


@query()
def op7_near_duplicates(spark, folder):
    """Every document with its class of near duplicates and its number of links."""
    return near_duplicates(table(spark, folder, "documents"))
