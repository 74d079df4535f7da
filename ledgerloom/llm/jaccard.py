"""Jaccard join of word n-gram sets with prefix filtering and a trie join inside blocks.

All n-grams get one global order: by the frequency of their hash bucket (262,144 buckets, counted over
all documents), then by hash.  Two sets that reach the threshold share an n-gram within their first
``n - ceil(t n) + 1`` in that order, and their sizes are within the threshold of each other: of the
documents that hold an n-gram, sorted by size, they lie in one chain without a larger step.  Every
chain with its first document is a candidate group.  Groups are sifted by parity bitmaps of two
bits or more an n-gram: two sets differ in at least as many n-grams as their bitmaps differ in bits, so a pair whose bitmaps
differ too much cannot reach the threshold.  The connected components of the pairs that pass are the
blocks, so that a set travels once.

A group or block of more than ``block_rows`` sets is dealt into tiles of about that size by a hash of the
id, each with the group's leader.  Families of near copies come together through it.  What is still apart
from a group's largest component then meets that component's tiles and itself, so a family travels once
and again for every ``block_rows`` sets that do not belong to it, never for its own size.

Inside a block the sets are stored in a path-compressed trie, frequent n-grams first, so that similar
sets share their paths; a probe walks the trie level by level, adds up the overlap that all sets below
an edge share, and drops subtrees whose remaining lengths cannot reach the threshold.  Equal sets are
one vertex, and blocks hand on stars only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .scratch import Scratch

WORDS, PERCENT, BLOCK_ROWS, TILE_BYTES = 5, 75, 1000, 64 << 20
_BUCKET_BITS = 18
_BUCKETS = 1 << _BUCKET_BITS
_REST = np.uint64(64 - _BUCKET_BITS)


def _count_buckets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            for s in W.word_slices(batch.column(0), lower=True):
                for _, grams in W.shingle_sets(s, k):
                    total += np.bincount((grams >> _REST).astype(np.int64), minlength=_BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_ranks(docs: DataFrame, k: int = WORDS) -> np.ndarray:
    """Rank of every bucket, rare first, counted over all texts; its size is fixed."""
    rows = docs.select("text").mapInArrow(_count_buckets(k), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    freq = np.zeros(_BUCKETS, np.int64)
    for r in rows:
        freq[r.bucket] = r.n
    ranks = np.empty(_BUCKETS, np.uint64)
    ranks[np.lexsort((np.arange(_BUCKETS), freq))] = np.arange(_BUCKETS, dtype=np.uint64)
    return ranks


def ordered(grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """n-grams renamed so that numeric order is the global order (a bijection), sorted."""
    high = ranks[(grams >> _REST).astype(np.int64)] << _REST
    return np.sort(high | (grams & np.uint64((1 << (64 - _BUCKET_BITS)) - 1)))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


BITS = 4096


def parity_bits(grams: np.ndarray) -> bytes:
    """Bit i is the parity of the number of n-grams that hash to i.

    The length is a power of two of at least two bits an n-gram; halves fold by exclusive or.
    """
    size = max(BITS, 1 << (2 * len(grams) - 1).bit_length())
    return np.packbits(np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def _sizes(k: int):
    """Set size, 128-bit set fingerprint and parity bitmap of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                n = np.zeros(batch.num_rows, np.int64)
                one, two = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
                bits = [b""] * batch.num_rows
                for s in W.word_slices(batch.column(1), lower=True):
                    for i, grams in W.shingle_sets(s, k):
                        n[i] = len(grams)
                        bits[i] = parity_bits(grams)
                        one[i] = W.mix64(grams).sum(dtype=np.uint64)
                        two[i] = W.mix64(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(bits, pa.binary())],
                    ["doc_id", "n_shingles", "s1", "s2", "bits"],
                )

    return run


def _prefixes(k: int, percent: int, ranks):
    """(token, n, doc_id): the prefix of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = ranks.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for s in W.word_slices(batch.column(1), lower=True):
                tokens, sizes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
                for i, grams in W.shingle_sets(s, k):
                    if len(grams):
                        head = ordered(grams, order)[: prefix_length(len(grams), percent)]
                        tokens.append(head)
                        sizes.append(np.full(len(head), len(grams), np.int32))
                        docs.append(np.full(len(head), ids[i]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(docs))], ["token", "n", "doc_id"],
                )

    return run


def _chains(percent: int):
    """Rows sorted by (token, n, doc_id): every later document of a chain with the chain's first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            t, n, d = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            n = n.astype(np.int64)
            start = np.ones(len(t), bool)
            start[1:] = (t[1:] != t[:-1]) | (100 * n[:-1] < percent * n[1:])
            if last is not None and last[0] == t[0] and 100 * last[1] >= percent * n[0]:
                start[0] = False
            begin = np.maximum.accumulate(np.where(start, np.arange(len(t)), -1))
            leader = np.where(begin >= 0, d[begin], d[0] if last is None else last[2])
            last = (t[-1], n[-1], leader[-1])
            keep = ~start & (leader != d)
            if keep.any():
                pair = np.unique(np.stack([leader[keep], d[keep]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["leader", "doc_id"])

    return run


def _sets(k: int, ranks):
    """(leader, size, doc_id, grams): the ordered set of every row that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = ranks.value
        for batch in batches:
            for s in W.word_slices(batch.column(3), lower=True):
                rows, sets = [], []
                for i, grams in W.shingle_sets(s, k):
                    if len(grams):
                        rows.append(i)
                        sets.append(ordered(grams, order).tobytes())
                own = batch.select([0, 1, 2]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(sets, pa.binary())], ["leader", "size", "doc_id", "grams"])

    return run


def rows_or_bytes(block_rows: int, tile_bytes: int) -> Column:
    """Size of a group in rows, or as many as its sets' bytes stand for where that is more."""
    return F.greatest(F.count("*"), F.ceil(F.sum("bytes") / tile_bytes * block_rows).cast("long"))


def deal(members: DataFrame, block_rows: int) -> DataFrame:
    """Members (leader, size, doc_id, ...) of groups with the tile they meet in; a leader is in every tile."""
    tiles = F.ceil(F.col("size") / block_rows).cast("long")
    own = F.pmod(F.xxhash64("doc_id"), tiles)
    at = F.when(F.col("doc_id") == F.col("leader"), F.sequence(F.lit(0).cast("long"), tiles - 1)).otherwise(F.array(own))
    return members.select("leader", F.explode(at).alias("tile"), *[c for c in members.columns if c not in ("leader", "size")])


def apart(groups: DataFrame, found: DataFrame, size: Column | None = None) -> DataFrame:
    """(leader, doc_id, main, others, rest): members of groups that are not one component yet.

    ``found`` has (u, component) of linked members.  ``main`` is the size of a group's largest component,
    ``others`` the number of its other members, ``rest`` whether the member is one of these.  ``size`` is
    how members are counted, rows by default.
    """
    more = [c for c in groups.columns if c == "bytes"]
    named = groups.join(found.withColumnRenamed("u", "doc_id"), "doc_id", "left").select("leader", "doc_id", F.coalesce("component", "doc_id").alias("component"), *more)
    sizes = named.groupBy("leader", "component").agg((F.count("*") if size is None else size).alias("n")).groupBy("leader").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("main"), (F.sum("n") - F.max("n")).alias("others"),
    )
    return named.join(sizes.where("others > 0"), "leader").select("leader", "doc_id", "main", "others", (F.col("component") != F.col("largest")).alias("rest"))


def deal_again(members: DataFrame, block_rows: int) -> DataFrame:
    """Members of ``apart`` with their tiles: every other member meets the largest component and the others."""
    rows = members.selectExpr("*", f"cast(ceil(main / {block_rows}) AS long) AS _n", f"cast(ceil(others / {block_rows}) AS long) AS _m")
    rows = rows.selectExpr("*", "pmod(xxhash64(doc_id), if(rest, _m, _n)) AS _own")
    meets = """if(rest, concat(transform(sequence(0L, _n - 1), i -> i * _m + _own),
      transform(sequence(0L, _m - 1), j -> _n * _m + least(_own, j) * _m + greatest(_own, j))), transform(sequence(0L, _m - 1), j -> _own * _m + j))"""
    kept = [c for c in members.columns if c not in ("leader", "main", "others", "rest")]
    return rows.select("leader", F.explode(F.expr(meets)).alias("tile"), *kept)


def grouped(n: int, probe) -> list[int]:
    """Component number of each of n rows; ``probe(i)`` gives the rows that link with row i.

    Rows of the largest component are left unprobed: a link that no probe has seen would join two of
    them.  A family of copies thus costs a few probes, not one for each copy.
    """
    root, size = list(range(n)), [1] * n

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    largest, waiting = 0, list(range(n))
    while waiting:
        left = []
        for i in waiting:
            if size[largest] > 1 and find(i) == largest:
                left.append(i)
                continue
            for j in probe(i):
                a, b = find(i), find(int(j))
                if a != b:
                    a, b = (a, b) if size[a] >= size[b] else (b, a)
                    root[b] = a
                    size[a] += size[b]
            largest = max(largest, find(i), key=lambda r: size[r])
            largest = find(largest)
        waiting = [i for i in left if find(i) != largest]
    return [find(i) for i in range(n)]


def stars(ids: list[int], group: list[int]) -> list[tuple[int, int]]:
    """(document, smallest document of its group) without the smallest ones."""
    least: dict[int, int] = {}
    for g, d in zip(group, ids):
        least[g] = min(d, least.get(g, d))
    return sorted({(d, least[g]) for g, d in zip(group, ids) if d != least[g]})


def sift(ids: list[int], sizes: np.ndarray, bits: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Star edges of the components of pairs whose sizes and bitmaps allow the threshold."""
    length = np.array([len(b) for b in bits])
    level = {n: np.flatnonzero(length == n) for n in np.unique(length).tolist()}
    whole = {n: np.frombuffer(b"".join(bits[i] for i in at), np.uint64).reshape(len(at), -1) for n, at in level.items()}
    place = np.zeros(len(ids), np.int64)
    for at in level.values():
        place[at] = np.arange(len(at))

    def half(x: np.ndarray) -> np.ndarray:
        return x[..., : x.shape[-1] // 2] ^ x[..., x.shape[-1] // 2 :]

    folded = {n: half(x) for n, x in whole.items()}

    def probe(i: int) -> np.ndarray:
        n, out = int(length[i]), []
        # sets within the threshold differ at most by one doubling of the bitmap
        for other, at in level.items():
            if other == n:
                apart = whole[n] ^ whole[n][place[i]]
            elif 2 * other == n:
                apart = whole[other] ^ folded[n][place[i]]
            elif other == 2 * n:
                apart = folded[other] ^ whole[n][place[i]]
            else:
                continue
            apart = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
            both, least = sizes[at] + sizes[i], np.minimum(sizes[at], sizes[i])
            # overlap = (both - difference) / 2 must reach percent * both / (100 + percent)
            near = ((both - apart) * (100 + percent) >= 2 * percent * both) & (100 * least >= percent * (both - least))
            out.append(at[near])
        return np.concatenate(out)

    return stars(ids, grouped(len(ids), probe))


class Trie:
    """Path-compressed trie over number sequences in descending order (frequent n-grams first)."""

    def __init__(self, sequences: list[np.ndarray]):
        order = sorted(range(len(sequences)), key=lambda i: (~sequences[i]).astype(">u4").tobytes())
        # node 0 is the root; an edge is a slice of some sequence
        self.depth, self.parent, self.edge = [0], [-1], [np.zeros(0, np.uint32)]
        self.ends: list[list[int]] = [[]]
        path, before = [0], np.zeros(0, np.uint32)
        for i in order:
            seq = sequences[i]
            m = min(len(before), len(seq))
            differ = np.flatnonzero(before[:m] != seq[:m])
            common = int(differ[0]) if len(differ) else m
            last = -1
            while self.depth[path[-1]] > common:
                last = path.pop()
            top = path[-1]
            if self.depth[top] < common:  # split the edge that was left last
                cut = common - self.depth[top]
                node = self._node(top, common, self.edge[last][:cut])
                self.edge[last], self.parent[last] = self.edge[last][cut:], node
                path.append(node)
                top = node
            if len(seq) > common:
                top = self._node(top, len(seq), seq[common:])
                path.append(top)
            self.ends[top].append(i)
            before = seq
        self._finish(sequences)

    def _node(self, parent: int, depth: int, edge: np.ndarray) -> int:
        self.depth.append(depth)
        self.parent.append(parent)
        self.edge.append(edge)
        self.ends.append([])
        return len(self.depth) - 1

    def _finish(self, sequences: list[np.ndarray]) -> None:
        n = len(self.depth)
        depth, parent = np.array(self.depth), np.array(self.parent)
        self.length = np.array([len(e) for e in self.edge])
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.tokens = np.concatenate(self.edge)
        self.final = np.array([e[-1] if len(e) else 0 for e in self.edge], np.int64)
        small, large = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        for node, ends in enumerate(self.ends):
            if ends:
                small[node] = large[node] = depth[node]
        for node in np.argsort(-depth, kind="stable"):
            p = parent[node]
            if p >= 0:
                small[p], large[p] = min(small[p], small[node]), max(large[p], large[node])
        self.smallest, self.largest, self.level = small, large, depth
        by = np.argsort(parent, kind="stable")
        self.children = by[np.searchsorted(parent[by], 0) :]
        self.first = np.searchsorted(parent[self.children], np.arange(n))
        self.count = np.searchsorted(parent[self.children], np.arange(n), side="right") - self.first
        self.ending = np.array([bool(e) for e in self.ends])

    @staticmethod
    def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.arange(size.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)

    def probe(self, own: np.ndarray, member: np.ndarray, percent: int) -> list[int]:
        """Sequences whose Jaccard with ``own`` (ascending) reaches the threshold; ``member`` marks it."""
        found: list[int] = []
        nodes = self.children[self._flat(self.first[:1], self.count[:1])]
        shared = np.zeros(len(nodes), np.int64)
        while len(nodes):
            size = self.length[nodes]
            hits = np.concatenate([[0], np.cumsum(member[self.tokens[self._flat(self.start[nodes], size)]])])
            ends = np.cumsum(size)
            shared = shared + hits[ends] - hits[ends - size]
            full = self.ending[nodes] & ((100 + percent) * shared >= percent * (len(own) + self.level[nodes]))
            for node in nodes[full]:
                found += self.ends[node]
            left = np.minimum(np.searchsorted(own, self.final[nodes]), self.largest[nodes] - self.level[nodes])
            go = (self.count[nodes] > 0) & ((100 + percent) * (shared + left) >= percent * (len(own) + self.smallest[nodes]))
            nodes, shared = nodes[go], np.repeat(shared[go], self.count[nodes[go]])
            nodes = self.children[self._flat(self.first[nodes], self.count[nodes])]
        return found


def block_edges(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Star edges (document, smallest document) of the linked components of one block."""
    sizes = [len(x) for x in sets]
    universe, local = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum(sizes)[:-1]
    own = np.split(local.astype(np.uint32), cuts)
    trie = Trie([x[::-1] for x in own])
    member = np.zeros(len(universe), bool)

    def probe(i: int) -> list[int]:
        member[own[i]] = True
        found = trie.probe(own[i], member, percent)
        member[own[i]] = False
        return found

    return stars(ids, grouped(len(ids), probe))


def _by_block(work):
    """Rows sorted by (leader, tile): edges that ``work`` finds among the rows of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], ["u", "v"])

        for batch in batches:
            out = []
            for at in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if at[:2] != key:
                    out += work(list(dict.fromkeys(rows))) if len(rows) > 1 else []
                    key, rows = at[:2], []
                rows.append(at[2:])
            yield edges(out)
        yield edges(work(list(dict.fromkeys(rows))) if len(rows) > 1 else [])

    return run


def _sift_block(percent: int):
    return lambda rows: sift([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), [r[2] for r in rows], percent)


def _join_block(percent: int):
    return lambda rows: block_edges([r[0] for r in rows], [np.frombuffer(r[1], np.uint64) for r in rows], percent)


def jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block_rows: int = BLOCK_ROWS,
                   tile_bytes: int = TILE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Documents link when 100 * intersection >= percent * union of their sets of ``words``-word
    shingles (A-Z lower-cased; fewer words: the whole sequence as one).  ``component_id`` is the
    smallest doc_id reachable by links, the document's own included.  Null or empty texts have no
    shingles and link with nothing.  A null id gets its size and no component.  Rows that share an
    id are one document with several texts: it has the links of them all.  Extra columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"cast(`{text_col}` AS string) AS text")
    ranks = spark.sparkContext.broadcast(bucket_ranks(rows, words))

    sizes = scratch.write(rows.mapInArrow(_sizes(words), "doc_id long, n_shingles long, s1 long, s2 long, bits binary"), "sizes")
    reps = scratch.write(
        sizes.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("node")), "reps",
    )
    texts = rows.where("text IS NOT NULL").join(reps.select(F.col("node").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    pairs = scratch.write(
        texts.mapInArrow(_prefixes(words, percent, ranks), "token long, n int, doc_id long")
        .repartition(parts, "token").sortWithinPartitions("token", "n", "doc_id")
        .mapInArrow(_chains(percent), "leader long, doc_id long").distinct(), "pairs",
    )
    groups = pairs.unionByName(pairs.select("leader", F.col("leader").alias("doc_id"))).distinct()
    groups = scratch.write(groups.join(groups.groupBy("leader").agg(F.count("*").alias("size")), "leader"), "groups")
    kept = sizes.join(reps, ["s1", "s2", "n_shingles"]).where("doc_id = node").select("doc_id", "n_shingles", "bits")

    def with_bits(members: DataFrame) -> DataFrame:
        return members.join(kept.hint("merge"), "doc_id").select(*members.columns, "n_shingles", "bits")

    def with_sets(members: DataFrame) -> DataFrame:
        sized = members if "size" in members.columns else members.withColumn("size", F.lit(0).cast("long"))
        found = texts.join(sized.select("leader", "size", "doc_id").hint("merge"), "doc_id").select("leader", "size", "doc_id", "text").mapInArrow(
            _sets(words, ranks), "leader long, size long, doc_id long, grams binary")
        return found if "size" in members.columns else found.drop("size").join(members.hint("merge"), ["leader", "doc_id"])

    def meet(dealt: DataFrame, work, name: str) -> DataFrame:
        met = dealt.repartition(parts, "leader", "tile").sortWithinPartitions("leader", "tile", "doc_id")
        return scratch.write(met.mapInArrow(_by_block(work), "u long, v long").distinct(), name)

    def linked(groups: DataFrame, attach, work, name: str) -> DataFrame:
        """Edges (u, v) that connect every group as ``work`` does, of members with what ``attach`` adds."""
        edges = meet(deal(attach(groups), block_rows), work, name)
        large = groups.where(F.col("size") > block_rows)
        if large.isEmpty():  # every group was one tile
            return edges
        by = rows_or_bytes(block_rows, tile_bytes) if "bytes" in groups.columns else None
        split = scratch.write(apart(large, components(edges, scratch, f"{name}_tiles"), by), f"{name}_apart")
        return edges.unionByName(meet(deal_again(attach(split), block_rows), work, f"{name}_again"))

    maybe = linked(groups, with_bits, _sift_block(percent), "maybe")
    near = components(maybe, scratch, "candidates").select(F.col("u").alias("doc_id"), "component")
    near = scratch.write(near.unionByName(near.select(F.col("component").alias("doc_id"), "component")).distinct(), "near")
    # tiles of sets are bounded by rows and by bytes
    near = near.join(kept.select("doc_id", (8 * F.col("n_shingles")).alias("bytes")).hint("merge"), "doc_id")
    whole = near.join(near.groupBy("component").agg(rows_or_bytes(block_rows, tile_bytes).alias("size")), "component")
    blocks = scratch.write(whole.select(F.col("component").alias("leader"), "size", "doc_id", "bytes"), "blocks")
    links = linked(blocks, with_sets, _join_block(percent), "edges")
    placed = scratch.write(
        sizes.where("n_shingles > 0 AND doc_id IS NOT NULL").join(reps, ["s1", "s2", "n_shingles"]).select("doc_id", "node"), "placed",
    )
    # an id with several texts stands for all their sets
    several = placed.where("doc_id <> node").join(
        placed.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("doc_id"), "doc_id", "left_semi",
    )
    found = components(links.unionByName(several.select(F.col("doc_id").alias("u"), F.col("node").alias("v"))), scratch, "links")
    found = scratch.write(found.select(F.col("u").alias("node"), "component"), "components")
    named = placed.join(found, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component"))
    scratch.keep("sizes", "placed", "components")
    return sizes.join(named, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
    )


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
),
s AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 5
      THEN list_transform(range(1, len(ws) - 3), lambda p: array_to_string(ws[p:p + 4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS k FROM d
  )
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""
