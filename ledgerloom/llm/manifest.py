"""Merkle manifest of a dataset, with a proof for every row, by time-forward processing.

Each language has a binary tree over its rows by id, and the roots of the languages have a tree of
their own.  A node's label is (the last leaf below it, its level), so children come before their parent.
Nodes are processed by ascending label: a node sends its digest to its parent through a priority queue
that is ordered by label, and takes what its own children have sent.  A second sweep by descending label
sends every node's proof suffix (the siblings from there to the root) to its children in the same way.

Trees are cut into blocks of ``BLOCK_LEVELS`` levels.  Between blocks the queue is external: Spark's
sorted shuffle delivers block roots to the blocks above, and proof suffixes to the blocks below, by
(tree, block, position); inside a block it is a heap that holds a few messages.  A leaf's proof is
folded where it arrives, so no proof is shuffled or stored, only one suffix for each block.  Texts are
read once and hashed by Spark; what travels is about a hundred bytes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

BLOCK_LEVELS, TAMPER = 10, 7
NONE, LEFT, RIGHT = 0, 1, 2
_ENTRY = 33
Node = tuple[int, int, int, bytes]


def parent_digest(children: bytes) -> bytes:
    """Digest of one or two child digests, hashed as hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


def depth(n: int) -> int:
    """Levels above n leaves; a single one is the root itself."""
    return max(n - 1, 0).bit_length()


def sweep_up(leaves: Iterator[bytes], count: int, levels: int) -> list[Node]:
    """(last leaf, level, index, digest) of all nodes of a block of ``count`` leaves, by ascending label."""
    queue: list[Node] = []
    nodes: list[Node] = []

    def finished(last: int, level: int, index: int, digest: bytes) -> None:
        nodes.append((last, level, index, digest))
        if level < levels:
            above = min((index // 2 + 1) << (level + 1), count) - 1
            heappush(queue, (above, level + 1, index, digest))

    for at, leaf in enumerate(leaves):
        finished(at, 0, at, leaf)
        while queue and queue[0][0] == at:
            last, level, index, digest = heappop(queue)
            if queue and queue[0][:2] == (last, level):
                digest += heappop(queue)[3]
            finished(last, level, index // 2, parent_digest(digest))
    return nodes


def sweep_down(nodes: list[Node], count: int, suffix: bytes) -> Iterator[tuple[int, bytes]]:
    """(leaf, proof suffix) by descending label; ``suffix`` is that of the block's root.

    A suffix is a run of entries (side of the sibling, its digest), the lowest level first.
    """
    digests = {(level, index): digest for _, level, index, digest in nodes}
    queue = [(-nodes[-1][0], -nodes[-1][1], suffix)]
    for last, level, index, _ in reversed(nodes):
        own = heappop(queue)
        assert own[:2] == (-last, -level)
        if level == 0:
            yield last, own[2]
            continue
        left, right = digests[level - 1, 2 * index], digests.get((level - 1, 2 * index + 1))
        if right is not None:
            heappush(queue, (-last, 1 - level, bytes([LEFT]) + left + own[2]))
        entry = bytes([NONE]) + bytes(32) if right is None else bytes([RIGHT]) + right
        middle = min((2 * index + 1) << (level - 1), count) - 1
        heappush(queue, (-middle, 1 - level, entry + own[2]))


def fold(digest: bytes, suffix: bytes) -> bytes:
    """The root that a leaf and the siblings of its proof lead to."""
    for a in range(0, len(suffix), _ENTRY):
        side, other = suffix[a], suffix[a + 1 : a + _ENTRY]
        digest = parent_digest(digest if side == NONE else other + digest if side == LEFT else digest + other)
    return digest


def proof_digest(suffix: bytes) -> str:
    siblings = b"".join([suffix[a + 1 : a + _ENTRY] for a in range(0, len(suffix), _ENTRY) if suffix[a] != NONE])
    return hashlib.sha256(siblings.hex().encode()).hexdigest()


def _shape(n: int, block: int, height: int) -> tuple[int, int]:
    """(leaves of a block, its levels) in a tree of n leaves cut into blocks of ``height`` levels."""
    return min(1 << height, n - (block << height)), min(height, depth(n))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    """((tree, block), its rows) of rows sorted by them."""
    key, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if (r["tree"], r["block"]) != key:
                if rows:
                    yield key, rows
                key, rows = (r["tree"], r["block"]), []
            rows.append(r)
    if rows:
        yield key, rows


def _climb(height: int):
    """The root of every block is a node of the next stage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in _blocks(batches):
            n = rows[0]["n"]
            nodes = sweep_up((r["digest"] for r in rows), *_shape(n, block, height))
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree]), pa.array([block]), pa.array([-(-n >> height)]), pa.array([nodes[-1][3]], pa.binary())], ["tree", "pos", "n", "digest"],
            )

    return run


_HEAD = "tree string, block long, suffix binary, subroot binary, root binary"
_PROOF = ("doc_id long, name string, leaf string, digest binary, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, suffix binary")


def _descend(height: int, leaves: bool):
    """Suffixes of the block roots come first in each block; those of its leaves, or what they prove, go out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), (head, *rows) in _blocks(batches):
            count, levels = _shape(rows[0]["n"], block, height)
            nodes = sweep_up((r["digest"] for r in rows), count, levels)
            found = sweep_down(nodes, count, head["suffix"])
            if not leaves:
                out = [{"tree": tree, "block": (block << height) + at, "suffix": suffix, "subroot": head["subroot"], "root": head["root"]} for at, suffix in found]
                yield pa.RecordBatch.from_pylist(out, _ARROW_HEAD)
                continue
            out = []
            for at, suffix in found:
                r = rows[at]
                folded = fold(r["changed"] or r["digest"], suffix)
                out.append({
                    "doc_id": r["doc_id"], "name": r["name"], "leaf": r["digest"].hex(), "digest": r["digest"], "subroot": head["subroot"] and head["subroot"].hex(),
                    "root": head["root"].hex(), "proof_sha256": proof_digest(suffix), "folded_root": folded.hex(), "verified": folded == head["root"],
                    "suffix": suffix if r["name"] is not None else None,
                })
            yield pa.RecordBatch.from_pylist(out, _ARROW_PROOF)

    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


_ARROW_HEAD, _ARROW_PROOF = _arrow(_HEAD), _arrow(_PROOF)


class Forest:
    """Trees over numbered leaves, one stage of blocks after the other; ``name``, ``doc_id`` and ``changed`` belong to leaves."""

    def __init__(self, scratch: Scratch, leaves: DataFrame, height: int):
        self.scratch, self.height = scratch, height
        self.parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
        self.stages = [leaves]
        while (self.stages[-1].agg(F.max("n")).first()[0] or 0) > 1:
            nodes = self.stages[-1].select("tree", F.shiftright("pos", self.height).alias("block"), "pos", "n", "digest")
            dealt = nodes.repartition(self.parts, "tree", "block").sortWithinPartitions("tree", "block", "pos")
            self.stages.append(scratch.write(dealt.mapInArrow(_climb(height), "tree string, pos long, n long, digest binary")))

    def roots(self) -> DataFrame:
        return self.stages[-1].select("tree", "digest")

    def prove(self, heads: DataFrame) -> DataFrame:
        """What the leaves prove; ``heads`` has the suffix of every tree's root as its block 0."""
        stages = self.stages[-2::-1] or self.stages
        for k, stage in enumerate(stages, 1):
            extra = [F.col(c) if c in stage.columns else F.lit(None).cast(t).alias(c) for c, t in (("name", "string"), ("doc_id", "long"), ("changed", "binary"))]
            nodes = stage.select("tree", F.shiftright("pos", self.height).alias("block"), "pos", "n", "digest", *extra)
            both = nodes.unionByName(heads.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
            dealt = both.repartition(self.parts, "tree", "block").sortWithinPartitions("tree", "block", "pos")
            last = k == len(stages)
            found = dealt.mapInArrow(_descend(self.height, last), _PROOF if last else _HEAD)
            heads = found if last else self.scratch.write(found)
        return heads


def numbered(scratch: Scratch, name: str, rows: DataFrame, *order: str) -> DataFrame:
    """A table of ``rows`` with their number ``pos`` in their tree and the tree's size ``n``, by a range sort; no tree meets in one task."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    placed = scratch.write(placed.withColumn("part", F.shiftright("at", 33)))
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "part", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("size").over(Window.partitionBy("tree")).alias("n"))
    return scratch.write(placed.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift"), name)


def _field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def merkle_manifest(docs: DataFrame, tamper: int = TAMPER, block_levels: int = BLOCK_LEVELS, id_col: str = "doc_id", group_col: str = "lang",
                    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), counter: str = "n_chars") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, digests as hex text.

    A leaf is the SHA-256 of its ``columns``, any of which may be null or empty and of any length; a
    parent that of its one or two children.  Leaves ascend by id, null ids first, rows that share an id
    by their leaf (equal rows are interchangeable); a null group is the first one, and is a group of its
    own.  Where ``tamper`` divides the CRC-32 of the decimal id, 1 is added to ``counter`` before the
    root is folded from the row's proof, so that row does not verify unless its counter is null; a
    null id is never tampered with.  An empty table gives no rows; extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "manifest")
    given = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*columns, id_col, group_col))])

    def digest(**changed: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*[_field(changed.get(c, F.col(f"`{c}`"))) for c in columns]).cast("binary"), 256))

    more = F.expr(f"try_add(cast(`{counter}` AS long), 1L)")
    tampered = F.crc32(F.col(f"`{id_col}`").cast("long").cast("string").cast("binary")) % tamper == 0
    group = F.col(f"`{group_col}`").cast("string")
    leaves = scratch.write(given.select(
        F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit(":"), group)).alias("tree"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        digest().alias("digest"), F.when(tampered, digest(**{counter: more})).alias("changed"),
    ))
    forest = Forest(scratch, numbered(scratch, "rows", leaves, "doc_id", "digest"), block_levels)
    subroots = forest.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    top = Forest(scratch, numbered(scratch, "groups", subroots, "name"), block_levels)
    none = F.lit(b"")
    start = top.roots().select("tree", F.lit(0).cast("long").alias("block"), none.alias("suffix"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    heads = top.prove(start).select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "suffix", F.col("digest").alias("subroot"), F.unhex("root").alias("root"))
    proofs = forest.prove(scratch.write(heads))
    scratch.keep("rows", scratch.names[-1])
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_LEAF_SQL = """sha256(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN {0} IS NULL THEN '-' ELSE strlen(({0})::VARCHAR) || ':' || ({0}) END
    || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END)"""
#: CRC-32 by bits: a byte is mixed in, then eight steps of the reversed polynomial.
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""
OP13_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, lang, {_LEAF_SQL.format("n_chars")} AS leaf,
    CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_LEAF_SQL.format("n_chars + 1")} END AS changed
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, coalesce(':' || lang, '') AS tree FROM leaf),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM low WHERE n > 1 GROUP BY tree, level, pos // 2
),
subroot AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS top_pos FROM low WHERE n = 1),
top AS (
  SELECT 0 AS level, top_pos AS pos, subroot AS h, count(*) OVER () AS n FROM subroot
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM top WHERE n > 1 GROUP BY level, pos // 2
),
steps AS (
  SELECT p.tree, p.pos AS leaf_pos, l.level, (p.pos >> l.level) & 1 AS odd, s.h AS sibling
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM low WHERE n > 1) l USING (tree)
  LEFT JOIN low s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.tree, p.pos, 1000 + t.level, (top_pos >> t.level) & 1, s.h
  FROM placed p JOIN subroot USING (tree), (SELECT DISTINCT level FROM top WHERE n > 1) t
  LEFT JOIN top s ON s.level = t.level AND s.pos = xor(top_pos >> t.level, 1)
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, leaf_pos ORDER BY level) AS k FROM steps),
proof AS (SELECT tree, leaf_pos, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256, count(*) AS n_steps FROM numbered GROUP BY ALL),
fold AS (
  SELECT tree, pos AS leaf_pos, 0::BIGINT AS k, coalesce(changed, leaf) AS h FROM placed
  UNION ALL
  SELECT f.tree, f.leaf_pos, n.k, sha256(CASE WHEN sibling IS NULL THEN h WHEN odd = 1 THEN sibling || h ELSE h || sibling END)
  FROM fold f JOIN numbered n ON n.tree = f.tree AND n.leaf_pos = f.leaf_pos AND n.k = f.k + 1
),
folded AS (SELECT tree, leaf_pos, arg_max(h, k) AS folded_root FROM fold GROUP BY ALL)
SELECT p.doc_id, p.leaf, s.subroot, r.h AS root, coalesce(f.proof_sha256, sha256('')) AS proof_sha256, d.folded_root, d.folded_root = r.h AS verified
FROM placed p JOIN subroot s USING (tree) JOIN (SELECT h FROM top WHERE n = 1) r ON true
LEFT JOIN proof f ON f.tree = p.tree AND f.leaf_pos = p.pos
JOIN folded d ON d.tree = p.tree AND d.leaf_pos = p.pos
"""
