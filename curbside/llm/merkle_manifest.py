"""Merkle manifest of a dataset, its trees kept in blocks of van Emde Boas layout.

Every row is a leaf. The leaves of one language, in the order of their ids, form a
tree of pairs; the languages' subroots form one more tree, whose root names the
whole dataset. A last node without a partner is hashed alone.

A tree is cut into aligned subtrees of ``HEIGHT`` pairings. Each is one row, its
nodes one array in van Emde Boas order: the upper half of the levels first, then
every subtree of the lower half, each laid out in the same way. The place of a
node is arithmetic on (levels, depth, index), used both to build a block and to
fetch siblings from it; nothing is tuned to a cache or page size. The roots of
blocks are the nodes of the next tier, cut into blocks again, until one remains.
Paths to the root go back down the tiers, so a row needs its own block and one path.

All groups that meet in a task are blocks, of at most 2^HEIGHT leaves. Texts are
hashed where they are read and never shuffled.

Defined results: a NULL language is a tree of its own, before the others; NULL ids
sort first and are never tampered with; rows of one id follow the order of their
leaf digests, and each is a leaf; an empty table gives an empty result. Empty and
very long texts are hashed like any other. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.order import numbered
from curbside.operators.joins import lookup_join
from curbside.workspace import staged

# Pairings within a block: 1,024 leaves and 64 KB of nodes.
HEIGHT = 10
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
# Fixed value: length of a digest, and of a path's step with its kind before it.
DIGEST, STEP = 32, 33
ALONE, LEFT, RIGHT = 0, 1, 2
WHOLE = "whole"  # the one tree over the subroots

_BLOCK = "tree string, block long, total long, levels int, n int, root binary, nodes binary"
_PATH = "tree string, at long, path binary, subroot binary, top binary"


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes in a tree of ``levels`` levels, laid out by halves of its height."""
    index = np.asarray(index, np.int64)
    place = np.zeros(len(index), np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        levels -= upper
        depth -= upper
        place += (1 << upper) - 1 + (index >> depth) * ((1 << levels) - 1)
        index = index & ((1 << depth) - 1)
    return place


def _levels(total: int) -> int:
    """Levels of the blocks of a tier with so many nodes in its tree."""
    return min(HEIGHT, (total - 1).bit_length()) + 1


def _count(n: int, levels: int, depth: int) -> int:
    """Nodes at a depth of a block with n leaves."""
    step = levels - 1 - depth
    return -(-n >> step)


def build_block(leaves: bytes, levels: int) -> bytes:
    """Digests of all nodes over the given leaf digests, in van Emde Boas order."""
    n = len(leaves) // DIGEST
    nodes = np.zeros(((1 << levels) - 1, DIGEST), np.uint8)
    nodes[address(levels, levels - 1, np.arange(n))] = np.frombuffer(leaves, np.uint8).reshape(n, DIGEST)
    for depth in range(levels - 2, -1, -1):
        below = np.arange(_count(n, levels, depth + 1))
        listed = nodes[address(levels, depth + 1, below)].tobytes().hex().encode()
        pairs = range(0, len(listed), 4 * DIGEST)
        made = b"".join([hashlib.sha256(listed[i : i + 4 * DIGEST]).digest() for i in pairs])
        here = np.arange(_count(n, levels, depth))
        nodes[address(levels, depth, here)] = np.frombuffer(made, np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


def block_paths(nodes: bytes, n: int, levels: int, leaves: np.ndarray) -> list[bytes]:
    """For each of the given leaves, its steps up to the block's root: a kind and a sibling each."""
    held = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    steps = np.zeros((len(leaves), levels - 1, STEP), np.uint8)
    for number, depth in enumerate(range(levels - 1, 0, -1)):
        index = np.asarray(leaves, np.int64) >> number
        sibling = index ^ 1
        there = sibling < _count(n, levels, depth)
        steps[there, number, 0] = np.where(index[there] & 1, LEFT, RIGHT)
        steps[there, number, 1:] = held[address(levels, depth, sibling[there])]
    return [row.tobytes() for row in steps]


def steps_of(path: bytes) -> list[tuple[int, bytes]]:
    """A path's steps as (kind, hex digest of the sibling)."""
    return [(path[i], path[i + 1 : i + STEP].hex().encode()) for i in range(0, len(path), STEP)]


def fold(leaf: bytes, steps: list[tuple[int, bytes]]) -> str:
    """The root that a leaf and its siblings give, in hex."""
    node = leaf.hex()
    for kind, sibling in steps:
        own = node.encode()
        run = own if kind == ALONE else sibling + own if kind == LEFT else own + sibling
        node = hashlib.sha256(run).hexdigest()
    return node


def proof_digest(steps: list[tuple[int, bytes]]) -> str:
    return hashlib.sha256(b"".join(sibling for kind, sibling in steps if kind != ALONE)).hexdigest()


@dataclass
class Manifest:
    """Trees over a dataset: its leaves by place, and the tiers of blocks of both kinds of tree."""

    leaves: DataFrame  # (tree, at, key, leaf, changed)
    tiers: list[DataFrame] = field(default_factory=list)
    subroots: DataFrame | None = None  # (tree, at, subroot), ordered by tree
    top: list[DataFrame] = field(default_factory=list)

    def blocks(self) -> DataFrame:
        """Every stored block, as (part, tier, tree, block, total, levels, n, root, nodes)."""
        parts = [("group", self.tiers), ("whole", self.top)]
        named = [
            tier.select(F.lit(part).alias("part"), F.lit(number).alias("tier"), "*")
            for part, tiers in parts
            for number, tier in enumerate(tiers)
        ]
        return reduce(DataFrame.unionByName, named)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]).cast("binary"), 256))


def _tree_name(group: Column) -> Column:
    """Never NULL, in the order of the group with NULL first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _build(nodes: DataFrame, label: str) -> DataFrame:
    """Blocks over nodes (tree, at, digest, total)."""

    def built(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        first = {name: table.column(name)[0].as_py() for name in ("tree", "block", "total")}
        levels = _levels(first["total"])
        nodes = build_block(b"".join(table.column("digest").to_pylist()), levels)
        row = {**first, "levels": levels, "n": table.num_rows, "root": nodes[:DIGEST], "nodes": nodes}
        return pa.Table.from_pylist([row], _arrow_schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    _arrow_schema = pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in _BLOCK.split(", ")])
    keyed = nodes.select("tree", "at", "digest", "total", F.shiftright("at", HEIGHT).alias("block"))
    return staged(keyed.groupBy("tree", "block").applyInArrow(built, _BLOCK), label)


def _tiers(nodes: DataFrame, largest: int, label: str) -> list[DataFrame]:
    """Blocks of all tiers; ``largest`` is the number of nodes of the largest tree."""
    tiers = [_build(nodes, label)]
    while largest > 1 << HEIGHT:
        largest = -(-largest >> HEIGHT)
        total = F.shiftright(F.col("total") + ((1 << HEIGHT) - 1), HEIGHT)
        above = tiers[-1].where(F.col("total") > 1 << HEIGHT)
        above = above.select("tree", F.col("block").alias("at"), F.col("root").alias("digest"), total.alias("total"))
        tiers.append(_build(above, label))
    return tiers


def _finished(tier: DataFrame) -> DataFrame:
    return tier.where(F.col("total") <= 1 << HEIGHT)


def build_manifest(
    docs: DataFrame,
    group: str = "lang",
    key: str = "doc_id",
    fields: list[str] = FIELDS,
    changed: list[Column] | None = None,
) -> Manifest | None:
    """The manifest of all rows, or None of an empty table.

    ``changed`` may give other values for the fields, of which each row's
    ``changed`` leaf is made beside its own; it enters no tree.
    """
    leaf = _digest([F.col(name) for name in fields])
    other = leaf if changed is None else _digest(changed)
    leaves = docs.select(
        _tree_name(F.col(group)).alias("tree"), F.col(key).alias("key"), leaf.alias("leaf"), other.alias("changed")
    )
    placed = staged(numbered(leaves, "tree", ["key", "leaf"]), "merkle-leaves")
    totals = staged(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("total")), "merkle-totals")
    largest = totals.agg(F.max("total")).first()[0]
    if largest is None:
        return None
    nodes = lookup_join(placed.select("tree", "at", F.col("leaf").alias("digest")), totals, ["tree"])
    manifest = Manifest(placed, _tiers(nodes, largest, "merkle-blocks"))
    done = [_finished(tier).select("tree", F.col("root").alias("subroot")) for tier in manifest.tiers]
    subroots = reduce(DataFrame.unionByName, done).withColumn("whole", F.lit(WHOLE))
    manifest.subroots = staged(numbered(subroots, "whole", ["tree"]).drop("whole"), "merkle-subroots")
    trees = manifest.subroots.count()
    nodes = manifest.subroots.select(
        F.lit(WHOLE).alias("tree"), "at", F.col("subroot").alias("digest"), F.lit(trees).cast("long").alias("total")
    )
    manifest.top = _tiers(nodes, trees, "merkle-top")
    return manifest


def _spread(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Paths of all leaves of blocks, whose roots' paths are (tree, at, path, ...) with at the block."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = np.arange(row["n"])
                own = block_paths(row["nodes"], row["n"], row["levels"], places)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(own), pa.string()),
                        pa.array(places + (row["block"] << HEIGHT), pa.int64()),
                        pa.array([path + row["path"] for path in own], pa.binary()),
                        pa.array([row["subroot"]] * len(own), pa.binary()),
                        pa.array([row["top"]] * len(own), pa.binary()),
                    ],
                    names=["tree", "at", "path", "subroot", "top"],
                )

    met = blocks.join(above.withColumnRenamed("at", "block"), ["tree", "block"])
    return met.select("tree", "block", "n", "levels", "nodes", "path", "subroot", "top").mapInArrow(spread, _PATH)


def _descend(tiers: list[DataFrame], roots: DataFrame, last: int = 0) -> DataFrame:
    """Paths of the nodes of tier ``last``, from those of the trees' roots down."""
    above = None
    for number in range(len(tiers) - 1, last - 1, -1):
        own = roots.join(_finished(tiers[number]).select("tree"), "tree", "left_semi")
        above = own if above is None else above.unionByName(own)
        above = staged(_spread(tiers[number], above), "merkle-paths")
    return above if above is not None else roots


def _block_paths(manifest: Manifest) -> DataFrame:
    """Paths of the roots of the lowest blocks up to the dataset's root."""
    top = manifest.top[-1].select(
        "tree",
        F.lit(0).cast("long").alias("at"),
        F.lit(b"").alias("path"),
        F.lit(b"").alias("subroot"),
        F.col("root").alias("top"),
    )
    of_trees = _descend(manifest.top, top).select("at", "path", "top")
    roots = manifest.subroots.join(of_trees, "at").select(
        "tree", F.lit(0).cast("long").alias("at"), "path", "subroot", "top"
    )
    roots = staged(roots, "merkle-roots")
    lowest = roots.join(_finished(manifest.tiers[0]).select("tree"), "tree", "left_semi")
    if len(manifest.tiers) == 1:
        return lowest
    return _descend(manifest.tiers, roots, 1).unionByName(lowest)


def verify_leaves(manifest: Manifest) -> DataFrame:
    """Rows (key, leaf, subroot, root, proof_sha256, folded_root, verified), one per leaf.

    Every row's ``changed`` leaf is folded with the siblings of the stored trees.
    """
    kind = manifest.leaves.schema["key"].dataType.simpleString()
    schema = f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.string()] * 5 + [pa.bool_()]

    def checked(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        block = blocks.to_pylist()[0]
        places = rows.column("at").to_numpy() & ((1 << HEIGHT) - 1)
        above = steps_of(block["path"])
        top = block["top"].hex()
        out: list[list] = [[] for _ in kinds]
        paths = block_paths(block["nodes"], block["n"], block["levels"], places)
        leaves, changed = rows.column("leaf").to_pylist(), rows.column("changed").to_pylist()
        for path, leaf, other in zip(paths, leaves, changed):
            steps = steps_of(path) + above
            folded = fold(other, steps)
            cells = (leaf.hex(), block["subroot"].hex(), top, proof_digest(steps), folded, folded == top)
            for column, cell in zip(out, cells):
                column.append(cell)
        arrays = [rows.column("key"), *(pa.array(v, k) for v, k in zip(out, kinds))]
        return pa.Table.from_arrays(arrays, names=names)

    above = _block_paths(manifest).withColumnRenamed("at", "block")
    blocks = manifest.tiers[0].join(above, ["tree", "block"])
    blocks = blocks.select("tree", "block", "n", "levels", "nodes", "path", "subroot", "top")
    rows = manifest.leaves.withColumn("block", F.shiftright("at", HEIGHT))
    paired = rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
    return paired.applyInArrow(checked, schema)


def tampered_check(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one per document.

    Where 7 divides the CRC of the id, one is added to ``n_chars`` before the check.
    """
    divided = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    n_chars = F.when(divided, more.cast("string")).otherwise(F.col("n_chars").cast("string"))
    values = [n_chars if name == "n_chars" else F.col(name) for name in FIELDS]
    manifest = build_manifest(docs.select(*FIELDS), changed=values)
    if manifest is None:
        columns = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], columns)
    return verify_leaves(manifest).withColumnRenamed("key", "doc_id")


# Eight steps of the reflected CRC for each digit, as DuckDB has no such function.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::bigint],
    list_transform(range(length(cast(doc_id as varchar))), lambda i: ascii(substr(cast(doc_id as varchar), cast(i + 1 as int), 1))::bigint)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda r, z: xor(r >> 1, case when r & 1 = 1 then 3988292384 else 0 end))))"""


def _sql_field(name: str) -> str:
    text = f"cast({name} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_leaf(n_chars: str) -> str:
    fields = [_sql_field(n_chars if name == "n_chars" else name) for name in FIELDS]
    return f"sha256({' || '.join(fields)})"


SQL = f"""with recursive leaves as (
    select doc_id, coalesce('=' || lang, '-') as tree, {_sql_leaf('n_chars')} as leaf,
      {_sql_leaf(f'(n_chars + case when {_CRC} % 7 = 0 then 1 else 0 end)')} as changed
    from documents),
  placed as (
    select *, row_number() over (partition by tree order by doc_id, leaf) - 1 as spot,
      count(*) over (partition by tree) as total from leaves),
  nodes as (
    select tree, 0 as level, spot, total, leaf as node from placed
    union all
    select tree, level + 1, spot // 2, any_value((total + 1) // 2), sha256(string_agg(node, '' order by spot))
    from nodes where total > 1 group by tree, level, spot // 2),
  subroots as (
    select tree, node as subroot, row_number() over (order by tree) - 1 as spot, count(*) over () as total
    from nodes where total = 1),
  tops as (
    select 0 as level, spot, total, subroot as node from subroots
    union all
    select level + 1, spot // 2, any_value((total + 1) // 2), sha256(string_agg(node, '' order by spot))
    from tops where total > 1 group by level, spot // 2),
  climb as (
    select doc_id, leaf, tree, 0 as level, spot, total, changed as node, '' as proof from placed
    union all
    select c.doc_id, c.leaf, c.tree, c.level + 1, c.spot // 2, (c.total + 1) // 2,
      sha256(case when s.node is null then c.node when s.spot < c.spot then s.node || c.node else c.node || s.node end),
      c.proof || coalesce(s.node, '')
    from climb c left join nodes s on s.tree = c.tree and s.level = c.level and s.spot = xor(c.spot, 1)
    where c.total > 1),
  higher as (
    select c.doc_id, c.leaf, r.subroot, 0 as level, r.spot, r.total, c.node, c.proof
    from climb c join subroots r using (tree) where c.total = 1
    union all
    select h.doc_id, h.leaf, h.subroot, h.level + 1, h.spot // 2, (h.total + 1) // 2,
      sha256(case when s.node is null then h.node when s.spot < h.spot then s.node || h.node else h.node || s.node end),
      h.proof || coalesce(s.node, '')
    from higher h left join tops s on s.level = h.level and s.spot = xor(h.spot, 1)
    where h.total > 1)
  select h.doc_id, h.leaf, h.subroot, t.node as root, sha256(h.proof) as proof_sha256, h.node as folded_root,
    h.node = t.node as verified
  from higher h cross join (select node from tops where total = 1) t where h.total = 1"""
