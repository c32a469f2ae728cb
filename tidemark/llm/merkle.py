"""Merkle manifest of a dataset: a tree of SHA-256 digests whose parents keep the hash state before each child.

A row's leaf is the digest of its fields.  The leaves of a group (a source), in order, are folded 16 to a
parent until one node, the group's subroot, is left; the subroots, ordered by group, are folded alike to the
root.  A parent keeps a copy of its running hash state before every child slot.  To fold a changed child, the
matching state is resumed with the new digest and the siblings to its right only; what stands to the left is
never hashed again.

On Spark: rows are numbered within their group after one range partitioning (a hot group is split over tasks
by its order key), then solved in blocks of 256 nodes, two tree levels at a time, on the way up.  On the way
down a block gets the path above it (one row) and hands every child its own path, so no task ever holds more
than a block and a path, whatever the size of a group.  Node tables are written to the shared folder.

Defined results: a null field is coded ``-``, an empty one ``0:``; rows of one order key are ordered by their
leaf, and equal rows are separate leaves; rows without order key come first; the group without name comes
first; an empty table has no nodes and gives no rows; columns other than the named ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import BROADCAST_ROWS, discard, stored

FAN = 16
BLOCK = FAN * FAN
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def coded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[coded(v) for v in values]).cast("binary"), 256)


class Parent:
    """A node over ``children`` (hex digests): its digest, and the hash state before each child slot."""

    def __init__(self, children: Sequence[str]):
        self.joined = "".join(children).encode()
        self.before = []
        state = hashlib.sha256()
        for at in range(0, len(self.joined), HEX):
            self.before.append(state.copy())
            state.update(self.joined[at:at + HEX])
        self.digest = state.hexdigest()

    def fold(self, slot: int, child: str) -> str:
        """The digest with another child in a slot: the state before it, the child, the right siblings."""
        state = self.before[slot].copy()
        state.update(child.encode())
        state.update(self.joined[(slot + 1) * HEX:])
        return state.hexdigest()

    def siblings(self, slot: int) -> bytes:
        return self.joined[:slot * HEX] + self.joined[(slot + 1) * HEX:]


class Step:
    """A parent seen from one of its children: the state before that slot, and the siblings."""

    def __init__(self, slot: int, siblings: str):
        self.siblings = siblings.encode()
        self.right = self.siblings[slot * HEX:]
        self.before = hashlib.sha256(self.siblings[:slot * HEX])

    def fold(self, child: str) -> str:
        state = self.before.copy()
        state.update(child.encode())
        state.update(self.right)
        return state.hexdigest()


def subtree(digests: list[str], n: int) -> list[list[Parent]]:
    """The parents over a block of nodes, level by level: two levels, one if the group has at most 16 nodes,
    none if it has one."""
    floors = []
    for _ in range(0 if n <= 1 else 1 if n <= FAN else 2):
        parents = [Parent(digests[i:i + FAN]) for i in range(0, len(digests), FAN)]
        floors.append(parents)
        digests = [p.digest for p in parents]
    return floors


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (grp, block) at a time, from rows sorted by it."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["grp"], row["block"]) != (rows[0]["grp"], rows[0]["block"]):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)],
                                             schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)],
                                         schema=schema)


_NODE = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_NODE_DDL = "grp string, pos long, n long, digest string"
_PATH = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("slots", pa.list_(pa.int32())), ("siblings", pa.list_(pa.string()))])
_PATH_DDL = "grp string, pos long, slots array<int>, siblings array<string>"


def _raise_nodes(batches):
    """Blocks of nodes to the nodes above them."""
    def rows():
        for block in _blocks(batches):
            floors = subtree([r["digest"] for r in block], block[0]["n"])
            yield block[0]["grp"], block[0]["block"], -(-block[0]["n"] // BLOCK), floors[-1][0].digest

    return _batched(rows(), _NODE)


def _local_path(floors: list[list[Parent]], i: int) -> tuple[list[int], list[bytes]]:
    """Slot and siblings of node i of a block at each of its levels."""
    slots, siblings = [], []
    for parents in floors:
        slots.append(i % FAN)
        siblings.append(parents[i // FAN].siblings(i % FAN))
        i //= FAN
    return slots, siblings


def _lower_paths(batches):
    """The path above a block (its first row) handed to each of its nodes."""
    def rows():
        for path, *nodes in _blocks(batches):
            floors = subtree([r["digest"] for r in nodes], nodes[0]["n"]) if nodes else []
            for i, node in enumerate(nodes):
                slots, siblings = _local_path(floors, i)
                yield node["grp"], node["pos"], slots + path["slots"], [s.decode() for s in siblings] + path["siblings"]

    return _batched(rows(), _PATH)


@dataclass
class Climb:
    """Node tables from the leaves up, written to the shared folder; the largest group has ``most`` leaves."""

    levels: list[DataFrame]
    most: int

    def roots(self) -> DataFrame:
        """(grp, digest): the single node left of each group."""
        out = self.levels[0].where("n = 1")
        for nodes in self.levels[1:]:
            out = out.unionByName(nodes.where("n = 1"), allowMissingColumns=True)
        return out.select("grp", "digest")

    def discard_nodes(self) -> None:
        discard(*self.levels[1:])


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("block", F.expr(f"pos div {BLOCK}"))


def number(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with their place ``pos`` in their group (from 0, in the given order) and its size ``n``.

    One range partitioning by group and order; a row's number in its partition then becomes its place by the
    offset of the (group, partition) piece, of which there are as many as groups and partitions together.
    The last column of ``order`` should tell equal rows apart, so that copies can be dealt over tasks."""
    piece, within = F.shiftright("at", 33), F.col("at")
    table = stored(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                   .withColumn("at", F.monotonically_increasing_id()))
    pieces = table.groupBy("grp", piece.alias("piece")).agg(F.min(within).alias("first"), F.count(F.lit(1)).alias("rows"))
    inside = Window.partitionBy("grp")
    pieces = stored(pieces.select(
        "grp", "piece", F.sum("rows").over(inside).alias("n"),
        (F.sum("rows").over(inside.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))).alias("before"), "first"))
    shift = pieces.select("grp", "piece", "n", (F.coalesce("before", F.lit(0)) - F.col("first")).alias("shift"))
    few = pieces.count() <= BROADCAST_ROWS
    out = table.withColumn("piece", piece).join(F.broadcast(shift) if few else shift, ["grp", "piece"])
    out = stored(out.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "piece", "shift"))
    discard(table, pieces)
    return out


def climb(leaves: DataFrame) -> Climb:
    """All nodes above numbered leaves (grp, pos, n, digest)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, n = [leaves], most
    while n > 1:
        below = levels[-1].where("n > 1").select("grp", "pos", "n", "digest")
        levels.append(stored(_dealt(below).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
                             .mapInArrow(_raise_nodes, _NODE_DDL)))
        n = -(-n // BLOCK)
    return Climb(levels, most)


def _with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Each block's nodes after the row with the path above it, block by block."""
    above = paths.withColumnRenamed("pos", "block").withColumn("pos", F.lit(-1).cast("long"))
    both = _dealt(nodes).unionByName(above, allowMissingColumns=True)
    return both.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def _block_paths(tree: Climb, ends: DataFrame) -> DataFrame:
    """The paths (grp, pos of the block, ...) above the lowest level's blocks.  ``ends`` has the paths above
    the groups' roots, with the number of their leaves: (grp, leaves, slots, siblings, ...)."""
    height = len(tree.levels)
    out: list[DataFrame | None] = [None] * height
    for s in range(height - 1, -1, -1):
        low, high = (1 if s == 0 else BLOCK ** s + 1), BLOCK ** (s + 1)  # groups whose root is one step above level s
        own = ends.where(F.col("leaves").between(low, high)).withColumn("pos", F.lit(0).cast("long")).drop("leaves")
        if s + 1 < height:
            nodes = tree.levels[s + 1].where("n > 1").select("grp", "pos", "n", "digest")
            handed = _with_paths(nodes, out[s + 1].select("grp", "pos", "slots", "siblings")).mapInArrow(_lower_paths, _PATH_DDL)
            own = own.unionByName(handed, allowMissingColumns=True)
        out[s] = stored(own.select("grp", "pos", "slots", "siblings"))
    discard(*out[1:])
    return out[0]


_PROOF_DDL = ("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
              "slots array<int>, siblings array<string>")


def _prove(payload: list[tuple[str, pa.DataType]], top_levels: int, with_paths: bool):
    """Per leaf: the digest of its proof, and the root refolded from its replacement."""
    fields = [*payload, *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())]
    if with_paths:
        fields += [("slots", pa.list_(pa.int32())), ("siblings", pa.list_(pa.string()))]
    schema, names = pa.schema(fields), [name for name, _ in payload]

    def rows(batches):
        for path, *leaves in _blocks(batches):
            if not leaves:
                continue
            floors = subtree([r["digest"] for r in leaves], leaves[0]["n"])
            steps = [Step(slot, sib) for slot, sib in zip(path["slots"], path["siblings"], strict=True)]
            above = b"".join(s.siblings for s in steps)
            inside = len(steps) - top_levels  # steps above the block that lie in the group's own tree
            digest = floors[-1][0].digest if floors else leaves[0]["digest"]
            subroot = digest if inside == 0 else None
            for k, step in enumerate(steps):
                digest = step.fold(digest)
                if k + 1 == inside:
                    subroot = digest
            root = digest
            for i, row in enumerate(leaves):
                slots, siblings = _local_path(floors, i)
                folded, at = row["replacement"], i
                for parents in floors:
                    folded = parents[at // FAN].fold(at % FAN, folded)
                    at //= FAN
                for step in steps:
                    folded = step.fold(folded)
                proof = hashlib.sha256(b"".join(siblings) + above).hexdigest()
                out = (*[row[name] for name in names], row["digest"], subroot, root, proof, folded, folded == root)
                if with_paths:
                    out += (slots + path["slots"], [s.decode() for s in siblings] + path["siblings"])
                yield out

    return lambda batches: _batched(rows(batches), schema)


def depth(n: int) -> int:
    """Tree levels above n nodes."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def leaves_of(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Numbered leaves: (grp, pos, n, digest, replacement, doc_id, source).

    ``replacement`` is the leaf after tampering (the text's A-Z lower-cased) where ``tampered`` holds."""
    values = {name: F.col(name) for name in FIELDS}
    leaf = leaf_digest(list(values.values()))
    changed = leaf_digest([*list(values.values())[:-1], F.translate(values["text"], UPPER, LOWER)])
    hit = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    rows = documents.select(coded(F.col("source")).alias("grp"), "source", "doc_id", leaf.alias("digest"),
                            F.when(hit, changed).alias("changed"), F.monotonically_increasing_id().alias("copy"))
    written = stored(rows)
    out = number(written, "source", ["doc_id", "digest", "copy"])
    discard(written)
    return out.withColumn("replacement", F.coalesce("changed", "digest")).drop("changed", "copy")


def manifest(documents: DataFrame, tampered: Column | None = None, with_paths: bool = False) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and on request the proof
    itself (slot and joined siblings at each level, from the leaf up)."""
    leaves = leaves_of(documents, tampered)
    tree = climb(leaves)
    kind = dict(documents.select("doc_id").dtypes)["doc_id"]
    if tree.most == 0:
        extra = ", slots array<int>, siblings array<string>" if with_paths else ""
        return documents.sparkSession.createDataFrame([], f"doc_id {kind}, " + _PROOF_DDL.split(", slots")[0] + extra)
    groups = tree.levels[0].where("pos = 0").select("grp", "source", F.col("n").alias("leaves"))
    subroots = tree.roots().join(groups, "grp")
    top_rows = number(subroots.select(F.lit("").alias("grp"), "source", F.col("grp").alias("member"), "leaves", "digest"),
                      "grp", ["source"])
    top = climb(top_rows)
    ends = documents.sparkSession.createDataFrame([("", top.most, [], [])], "grp string, leaves long, slots array<int>, siblings array<string>")
    first = _block_paths(top, ends)
    handed = _with_paths(top_rows.select("grp", "pos", "n", "digest"), first).mapInArrow(_lower_paths, _PATH_DDL)
    ends = handed.select("pos", "slots", "siblings").join(top_rows.select("pos", "member", "leaves"), "pos") \
        .select(F.col("member").alias("grp"), "leaves", "slots", "siblings")
    ends = stored(ends)
    discard(first, top_rows)
    paths = _block_paths(tree, ends)
    top.discard_nodes()
    tree.discard_nodes()
    discard(ends)
    schema = f"doc_id {kind}, " + (_PROOF_DDL if with_paths else _PROOF_DDL.split(", slots")[0])
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    prove = _prove([("doc_id", arrow)], depth(top.most), with_paths)
    nodes = leaves.select("grp", "pos", "n", "digest", "replacement", "doc_id")
    return _with_paths(nodes, paths).mapInArrow(prove, schema)
