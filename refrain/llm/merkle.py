"""Merkle manifest of a dataset: a root for the table, and for every row the siblings that prove it.

Rows are leaves in the order of their key; each group (a source) is a tree of arity three, and the
groups' roots are the leaves of the tree of the dataset.

``Witnesses`` appends nodes in order and keeps the open subtrees, at most two on a level. When a
run of siblings is complete, each of them gets the others as the next step of its witness, which
all leaves below share, and their parent is appended one level up. Leaves are cut into aligned
blocks of ``3 ** HEIGHT``, one block at a time in a task; a block's root is then appended as a leaf
of the next round, so a tree of n leaves takes log(n) / log(3 ** HEIGHT) rounds, and no task sees more than
a block. Digests are stored, not the rows, and every round is read from the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.functions.ordering import number_rows
from refrain.session import cut_lineage, remove_path, scratch_path
from refrain.sources.tables import read_table

ARITY = 3
HEIGHT = 5  # of a block: 243 leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
WITNESS = "array<struct<before:binary,after:binary>>"
_STEP = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """sha256 (hex) of the values in order, each as byte count, colon and value, or ``-`` for null."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _joined(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class Node:
    """A subtree: its digest, and once its run is complete its siblings on both sides and its parent."""

    __slots__ = ("digest", "before", "after", "above")

    def __init__(self, digest: bytes) -> None:
        self.digest, self.before, self.after, self.above = digest, b"", b"", None

    def witness(self) -> Iterator[tuple[bytes, bytes]]:
        """Siblings before and behind, level by level, as far as the tree is closed."""
        node = self
        while node.above is not None:
            yield node.before, node.after
            node = node.above


class Witnesses:
    """Appends nodes to a tree and extends the witnesses of the subtrees that they complete."""

    def __init__(self, arity: int = ARITY) -> None:
        self.arity, self.open = arity, [[]]

    def append(self, digest: bytes) -> Node:
        node = Node(digest)
        self._add(0, node)
        return node

    def _add(self, level: int, node: Node) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, digests = self.open[level], [n.digest for n in self.open[level]]
        parent = Node(_joined(digests))
        for i, node in enumerate(run):
            node.before, node.after, node.above = b"".join(digests[:i]), b"".join(digests[i + 1 :]), parent
        self.open[level] = []
        self._add(level + 1, parent)

    def close(self, height: int | None = None) -> Node:
        """Complete the open runs up to ``height``, or until a single node is left, and return that."""
        level = 0
        while True:
            run, above = self.open[level], any(self.open[level + 1 :])
            if level == height or (height is None and len(run) == 1 and not above):
                return run[0]
            if run:
                self._complete(level)
            level += 1


def _steps(witness: Iterator[tuple[bytes, bytes]]) -> list[dict]:
    return [{"before": b, "after": a} for b, a in witness]


def _filled(digests: Sequence[bytes], size: int, height: int) -> tuple[list[Node], Node]:
    """The leaves and the root of one block of a tree of ``size`` leaves."""
    block = Witnesses()
    leaves = [block.append(d) for d in digests]
    return leaves, block.close(None if size <= ARITY**height else height)


def _pack(nodes: DataFrame, height: int, label: str) -> tuple[DataFrame, str]:
    """One row for each block of (tree, pos, size, key, digest, claimed), written in the shared folder."""
    spark = nodes.sparkSession
    width = ARITY**height
    dealt = nodes.withColumn("block", F.floor(F.col("pos") / width).cast("bigint"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["tree", "block", "size", "key", "digest", "claimed"]
    dealt = dealt.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", "pos").select(*columns)
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.binary()]

    def row(now: tuple, keys: list, digests: list, claims: list) -> pa.RecordBatch:
        tree, block, size = now
        _, root = _filled(digests, size, height)
        values = [tree, block, size, keys, digests, claims, root.digest]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["tree", "block", "size", "keys", "digests", "claims", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, digests, claims = None, [], [], []
        for batch in batches:
            for tree, block, size, key, digest, claimed in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (tree, block, size) != now:
                    if digests:
                        yield row(now, keys, digests, claims)
                    now, keys, digests, claims = (tree, block, size), [], [], []
                keys.append(key)
                digests.append(digest)
                claims.append(claimed)
        if digests:
            yield row(now, keys, digests, claims)

    schema = "tree string, block bigint, size bigint, keys array<bigint>, digests array<binary>, claims array<binary>, root binary"
    path = scratch_path(spark, label)
    dealt.mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path), path


def _unpack(blocks: DataFrame, height: int) -> DataFrame:
    """(tree, block, pos, key, digest, claimed, witness) of every node, its witness up to the block's root."""
    names = ["tree", "block", "pos", "key", "digest", "claimed", "witness"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), _STEP]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, block, size, keys, digests, claims = (batch.column(c)[i].as_py() for c in range(6))
                leaves, _ = _filled(digests, size, height)
                n, first = len(leaves), block * ARITY**height
                values = [[tree] * n, [block] * n, range(first, first + n), keys, digests, claims, [_steps(x.witness()) for x in leaves]]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    schema = f"tree string, block bigint, pos bigint, key bigint, digest binary, claimed binary, witness {WITNESS}"
    return blocks.select("tree", "block", "size", "keys", "digests", "claims").mapInArrow(run, schema)


def grow(nodes: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, list[str]]:
    """(tree, key, digest, claimed, witness, subroot) of (tree, pos, size, key, digest, claimed).

    ``pos`` numbers the ``size`` nodes of a tree from 0. Also returns the folders that the result
    reads, for the caller to remove.
    """
    leaves, path = _pack(nodes, height, "merkle-leaves")
    paths, width = [path], ARITY**height
    rounds: list[DataFrame] = []
    roots = leaves.select("tree", F.col("block").alias("pos"), F.ceil(F.col("size") / width).cast("bigint").alias("size"), F.col("root").alias("digest"))
    while (roots.agg(F.max("size")).first()[0] or 0) > 1:  # one number
        further, path = _pack(roots.select("*", F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("binary").alias("claimed")), height, "merkle-blocks")
        paths.append(path)
        rounds.append(_unpack(further, height).select("tree", "pos", F.col("block").alias("__up"), F.col("witness").alias("__more")))
        roots = further.select("tree", F.col("block").alias("pos"), F.ceil(F.col("size") / width).cast("bigint").alias("size"), F.col("root").alias("digest"))
    # witnesses of the blocks, from the last round down
    done = roots.select("tree", "pos", F.col("digest").alias("subroot"), F.array().cast(WITNESS).alias("rest"))
    for part in reversed(rounds):
        upper = done.select(F.col("tree").alias("__tree"), F.col("pos").alias("__pos"), "subroot", "rest")
        joined = part.join(upper, F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("__up") == F.col("__pos")))
        done = joined.select("tree", "pos", "subroot", F.concat("__more", "rest").alias("rest"))
    upper = done.select(F.col("tree").alias("__tree"), F.col("pos").alias("__pos"), "subroot", "rest")
    own = _unpack(leaves, height)
    joined = own.join(upper, F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("block") == F.col("__pos")))
    return joined.select("tree", "key", "digest", "claimed", F.concat("witness", "rest").alias("witness"), "subroot"), paths


def manifest(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(source, doc_id, leaf, claimed, witness, subroot, root) for every row of ``leaves``.

    ``leaves`` has doc_id, source, leaf and, where another copy of the data is to be verified, claimed
    (both in hex; claimed is returned as it came). A source's leaves are in the order of doc_id, nulls
    first; rows that share a doc_id are in the order of their digests. Sources are in the order
    of their bytes, null first. ``witness`` lists the siblings before and behind, level by level up
    to the root. An empty table gives no rows. Only the number of rounds and a count reach the driver.
    """
    spark = leaves.sparkSession
    claimed = F.unhex("claimed") if "claimed" in leaves.columns else F.lit(None).cast("binary")
    narrow = leaves.select(F.col("source").alias("tree"), F.col("doc_id").cast("bigint").alias("key"), F.unhex("leaf").alias("digest"), claimed.alias("claimed"))
    placed = number_rows(narrow, ["key", "digest"], ["tree"], index="pos", size="size")
    rows, paths = grow(placed.withColumn("pos", F.col("pos") - 1), height)
    rows_path = scratch_path(spark, "merkle-rows")
    rows.write.parquet(rows_path)
    for path in paths:
        remove_path(spark, path)
    rows = spark.read.schema(rows.schema).parquet(rows_path)
    sources = cut_lineage(rows.groupBy("tree").agg(F.first("subroot").alias("digest")))
    ordered = number_rows(sources, ["tree"], index="pos", size="size")
    tops, paths = grow(ordered.select(F.lit("").alias("tree"), F.col("pos").alias("key"), F.col("pos") - 1, "size", "digest", F.lit(None).cast("binary").alias("claimed")).toDF("tree", "key", "pos", "size", "digest", "claimed"), height)
    named = tops.join(ordered.select(F.col("pos").alias("key"), F.col("tree").alias("__tree")), "key").select("__tree", F.col("witness").alias("__top"), F.col("subroot").alias("root"))
    named = cut_lineage(named)
    for path in paths:
        remove_path(spark, path)
    joined = rows.join(named, F.col("tree").eqNullSafe(F.col("__tree")))
    return joined.select(
        F.col("tree").alias("source"),
        F.col("key").alias("doc_id"),
        _hex("digest").alias("leaf"),
        _hex("claimed").alias("claimed"),
        F.concat("witness", "__top").alias("witness"),
        _hex("subroot").alias("subroot"),
        _hex("root").alias("root"),
    )


def _hex(column: Column | str) -> Column:
    return F.lower(F.hex(column))


def proof_digest(witness: Column) -> Column:
    """sha256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(_hex(s["before"]), _hex(s["after"]))), ""), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its siblings make up."""
    return F.aggregate(witness, leaf, lambda at, s: F.sha2(F.concat(_hex(s["before"]), at, _hex(s["after"])), 256))


def tampered_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Manifest of the documents, verified against a copy that lost the line ends of half of them."""
    docs = read_table(spark, root, "documents")
    id_crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when(id_crc % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    values = [F.col(c) for c in COLUMNS]
    leaves = docs.select("doc_id", "source", leaf_digest(values).alias("leaf"), leaf_digest([*values[:-1], text]).alias("claimed"))
    rows = manifest(leaves).withColumn("folded_root", folded(F.col("claimed"), F.col("witness")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {"op12_merkle": tampered_manifest}


def _leaf_sql(text: str) -> str:
    values = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::varchar || ':' || {v}, '-')" for v in values) + ")"


def _tree_sql(name: str, start: str) -> str:
    """All levels of trees given as lists of digests."""
    return f"""{name} as (
  select tree, 0 as lvl, l from ({start})
  union all
  select tree, lvl + 1, list_transform(range(0, (len(l) + {ARITY - 1}) // {ARITY}), lambda i: sha256(array_to_string(l[{ARITY} * i + 1:{ARITY} * i + {ARITY}], ''))) from {name} where len(l) > 1
)"""


# crc32 by bits: reduce over the bytes, each followed by seven zeros
_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))), lambda v, x: xor(xor(v, x) >> 1, (xor(v, x) & 1) * 3988292384)), 4294967295)"
_RUN = f"l[{ARITY} * (spot // {ARITY}) + 1:spot]", f"l[spot + 2:{ARITY} * (spot // {ARITY}) + {ARITY}]"
_SQL = f"""
with recursive d as (
  select doc_id, source, {_leaf_sql("text")} as leaf, case when {_CRC} % 2 = 0 then {_leaf_sql("replace(text, chr(10), '')")} else {_leaf_sql("text")} end as claimed from documents
), p as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from d
), {_tree_sql("t", "select source as tree, list(leaf order by place) as l from p group by source")}, s as (
  select tree as source, l[1] as subroot, row_number() over (order by tree nulls first) - 1 as spot from t where len(l) = 1
), {_tree_sql("u", "select '' as tree, list(subroot order by spot) as l from s")}, levels as (
  select tree as source, false as top, lvl, max(lvl) over (partition by tree) as height, l from t
  union all select null, true, lvl, max(lvl) over (), l from u
), r as (
  select l[1] as root from u where len(l) = 1
), steps as (
  select doc_id, leaf, place, step.lvl, coalesce(array_to_string({_RUN[0]}, ''), '') as before, coalesce(array_to_string({_RUN[1]}, ''), '') as after
  from (select p.doc_id, p.leaf, p.place, levels.lvl, p.place // ({ARITY} ** levels.lvl)::bigint as spot, l from p join levels on not top and levels.source is not distinct from p.source where len(l) > 1
    union all
    select p.doc_id, p.leaf, p.place, 1000 + levels.lvl, s.spot // ({ARITY} ** levels.lvl)::bigint, l from p join s on s.source is not distinct from p.source join levels on top where len(l) > 1) step
), w as (
  select p.doc_id, p.source, p.leaf, p.claimed, list({{'before': before, 'after': after}} order by lvl) filter (lvl is not null) as steps
  from p left join steps on steps.doc_id is not distinct from p.doc_id and steps.leaf = p.leaf and steps.place = p.place group by p.doc_id, p.source, p.leaf, p.claimed, p.place
), f as (
  select *, coalesce(list_reduce(list_prepend({{'before': claimed, 'after': ''}}, steps), lambda a, x: {{'before': sha256(x.before || a.before || x.after), 'after': ''}}).before, claimed) as folded_root from w
)
select doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(steps, lambda x: x.before || x.after), ''), '')) as proof_sha256, folded_root, folded_root = root as verified
from f join s on s.source is not distinct from f.source cross join r"""

ORACLES: dict[str, str] = {"op12_merkle": _SQL}
