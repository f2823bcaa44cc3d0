"""Operator 11, Merkle manifest of a dataset, with a proof for each document.

A document is a leaf, a source is a tree of its leaves in ascending doc_id, and the sources' roots are the leaves of one more tree.
Three consecutive nodes become one; a last run has fewer. Trees are cut into aligned blocks of 3 ** LEVELS leaves. In a block, tree
traversal with treehash stacks walks from leaf to leaf: for each level it holds the run of nodes around the present leaf, and one
stack that meanwhile hashes the next run of its level; each leaf pays for one step of every level, spent on the stack with
the lowest open node, so that what all stacks hold grows with the number of levels and not with the leaves. Blocks' roots
are the leaves of further rounds of blocks, and the path of a block in those is what its leaves share: it is appended to theirs.

Rounds are as many as log(leaves) / log(3 ** LEVELS). A task holds a block's digests at a time, whatever the size of a source; blocks
are dealt out apart, so a source with a third of all rows is spread like the others.

Edge cases: null columns are told from empty ones in a leaf; rows without a doc_id come first in their source; rows that are equal
in all columns are equal leaves, in any order; rows with one doc_id and other columns stand in the order of their digests; a null
source is a source, and the first one; a lone leaf is its source's root, and a lone source's root is hashed no more; of an
empty table there are no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, ranks_within, table

#: Levels of a block: 729 leaves.
LEVELS = 6
WIDTH = 3

Run = list[bytes]


def node(children: Run) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


def height(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // WIDTH), levels + 1
    return levels


class Treehash:
    """The nodes of one run, hashed leaf by leaf: of each level below, at most the children of one open node are held."""

    def __init__(self, leaves: Run, level: int, run: int) -> None:
        size = WIDTH ** (level + 1)
        self.leaves, self.at, self.stop, self.level = leaves, run * size, min((run + 1) * size, len(leaves)), level
        self.open: list[Run] = [[] for _ in range(level + 1)]

    @property
    def done(self) -> bool:
        return self.at >= self.stop

    @property
    def lowest(self) -> int:
        return next((k for k, held in enumerate(self.open) if held), self.level)

    def step(self) -> None:
        """Takes one leaf, and closes the nodes that end with it."""
        self.open[0].append(self.leaves[self.at])
        self.at += 1
        for k in range(self.level):
            if self.at % WIDTH ** (k + 1) and self.at < len(self.leaves):
                break
            self.open[k + 1].append(node(self.open[k]))
            self.open[k] = []

    def finish(self) -> Run:
        while not self.done:
            self.step()
        return self.open[self.level]


def first_runs(leaves: Run, levels: int) -> tuple[list[Run], bytes]:
    """The first run of each level, and the block's root."""
    runs = [Treehash(leaves, k, 0).finish() for k in range(levels)]
    return runs, node(runs[-1]) if runs else leaves[0]


def paths(leaves: Run, levels: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """Of each leaf in turn, level by level, what stands left and right of its node in the node's run."""
    runs, _ = first_runs(leaves, levels)
    later = [Treehash(leaves, k, 1) for k in range(levels)]
    for i in range(len(leaves)):
        if i:
            for k in range(levels):
                if i % WIDTH ** (k + 1):
                    break
                runs[k] = later[k].finish()
                later[k] = Treehash(leaves, k, i // WIDTH ** (k + 1) + 1)
        out = []
        for k, run in enumerate(runs):
            own = i // WIDTH**k % WIDTH
            out.append((b"".join(run[:own]), b"".join(run[own + 1 :])))
        yield out
        for _ in range(levels):
            waiting = [stack for stack in later if not stack.done]
            if not waiting:
                break
            min(waiting, key=lambda stack: (stack.lowest, stack.level)).step()


def block_root(leaves: Run, levels: int) -> bytes:
    return Treehash(leaves, levels, 0).finish()[0] if levels else leaves[0]


def fold(own: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in path:
        own = node([left, own, right])
    return own


def _pack(nodes: DataFrame, items: list[str]) -> DataFrame:
    """nodes(key, at, of, node, ...) -> stored blocks (key, block, of, items): items by place, at most 3 ** LEVELS."""
    size = WIDTH**LEVELS
    rows = nodes.groupBy("key", F.floor(F.col("at") / size).cast("long").alias("block"), "of").agg(F.array_sort(F.collect_list(F.struct("at", *items))).alias("items"))
    return materialize(rows, "merkle_blocks")


def _roots(blocks: DataFrame) -> DataFrame:
    """(key, at, of, node): the blocks' roots as nodes of the next round."""
    schema = f"key {blocks.schema['key'].dataType.simpleString()}, at long, of long, node binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ofs = batch.column("of").to_pylist()
            made = [bytes.fromhex(block_root(_leaves(items), min(LEVELS, height(of))).decode()) for items, of in zip(batch.column("items"), ofs, strict=True)]
            more = [-(-of // WIDTH**LEVELS) for of in ofs]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("block"), pa.array(more, pa.int64()), pa.array(made, pa.binary())], ["key", "at", "of", "node"])

    return materialize(blocks.select("key", "block", "of", "items").mapInArrow(run, schema), "merkle_roots")


def _leaves(items: pa.ListScalar) -> Run:
    return [digest.hex().encode() for digest in items.values.field("node").to_pylist()]


PATH = "array<struct<left:binary,right:binary>>"


def _read_path(path: pa.ListScalar) -> list[tuple[bytes, bytes]]:
    return [(p["left"], p["right"]) for p in path.as_py() or []]


def _pass_down(blocks: DataFrame, upper: DataFrame) -> DataFrame:
    """(key, at, path, top): the paths of a round's leaves up to the root; upper has those of its blocks."""
    schema = f"key {blocks.schema['key'].dataType.simpleString()}, at long, path {PATH}, top int"
    kind = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                items, of, top = row.column("items")[0], row.column("of")[0].as_py(), row.column("top")[0].as_py()
                above = _read_path(row.column("path")[0])
                made = [[{"left": a, "right": b} for a, b in own + above] for own in paths(_leaves(items), min(LEVELS, height(of)))]
                keys = pa.array([row.column("key")[0].as_py()] * len(made), row.schema.field("key").type)
                yield pa.RecordBatch.from_arrays([keys, items.values.field("at"), pa.array(made, kind), pa.array([top] * len(made), pa.int32())], ["key", "at", "path", "top"])

    return _with_path(blocks, upper).mapInArrow(run, schema)


def _with_path(blocks: DataFrame, upper: DataFrame) -> DataFrame:
    above = upper.select(F.col("key").alias("k"), F.col("at").alias("block"), "path", "top")
    return blocks.join(above, blocks["key"].eqNullSafe(above["k"]) & (blocks["block"] == above["block"])).select("key", blocks["block"], "of", "items", "path", "top")


def _climb(blocks: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks up to one block for each key, and the roots (key, node)."""
    rounds, ends = [blocks], []
    while True:
        roots = _roots(rounds[-1])
        ends.append(roots.where("of = 1").select("key", "node"))
        if roots.where("of > 1").isEmpty():
            break
        rounds.append(_pack(roots.where("of > 1"), ["node"]))
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return rounds, out


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(key, at, path, top) of the blocks of the first round; tops(key, path, top) above the roots."""
    ended = tops.withColumn("at", F.lit(0).cast("long"))
    upper = ended.select("key", "at", "path", "top")
    for blocks in reversed(rounds[1:]):
        # Keys whose tree ended below this round have no block in it and get their path from the top.
        upper = materialize(_pass_down(blocks, upper).unionByName(ended.join(blocks.select(F.col("key").alias("k")).distinct(), F.col("key").eqNullSafe(F.col("k")), "left_anti").select("key", "at", "path", "top")), "merkle_paths")
    return upper


def leaf(columns: list[Column]) -> Column:
    """A digest of columns in which null, empty and joined values all differ."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def manifest(docs: DataFrame, changed: Column | None = None, changed_text: Column | None = None) -> DataFrame:
    """docs(doc_id, source, lang, n_chars, text) -> (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    folded_root follows a document's path from the leaf of changed_text where ``changed`` holds, and from its own elsewhere.
    """
    changed = F.lit(False) if changed is None else F.coalesce(changed, F.lit(False))
    columns = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    other = F.when(changed, leaf(columns(F.col("text") if changed_text is None else changed_text)))
    leaves = docs.select("doc_id", F.col("source").alias("key"), F.unhex(leaf(columns(F.col("text")))).alias("node"), F.unhex(other).alias("other"))
    placed = ranks_within(leaves, "key", ["doc_id", "node"], "merkle_leaves").withColumnsRenamed({"_rank": "at", "_of": "of"})
    rounds, sources = _climb(_pack(placed, ["doc_id", "node", "other"]))

    # The tree of the sources' roots, itself in blocks.
    ranked = ranks_within(sources.select(F.lit(0).alias("one"), F.col("key").alias("source"), "node"), "one", ["source"], "merkle_sources")
    top = ranked.select(F.lit(0).alias("key"), F.col("_rank").alias("at"), F.col("_of").alias("of"), "node", "source")
    top_rounds, ends = _climb(_pack(top, ["node"]))
    ended = ends.select("key", F.array().cast(PATH).alias("path"), F.lit(0).alias("top"))
    places = materialize(_pass_down(top_rounds[0], _descend(top_rounds, ended)), "merkle_tops")
    tops = top.select(F.col("source").alias("key"), "at").join(places.select("at", "path"), "at").select("key", "path", F.size("path").alias("top"))
    return _prove(_with_path(rounds[0], _descend(rounds, tops)))


def _prove(blocks: DataFrame) -> DataFrame:
    items = blocks.schema["items"].dataType.elementType
    schema = f"doc_id {items['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                held, of, top = row.column("items")[0], row.column("of")[0].as_py(), row.column("top")[0].as_py()
                above, leaves, levels = _read_path(row.column("path")[0]), _leaves(held), min(LEVELS, height(of))
                others = held.values.field("other").to_pylist()
                shared = len(above) - top
                subroot = fold(block_root(leaves, levels), above[:shared])
                root, proofs, folded = fold(subroot, above[shared:]), [], []
                for own, other, path in zip(leaves, others, paths(leaves, levels), strict=True):
                    whole = path + above
                    proofs.append(node([side for level in whole for side in level]).decode())
                    folded.append(fold(own if other is None else other.hex().encode(), whole).decode())
                n = len(leaves)
                made = [[x.decode() for x in leaves], [subroot.decode()] * n, [root.decode()] * n, proofs, folded]
                yield pa.RecordBatch.from_arrays([held.values.field("doc_id"), *[pa.array(m, pa.string()) for m in made]], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return blocks.mapInArrow(run, schema).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document by the checksum of its id loses its line feeds before its path is followed."""
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))


#: The trees level by level in a recursive table, a sibling list a document and level, and CRC-32 bit by bit.
ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, lang, n_chars, text, replace(text, chr(10), '') AS cut,
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
      lambda crc, b: list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)), 4294967295), 4294967295) % 2 = 0 AS changed
  FROM documents),
parts AS (
  SELECT *, concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head FROM docs),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN changed THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS tried FROM parts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
up AS (
  SELECT source, 0 AS level, pos AS i, leaf AS h, n AS nodes FROM placed
  UNION ALL SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (nodes + 2) // 3 FROM up WHERE nodes > 1 GROUP BY source, level, i // 3, nodes),
subs AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE nodes = 1),
top AS (
  SELECT 0 AS level, pos AS i, subroot AS h, n AS nodes FROM subs
  UNION ALL SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (nodes + 2) // 3 FROM top WHERE nodes > 1 GROUP BY level, i // 3, nodes),
runs AS (SELECT source, level, i // 3 AS run, list(h ORDER BY i) AS hs FROM up WHERE nodes > 1 GROUP BY source, level, i // 3),
top_runs AS (SELECT level, i // 3 AS run, list(h ORDER BY i) AS hs FROM top WHERE nodes > 1 GROUP BY level, i // 3),
steps AS (
  SELECT p.source, p.pos, 0 AS part, r.level, p.pos // CAST(pow(3, r.level) AS BIGINT) % 3 AS own, r.hs
  FROM placed p JOIN runs r ON r.source IS NOT DISTINCT FROM p.source AND r.run = p.pos // CAST(pow(3, r.level + 1) AS BIGINT)
  UNION ALL SELECT p.source, p.pos, 1, r.level, s.pos // CAST(pow(3, r.level) AS BIGINT) % 3, r.hs
  FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source JOIN top_runs r ON r.run = s.pos // CAST(pow(3, r.level + 1) AS BIGINT)),
sides AS (
  SELECT source, pos, list({'l': array_to_string(hs[1:own], ''), 'r': array_to_string(hs[own + 2:], '')} ORDER BY part, level) AS path FROM steps GROUP BY source, pos),
folded AS (
  SELECT p.doc_id, p.leaf, p.source, sha256(array_to_string(list_transform(coalesce(path, []), lambda s: s.l || s.r), '')) AS proof_sha256,
    list_reduce(coalesce(path, []), lambda h, s: sha256(s.l || h || s.r), p.tried) AS folded_root
  FROM placed p LEFT JOIN sides s ON s.source IS NOT DISTINCT FROM p.source AND s.pos = p.pos)
SELECT f.doc_id, f.leaf, s.subroot, t.h AS root, f.proof_sha256, f.folded_root, f.folded_root = t.h AS verified
FROM folded f JOIN subs s ON s.source IS NOT DISTINCT FROM f.source JOIN top t ON t.nodes = 1"""
