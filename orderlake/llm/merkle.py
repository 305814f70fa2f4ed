"""Merkle dataset manifest with octopus multiproofs.

Every row is a leaf, every source a tree of its leaves in id order, and the roots of the sources
are the leaves of one more tree. Each run of three neighbours becomes the hash of their digests.

Leaves are held in partitions of ``SPAN`` neighbours of one tree. To prove many leaves at once, a
partition walks up from the leaves it holds (the octopus): at each level it notes the siblings that it
can neither know nor derive, and goes on with the parents. What it noted is the smallest set of
nodes it lacks; these are fetched by one join. Then it derives the shared interior nodes once, and
gives each of its leaves the siblings on its own way to the root.

Trees are built the same way: a partition hashes the levels that lie within it, and only its top
node goes on to the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, pieces, stored
from orderlake.operators.ranking import with_rank

# Fixed value of the contract: children of a node.
ARITY = 3

_LEVELS = 7
SPAN = ARITY**_LEVELS
TOP_TREE = -1
_NODES = "tree long, level int, place long, digest string"


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def field(column: Column) -> Column:
    """A value with its length in bytes, so that no two rows give one text; ``-`` for null."""
    text = column.cast("string")
    return F.when(
        column.isNotNull(), F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    ).otherwise(F.lit("-"))


def row_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def height(size: int) -> int:
    """Levels above the leaves of a tree with ``size`` of them."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def width(size: int, level: int) -> int:
    """Nodes of a level of a tree with ``size`` leaves."""
    for _ in range(level):
        size = -(-size // ARITY)
    return size


def missing(places: set[int], size: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes needed to reach the root from ``places``, as few as can be.

    ``places`` are leaves of a tree of ``size``. Siblings that are given or follow from what is
    given are not needed.
    """
    needed = []
    for level in range(height(size)):
        n = width(size, level)
        parents = {p // ARITY for p in places}
        for parent in sorted(parents):
            for p in range(ARITY * parent, min(n, ARITY * parent + ARITY)):
                if p not in places:
                    needed.append((level, p))
        places = parents
    return needed


def _rise(known: dict[int, str], level: int, size: int, fetched: dict) -> dict[int, str]:
    """The parents of the known nodes of a level, which must be whole runs or fetched."""
    n = width(size, level)
    return {
        parent: digest(
            "".join(
                known[p] if p in known else fetched[level, p]
                for p in range(ARITY * parent, min(n, ARITY * parent + ARITY))
            )
        )
        for parent in sorted({p // ARITY for p in known})
    }


def _partitions(leaves: DataFrame, *kept: str) -> DataFrame:
    """(tree, size, part, leaves): a row for each ``SPAN`` neighbours of a tree.

    ``leaves`` is a list of structs (place, digest and the ``kept`` columns), at most ``SPAN`` long.
    """
    return (
        leaves.withColumn("part", F.expr(f"place div {SPAN}"))
        .groupBy("tree", "size", "part")
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", *kept))).alias("leaves"))
    )


def _levels(parts: DataFrame, base: int) -> DataFrame:
    """The nodes above the digests of each partition, up to where the partition ends.

    ``size`` counts the nodes of level ``base`` of the tree.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            out: list[tuple] = []
            for row in batch.to_pylist():
                known = {leaf["place"]: leaf["digest"] for leaf in row["leaves"]}
                size = row["size"]
                for level in range(min(_LEVELS, height(size))):
                    known = _rise(known, level, size, {})
                    out += [(row["tree"], base + level + 1, p, d) for p, d in known.items()]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("tree", "level", "place", "digest"), x)) for x in out],
                pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("place", pa.int64()),
                           ("digest", pa.string())]),
            )

    return parts.mapInArrow(run, _NODES)


def tree_nodes(leaves: DataFrame) -> DataFrame:
    """All nodes (tree, level, place, digest) of the trees of ``leaves`` (tree, size, place, digest).

    Each round hashes ``_LEVELS`` levels; only the trees that are higher go into the next one, with
    one node per partition.
    """
    nodes = [leaves.select("tree", F.lit(0).alias("level"), "place", "digest")]
    tops, base = leaves, 0
    while True:
        above = stored(_levels(_partitions(tops), base), "tree_nodes")
        nodes.append(above)
        base += _LEVELS
        sizes = tops.select("tree", F.expr(f"(size + {SPAN - 1}) div {SPAN}").alias("size"))
        tops = above.filter(F.col("level") == base).join(
            sizes.filter("size > 1").distinct(), "tree"
        )
        tops = tops.select("tree", "size", "place", "digest")
        if tops.isEmpty():
            break
    found = nodes[0]
    for more in nodes[1:]:
        found = found.unionByName(more)
    return found


@dataclass(frozen=True)
class Manifest:
    """Stored trees of a dataset.

    ``leaves`` has a row per document (tree, size, place, digest and kept columns), ``nodes`` every
    node of every tree, ``sources`` a row per source: its tree, size and subroot. Tree ``TOP_TREE``
    has the subroots as leaves; ``root`` is its top, None without rows.
    """

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    root: str | None


def manifest(rows: DataFrame, keep: list[str]) -> Manifest:
    """The manifest of rows (source, doc_id, digest and the ``keep`` columns).

    Within a source leaves ascend by id, null ids first, ties by digest; sources ascend by name,
    null first. Places come from one sort that spreads a large source over all tasks.
    """
    order = [F.asc_nulls_first("doc_id"), F.asc("digest")]
    ranked = stored(
        with_rank(rows, order, ["source"], rank="_rank", group_size="_size"), "ranked_leaves"
    )
    sources = ranked.groupBy("source").agg(F.max("_size").alias("size"))
    numbered = stored(
        with_rank(sources, [F.asc_nulls_first("source")], rank="_rank", group_size="_total").select(
            F.col("source").alias("known_source"),
            (F.col("_rank") - 1).alias("tree"),
            "_total",
        ),
        "sources",
    )
    leaves = ranked.join(numbered, F.col("source").eqNullSafe(F.col("known_source"))).select(
        "tree",
        F.col("_size").alias("size"),
        (F.col("_rank") - 1).alias("place"),
        "digest",
        *keep,
    )
    leaves = stored(leaves, "leaves")
    below = tree_nodes(leaves.select("tree", "size", "place", "digest"))
    sizes = leaves.select("tree", "size").distinct()
    # the top of a tree is its highest node, a lone leaf included
    tops = below.groupBy("tree").agg(F.max_by("digest", "level").alias("subroot"))
    subroots = stored(
        numbered.join(sizes, "tree").join(tops, "tree").select(
            "tree", F.col("known_source").alias("source"), "size", "subroot", "_total"
        ),
        "subroots",
    )
    top_leaves = subroots.select(
        F.lit(TOP_TREE).cast("long").alias("tree"),
        F.col("_total").alias("size"),
        F.col("tree").alias("place"),
        F.col("subroot").alias("digest"),
    )
    above = tree_nodes(top_leaves)
    root = above.agg(F.max_by("digest", "level")).first()[0]
    return Manifest(
        leaves,
        below.unionByName(above),
        subroots.withColumnRenamed("_total", "n_sources"),
        root,
    )


def _missing_nodes(parts: DataFrame) -> DataFrame:
    """(owner, part, tree, level, place): the nodes each partition lacks, in its tree and on top.

    ``owner`` and ``part`` name the partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = missing(set(row["places"]), row["size"])
                top = missing({row["tree"]}, row["n_sources"])
                for tree, found in ((row["tree"], own), (TOP_TREE, top)):
                    out += [(row["tree"], row["part"], tree, *f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[i] for x in out], pa.int32() if i == 3 else pa.int64())
                    for i in range(5)
                ],
                ["owner", "part", "tree", "level", "place"],
            )

    return parts.select(
        "tree", "part", "size", "n_sources", F.col("leaves.place").alias("places")
    ).mapInArrow(run, "owner long, part long, tree long, level int, place long")


class _Tree:
    """What one partition knows of a tree: its own nodes and those fetched."""

    def __init__(self, known: dict[int, str], size: int, fetched: dict[tuple[int, int], str]):
        self.size, self.height = size, height(size)
        self.levels = [known]
        self.widths = [width(size, level) for level in range(self.height + 1)]
        self.fetched = fetched
        for level in range(self.height):
            self.levels.append(_rise(self.levels[-1], level, size, fetched))
        self._above: dict[tuple[int, int], list[str]] = {}

    def node(self, level: int, place: int) -> str:
        own = self.levels[level].get(place)
        return own if own is not None else self.fetched[level, place]

    def run(self, level: int, place: int) -> range:
        first = place // ARITY * ARITY
        return range(first, min(self.widths[level], first + ARITY))

    def siblings(self, level: int, place: int) -> list[str]:
        """Those of the node and of its ancestors, from below; ancestors' ones are made once."""
        if level == self.height:
            return []
        parent = (level + 1, place // ARITY)
        if parent not in self._above:
            self._above[parent] = self.siblings(*parent)
        own = [self.node(level, p) for p in self.run(level, place) if p != place]
        return own + self._above[parent]

    def fold(self, place: int, leaf: str) -> str:
        """The root that follows from another leaf and the original siblings."""
        for level in range(self.height):
            leaf = digest(
                "".join(
                    leaf if p == place else self.node(level, p) for p in self.run(level, place)
                )
            )
            place //= ARITY
        return leaf


def multiproofs(found: Manifest, claims: DataFrame, *, with_proof: bool = False) -> DataFrame:
    """Proofs of ``claims`` (tree, size, place, digest, claimed, doc_id), leaves of the manifest.

    Returns a row per claim: doc_id, leaf, subroot, proof_sha256, folded_root, and with
    ``with_proof`` also ``proof``, the siblings' digests from the leaf to the root. ``claimed`` is the
    digest that the owner of the leaf says it has; ``folded_root`` follows from it and the proof.
    """
    heads = found.sources.select("tree", "n_sources", "subroot")
    parts = _partitions(claims, "claimed", "doc_id").join(heads, "tree")
    parts = stored(parts, "leaf_partitions")
    lacking = _missing_nodes(parts)
    fetched = (
        lacking.join(found.nodes, ["tree", "level", "place"])
        .groupBy(F.col("owner").alias("tree"), "part")
        .agg(
            F.collect_list(
                F.struct((F.col("tree") == TOP_TREE).alias("top"), "level", "place", "digest")
            ).alias("fetched")
        )
    )
    id_type = claims.schema["doc_id"].dataType.simpleString()
    proof_type = ", proof array<string>" if with_proof else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            id_type = batch.schema.field("leaves").type.value_type.field("doc_id").type
            for row in batch.to_pylist():
                yield _expanded(row, id_type, with_proof)

    return (
        parts.join(fetched, ["tree", "part"], "left")
        .select("tree", "size", "n_sources", "subroot", "leaves", "fetched")
        .mapInArrow(
            run,
            f"doc_id {id_type}, leaf string, subroot string, proof_sha256 string, "
            f"folded_root string{proof_type}",
        )
    )


def _expanded(row: dict, id_type: pa.DataType, with_proof: bool) -> pa.RecordBatch:
    """The proofs of one partition's leaves."""
    lower, upper = (
        {(f["level"], f["place"]): f["digest"] for f in row["fetched"] or [] if f["top"] == top}
        for top in (False, True)
    )
    leaves = row["leaves"]
    tree = _Tree({leaf["place"]: leaf["digest"] for leaf in leaves}, row["size"], lower)
    top = _Tree({row["tree"]: row["subroot"]}, row["n_sources"], upper)
    rest = top.siblings(0, row["tree"])
    hashes, folded, proofs = [], [], []
    for leaf in leaves:
        way = tree.siblings(0, leaf["place"]) + rest
        hashes.append(digest("".join(way)))
        folded.append(top.fold(row["tree"], tree.fold(leaf["place"], leaf["claimed"])))
        if with_proof:
            proofs.append(way)
    columns = [
        pa.array([leaf["doc_id"] for leaf in leaves], id_type),
        pa.array([leaf["digest"] for leaf in leaves], pa.string()),
        pa.array([row["subroot"]] * len(leaves), pa.string()),
        pa.array(hashes, pa.string()),
        pa.array(folded, pa.string()),
    ]
    names = ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"]
    if with_proof:
        columns.append(pa.array(proofs, pa.list_(pa.string())))
        names.append("proof")
    return pa.RecordBatch.from_arrays(columns, names)


def verified_rows(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    n_chars: str = "n_chars",
    text: str = "text",
    *,
    with_proof: bool = False,
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Of the rows whose id has an even checksum the text is taken to have lost its line breaks, so
    their claim folds to another root where it had any. Null fields count as ``-`` and differ from
    empty ones; a null id ranks first in its source and is never tampered with; a null source is a
    source of its own, the first. Equal rows are leaves of their own beside each other. An empty table
    has no root and gives no rows; other columns are ignored.
    """
    rows = narrowed(docs, doc_id=id_column, source=source, lang=lang, n_chars=n_chars, text=text)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    whole = row_digest([*fields, F.col("text")])
    changes = even & F.contains("text", F.lit("\n"))
    lost = row_digest([*fields, F.translate("text", "\n", "")])
    # stored, because a sort reads its input twice and whole texts are read once
    hashed = stored(
        rows.select(
            "doc_id", "source", whole.alias("digest"), F.when(changes, lost).alias("other")
        ).select("doc_id", "source", "digest", F.coalesce("other", "digest").alias("claimed")),
        "hashed_rows",
    )
    found = manifest(hashed, ["doc_id", "claimed"])
    proofs = multiproofs(found, found.leaves, with_proof=with_proof)
    root = F.lit(found.root).cast("string")
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        F.col("folded_root").eqNullSafe(root).alias("verified"),
        *(["proof"] if with_proof else []),
    )
