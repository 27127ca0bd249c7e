"""Merkle manifest of a table by slot pivots.

Rows are hashed to leaves; the leaves of a group (in the order of their ids) form
a tree of ``fanout`` children a node, and the roots of the groups, in the order of
their names, form one more tree. A level is one slot pivot: conditional aggregates
spread the children of each parent into ``fanout`` columns, and the hash of these
columns one after another is the parent. On the way back down, the same columns
give every child its siblings: all columns left of its own slot and all right of it.

Scale: the texts are read once and leave the scan as digests. Positions come from
one range partitioning (no window over a group), so a group may hold any share of
the rows. A level holds a sixteenth of the rows of the level below; its keys are
(group, parent), so no key has more than ``fanout`` rows. The way down joins each
parent with its own path (at most one entry a level) and expands it to its children:
rows are never joined with all nodes above them. Every level is a written table.

Edge cases: a null field hashes as ``-``; null and repeated ids come first and side
by side (ordered by leaf then, so repeated rows change nothing); a null group is a
group of its own and the first; a group of one row has its leaf as root, without
siblings; an empty table gives no rows. Long texts are hashed whole. Names of other
columns do not matter, since only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rank import global_row_number
from ..session import broadcast_if_small, write_table
from .common import ascii_lower

PATH = "array<struct<l:string,r:string>>"


@dataclass(frozen=True)
class MerkleConfig:
    fanout: int = 16


def field(c: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else UTF-8 bytes, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts one after another (nulls left out)."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings (nearest level first) give."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["l"], h, s["r"]))


def siblings_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256)


class Tree:
    """Trees over ``nodes`` (gid, pos, n, digest and carried columns): one for each
    ``gid``, whose ``n`` nodes stand at ``pos`` 0 to n - 1."""

    def __init__(self, nodes: DataFrame, cfg: MerkleConfig, name: str):
        self.cfg, self.leaves = cfg, nodes
        self.carried = [c for c in nodes.columns if c not in ("gid", "pos", "n")]
        self.levels: list[DataFrame] = []
        below, most = nodes, nodes.agg(F.max("n")).first()[0] or 0
        while most > 1:
            below = write_table(self._pivot(below, [] if self.levels else self.carried), f"{name}-{len(self.levels) + 1}")
            self.levels.append(below)
            most = -(-most // cfg.fanout)

    def _pivot(self, below: DataFrame, carried: list[str]) -> DataFrame:
        f = self.cfg.fanout
        child = F.struct(*[F.col(c) for c in carried or ["digest"]])
        slot = F.pmod(F.col("pos"), F.lit(f))
        parents = below.where(F.col("n") > 1).groupBy("gid", F.floor(F.col("pos") / f).cast("long").alias("pos")).agg(
            F.max(F.ceil(F.col("n") / f).cast("long")).alias("n"),
            *[F.max(F.when(slot == j, child)).alias(f"c{j}") for j in range(f)])
        return parents.select("*", digest(*[F.col(f"c{j}.digest") for j in range(f)]).alias("digest"))

    def roots(self) -> DataFrame:
        """``gid, digest`` of each tree."""
        tables = [t.where(F.col("n") == 1).select("gid", "digest") for t in [self.leaves, *self.levels]]
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    def paths(self, above: DataFrame, name: str) -> DataFrame:
        """Each leaf with its ``path`` from the leaf up: (l, r) = the siblings left and
        right of it at each level. ``above`` (gid, path and more columns) is the way on
        from each tree's root; its columns are carried to the leaves."""
        f, more = self.cfg.fanout, [c for c in above.columns if c not in ("gid", "path")]
        known = None  # paths of the nodes of the level at hand
        for k in range(len(self.levels), 0, -1):
            level = self.levels[k - 1]
            top = level.where(F.col("n") == 1).select("gid", "pos").join(above, "gid")
            known = top if known is None else known.unionByName(top)
            carried = self.carried if k == 1 else ["digest"]
            parents = level.drop("digest", "n").join(known, ["gid", "pos"])

            slots = F.array(*[F.col(f"c{j}") for j in range(f)])

            def child(c: Column, j: Column) -> Column:
                digests = F.transform(slots, lambda x: x["digest"])  # array_join leaves out empty slots
                left, right = F.array_join(F.slice(digests, F.lit(1), j), ""), F.array_join(F.slice(digests, j + 2, F.lit(f)), "")
                return F.when(c.isNotNull(), F.struct(j.alias("j"), left.alias("l"), right.alias("r"), *[c[x].alias(x) for x in carried]))

            rows = parents.select("gid", "pos", "path", *more, F.explode(F.transform(slots, child)).alias("c"))
            rows = rows.where("c is not null").select(
                "gid", (F.col("pos") * f + F.col("c.j")).alias("pos"),
                F.concat(F.array(F.struct("c.l", "c.r")), F.col("path")).alias("path"), *more,
                *([f"c.{c}" for c in carried] if k == 1 else []))
            known = rows if k == 1 else write_table(rows, f"{name}-{k - 1}")
        alone = self.leaves.where(F.col("n") == 1).drop("n").join(above, "gid")
        return alone if known is None else known.unionByName(alone.select(known.columns))


def positions(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` with ``gid`` (its group's number, ascending with the group's name, null
    first), ``pos`` in its group and ``n``, the rows of the group."""
    numbered = global_row_number(leaves, ["group", *order], "_rn")
    groups = write_table(numbered.groupBy("group").agg(F.min("_rn").alias("gid"), F.count(F.lit(1)).alias("n")), "groups")
    small = broadcast_if_small(groups.withColumnRenamed("group", "_g"))
    joined = numbered.join(small, F.col("group").eqNullSafe(F.col("_g")))
    return joined.select("gid", (F.col("_rn") - F.col("gid")).alias("pos"), "n", *[c for c in leaves.columns if c != "group"])


def manifest(df: DataFrame, group: Column, id: Column, columns: Sequence[Column], tampered: Sequence[Column] | None = None,
             cfg: MerkleConfig = MerkleConfig()) -> DataFrame:
    """Per row: ``id, leaf, seen, subroot, root, path``; ``columns`` are hashed into the
    leaf, ``tampered`` (what is checked later; default: the same) into ``seen``."""
    leaves = df.select(group.alias("group"), id.alias("id"), leaf_digest(columns).alias("digest"),
                       leaf_digest(tampered if tampered is not None else columns).alias("seen"))
    leaves = write_table(leaves, "leaves")
    tree = Tree(write_table(positions(leaves, ["id", "digest"]), "leaf-positions"), cfg, "nodes")
    subroots = write_table(tree.roots(), "subroots")
    ranked = global_row_number(subroots, ["gid"], "_rn")
    total = F.lit(subroots.count()).cast("long")
    top = Tree(write_table(ranked.select(F.lit(0).cast("long").alias("gid"), (F.col("_rn") - 1).alias("pos"), total.alias("n"),
                                         "digest", F.col("gid").alias("tree")), "top"), cfg, "top-nodes")
    root = top.roots().select("gid", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    above = top.paths(root, "top-paths").select(F.col("tree").alias("gid"), F.col("digest").alias("subroot"), "root", "path")
    rows = tree.paths(write_table(above, "subroot-paths"), "paths")
    return rows.select("id", F.col("digest").alias("leaf"), "seen", "subroot", "root", "path")


def verify(rows: DataFrame) -> DataFrame:
    """``manifest`` rows with ``proof_sha256``, ``folded_root`` (from ``seen`` and the
    siblings) and ``verified``, without the path."""
    out = rows.select("*", siblings_digest(F.col("path")).alias("proof_sha256"),
                      fold(F.col("seen"), F.col("path")).alias("folded_root"))
    return out.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def verify_documents(df: DataFrame, cfg: MerkleConfig = MerkleConfig()) -> DataFrame:
    """Manifest of ``documents`` by source, and the check of a copy in which the text of
    every row whose unsigned crc32 of its decimal id is a multiple of 5 has lost its
    capital letters A-Z."""
    cols = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    seen = [*cols[:4], F.when(hit, ascii_lower(F.col("text"))).otherwise(F.col("text"))]
    out = verify(manifest(df, F.col("source"), F.col("doc_id"), cols, seen, cfg))
    return out.withColumnRenamed("id", "doc_id")
