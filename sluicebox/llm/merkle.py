"""Merkle manifest of a dataset, its nodes labelled by the intervals of leaf ranks that they cover.

A leaf is the digest of a row's fields. The leaves of a group are numbered in order; a node of a level
covers an interval of those numbers, at most `FANOUT` intervals of the level below, and its digest is
that of theirs in order. Once a single node covers a group, it is the group's subroot; the subroots, in
order of their groups, are the leaves of a tree of the same kind, whose last node is the root.

Intervals nest, so a node's parent is the node of the next level that contains its interval. Both lie
in one bucket of that level's width, which is what joins them. What a parent's interval has beside the
child's, before and after it, are the child's siblings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluicebox.llm.common import written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<before:string,after:string>>"
_CHILDREN = "array<struct<lo:bigint,hi:bigint,digest:string>>"


def encoded(value: Column) -> Column:
    """`-` for null, else length in bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*texts), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_tampered(id_column: Column) -> Column:
    """Whether a row is one of those on which a change of the text must show."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def numbered(df: DataFrame, order: Sequence[str], group: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their number `lo` within the group, the group's size `n` and number `tree`; and the
    groups with their number and how many there are (`n_trees`).

    Rows are sorted in ranges over all tasks and written. What a range holds of a group is one row of a
    small table, over which a window sums the number that each such part starts at; so no task reads a
    whole group, whatever its size. Equal rows are dealt over ranges by their place in the input.
    """
    keys = [*([group] if group else []), *order, "_place"]
    ranged = (
        df.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")
    )
    rows = written(ranged.withColumn("_seen", F.monotonically_increasing_id()), "merkle-sorted").withColumns({
        "_range": F.shiftright("_seen", 33), "_at": F.col("_seen").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    held = F.col(group) if group else F.lit(0)
    parts = rows.groupBy(F.col("_range").alias("_of_range"), held.alias("_group")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_of_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(parts.withColumns({
        "_start": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "n": F.sum("_rows").over(whole),
    }), "merkle-ranges")
    if group:
        trees, _ = numbered(parts.select(F.col("_group").alias("_of_group")).distinct(), ["_of_group"])
        trees = written(trees.select("_of_group", F.col("lo").alias("tree"), F.col("n").alias("n_trees")), "merkle-groups")
        parts = parts.join(trees, F.col("_group").eqNullSafe(F.col("_of_group")))
    else:
        trees, parts = None, parts.withColumn("tree", F.lit(0).cast("bigint"))
    same = (F.col("_range") == F.col("_of_range")) & held.eqNullSafe(F.col("_group"))
    joined = rows.join(parts, same).withColumn("lo", F.col("_start") + F.col("_at") - F.col("_first"))
    return joined.select(*df.columns, "tree", "lo", "n"), trees


def build_levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """Nodes by level from the leaves up: `tree, n, lo, hi, digest` and, above the leaves, `children`.

    `n` is the number of leaves of the tree. A tree has no nodes above the one that covers it.
    """
    levels, width = [leaves], 1
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > width:
        below = levels[-1].where(F.col("n") > width)
        width *= fanout
        runs = below.groupBy("tree", "n", F.expr(f"lo div {width}").alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")
        )
        levels.append(written(runs.select(
            "tree", "n", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
            digest(F.array_join("children.digest", "")).alias("digest"), "children",
        ), "merkle-nodes"))
    return levels


def covering(levels: Sequence[DataFrame]) -> DataFrame:
    """`tree, digest` of the node that covers each tree."""
    out = None
    for nodes in levels:
        found = nodes.where("hi - lo + 1 = n").select("tree", "digest")
        out = found if out is None else out.unionByName(found)
    return out


def with_ancestors(levels: Sequence[DataFrame], crowns: DataFrame, fanout: int) -> DataFrame:
    """Leaves with `subroot`, `root` and `path`, the digests before and after them at each level up to
    the root, given those of the node that covers each tree (`tree, subroot, root, path`).

    From the top level down: a node that covers its tree takes what its tree has, any other is joined
    with the node of the next level that contains it and adds its siblings to that one's path.
    """
    above = None
    for level in range(len(levels) - 1, -1, -1):
        nodes, width = levels[level], fanout ** (level + 1)
        out = nodes.where("hi - lo + 1 = n").join(crowns, "tree")
        if above is not None:
            parents = above.select(
                F.col("tree").alias("of_tree"), F.expr(f"lo div {width}").alias("of_bucket"), F.col("lo").alias("from"),
                F.col("hi").alias("to"), F.col("children").alias("inside"), "subroot", "root", F.col("path").alias("further"),
            )
            inner = nodes.where(F.col("n") > fanout**level)
            contained = (
                (F.col("tree") == F.col("of_tree")) & (F.expr(f"lo div {width}") == F.col("of_bucket"))
                & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
            )
            step = F.struct(
                F.array_join(F.filter("inside", lambda c: c["hi"] < F.col("lo"))["digest"], "").alias("before"),
                F.array_join(F.filter("inside", lambda c: c["lo"] > F.col("hi"))["digest"], "").alias("after"),
            )
            attached = inner.join(parents, contained).withColumn("path", F.concat(F.array(step), F.col("further")))
            out = out.unionByName(attached.select(*out.columns))
        above = written(out, "merkle-paths") if level else out
    return above


@dataclass
class Manifest:
    """Nodes of the groups' trees by level, from the leaves (which have `id` and `tampered` too), and of
    the tree over their subroots; `groups` has the group column's value of each tree."""

    levels: list[DataFrame]
    groups: DataFrame
    top: list[DataFrame]
    fanout: int

    def root(self) -> str | None:
        """Digest of the whole dataset; None for no rows."""
        found = covering(self.top).first()
        return found["digest"] if found else None

    def proofs(self) -> DataFrame:
        """Leaves with their subroot, the root, and the path of sibling digests between them."""
        crown = covering(self.top).select(
            "tree", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
            F.expr(f"cast(array() as {_STEP})").alias("path"),
        )
        subroots = with_ancestors(self.top, crown, self.fanout)
        crowns = subroots.select(F.col("lo").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
        return with_ancestors(self.levels, written(crowns, "merkle-subroots"), self.fanout)


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
    text_col: str = "text", fanout: int = FANOUT,
) -> Manifest:
    """Digests of all rows and the trees over them; `tampered` is the leaf of the row with its text's
    A-Z in lower case, for the rows of `is_tampered`, and null for all others.

    Texts are read once. Only digests are sorted and shuffled, never texts.
    """
    changed = [ascii_lower(F.col(c)) if c == text_col else F.col(c) for c in fields]
    leaf = lambda columns: digest(*[encoded(c) for c in columns])
    digests = written(docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(group_col).alias("of_group"),
        leaf([F.col(c) for c in fields]).alias("digest"),
        F.when(is_tampered(F.col(id_col)), leaf(changed)).alias("tampered"),
    ), "merkle-leaves")
    rows, groups = numbered(digests, ["id", "digest"], "of_group")
    leaves = written(rows.select("id", "tree", "n", "lo", F.col("lo").alias("hi"), "digest", "tampered"), "merkle-ranked")
    levels = build_levels(leaves, fanout)
    subroots = groups.join(covering(levels), "tree").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("n_trees").alias("n"), F.col("tree").alias("lo"),
        F.col("tree").alias("hi"), "digest",
    )
    groups = groups.select("tree", F.col("_of_group").alias(group_col))
    return Manifest(levels, groups, build_levels(written(subroots, "merkle-subroots"), fanout), fanout)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its sibling digests give."""
    return F.aggregate(path, leaf, lambda acc, step: digest(step["before"], acc, step["after"]))


def verify(docs: DataFrame, **options) -> DataFrame:
    """`doc_id, leaf, subroot, root, proof_sha256, folded_root, verified` for each row of `docs`.

    `proof_sha256` is the digest of all sibling digests from the leaf's to the root's children, left to
    right within a level. `folded_root` is what the changed leaf (of rows that `is_tampered` names) or
    the leaf gives with them, `verified` whether that is the root.

    Defined results: nulls in any field are digested as `-`, an empty text as one of length 0; null ids
    come first in their group and are not tampered with; rows of one id are ordered by their leaves, and
    repeated rows are leaves each; a null group is a group, the first; a single row is its own subroot
    and a single subroot the root, with an empty proof; an empty table gives no rows; other columns are
    not read.
    """
    leaves = manifest(docs, **options).proofs()
    siblings = F.transform("path", lambda step: F.concat(step["before"], step["after"]))
    out = leaves.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        digest(F.array_join(siblings, "")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "digest")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
