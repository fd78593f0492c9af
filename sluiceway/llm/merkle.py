"""A Merkle manifest of a dataset: hash trees whose nodes are labelled with the leaf ranks they cover.

Every group has a tree of its own and the groups' roots are the leaves of a last one. A node's label is its level and
the half-open interval of leaf ranks below it. Labels nest: an ancestor of a node is one whose interval contains the
node's, and within a level that is an equality of buckets, ``rank div FAN**level``. So ancestors are attached by an
equi join per level, and the siblings of a node are the intervals of its parent's members without its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.arrow import saved

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"
#: ``monotonically_increasing_id`` keeps the partition above so many bits.
_ROW_BITS = 33


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex sha256 of the fields, each as its UTF-8 byte count, a colon and itself, or ``-`` if it is null."""
    parts = []
    for value in values:
        said = value.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said)))
    return F.sha2(F.concat(*parts), 256)


def tampered(doc_id: Column) -> Column:
    """Rows of which a check must notice the change; never those without an id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 3 == 0, F.lit(False))


def numbered(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Add ``place``, the row's position from 0 in the order of all rows, and ``part``, the range it lies in.

    Ranges are sorted side by side and written once; what is counted in one place is one row per range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = saved(ranged, label).withColumn("part", F.shiftright("_at", _ROW_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    return placed.join(F.broadcast(parts), "part").withColumn("place", F.col("_base") + inside).drop("_at", "_base")


def _bucket(lo: Column, level: int) -> Column:
    return F.floor(lo / F.lit(FAN**level))


def _levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """All levels of the trees over ``nodes`` (grp, size, lo, hi, digest), whose largest has ``most`` leaves.

    A level holds the nodes of those trees that had more than one node on the level below, with their members.
    """
    levels, span = [nodes], 1
    while span < most:
        below = levels[-1].where(F.col("size") > span)
        span *= FAN
        level = len(levels)
        members = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        runs = below.groupBy("grp", "size", _bucket(F.col("lo"), level).alias("bucket")).agg(members.alias("members"))
        above = runs.select(
            "grp", "size", "bucket", (F.col("bucket") * span).alias("lo"), F.least((F.col("bucket") + 1) * span, F.col("size")).alias("hi"),
            F.sha2(F.array_join(F.transform("members", lambda m: m["digest"]), ""), 256).alias("digest"), "members",
        )
        levels.append(saved(above, f"level{level}"))
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The root of every tree: the first node that covers all its leaves."""
    roots = [nodes.where(_is_top(k)).select("grp", "digest") for k, nodes in enumerate(levels)]
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return out


def _is_top(level: int) -> Column:
    size = F.col("size")
    return (size <= FAN**level) & ((size > FAN ** (level - 1)) if level else F.lit(True))


def _paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Level 0 with ``path``, the siblings left and right of the node and of each of its ancestors, from below.

    ``above`` (grp, path, further columns) is what lies over each tree's root.
    """
    carried = [c for c in above.columns if c not in ("grp", "path")]
    labelled = None
    for level in reversed(range(len(levels))):
        nodes = levels[level]
        found = nodes.where(_is_top(level)).join(above, "grp")
        if labelled is not None:
            parents = labelled.select(
                F.col("grp").alias("_grp"), F.col("bucket").alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                F.col("members").alias("_members"), "path", *carried,
            )
            contained = (
                (F.col("grp") == F.col("_grp")) & (_bucket(F.col("lo"), level + 1) == F.col("_bucket"))
                & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            )
            below = nodes.where(F.col("size") > FAN**level).join(parents, contained)
            left = F.filter("_members", lambda m: m["hi"] <= F.col("lo"))
            right = F.filter("_members", lambda m: m["lo"] >= F.col("hi"))
            said = [F.array_join(F.transform(side, lambda m: m["digest"]), "").alias(name) for side, name in ((left, "left"), (right, "right"))]
            step = below.withColumn("path", F.concat(F.array(F.struct(*said)), F.col("path")))
            found = found.unionByName(step.drop("_grp", "_bucket", "_lo", "_hi", "_members"))
        labelled = found
    return labelled


def _largest(nodes: DataFrame) -> int:
    return nodes.agg(F.max("size")).first()[0] or 0


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Per row: id, ``leaf``, ``subroot`` (of its group), ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    Leaves hash ``fields``. A group's leaves ascend by id; every ``FAN`` neighbours (the last fewer, even one) become
    their hash until one is left. The groups' roots, null first and then bytewise, become the root in the same way.
    The proof hashes the siblings from the leaf up, left to right. Every third row by a hash of its id is checked with
    its text in lower case; ``folded_root`` is what its leaf and the siblings give, ``verified`` whether that is the root.

    Rows without an id come first in their group and are not tampered with; a group may be null. Rows of one id are
    ordered by their leaf; wholly equal rows are leaves of their own side by side. Null and empty values hash
    differently. Texts are hashed whole; other columns are not read. An empty table gives no rows.
    """
    leaf = leaf_digest([F.col(f) for f in fields])
    low = F.translate(text_col, _UPPER, _LOWER)
    changed = leaf_digest([low if f == text_col else F.col(f) for f in fields])
    leaves = docs.select(
        F.col(group_col).alias("name"), F.col(id_col).alias("id"), leaf.alias("digest"), F.when(tampered(F.col(id_col)), changed).alias("given")
    )
    leaves = saved(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = numbered(leaves, ["name", "id", "digest", "row"], "ranks")

    # Where each group begins and how many leaves it has, by its pieces in the ranges, so that no group is one task.
    pieces = placed.groupBy("part", "name").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    groups = pieces.groupBy("name").agg(F.min("first").alias("begin"), F.sum("n").alias("size"))
    groups = numbered(groups, ["begin"], "groups").select("name", "begin", "size", F.col("place").alias("grp"))
    known = pieces.alias("p").join(groups.alias("g"), F.col("p.name").eqNullSafe(F.col("g.name")))
    known = saved(known.select(F.col("p.part").alias("_part"), F.col("p.name").alias("_name"), "begin", "size", "grp"), "pieces")
    same = (F.col("part") == F.col("_part")) & F.col("name").eqNullSafe(F.col("_name"))
    rank = F.col("place") - F.col("begin")
    nodes = placed.join(known, same).select("grp", "size", rank.alias("lo"), (rank + 1).alias("hi"), "digest", "id", "given")

    trees = _levels(nodes, _largest(groups))
    tops = _tops(trees)
    count = groups.agg(F.max("grp")).first()[0]
    several = tops.select(F.lit(0).cast("long").alias("grp"), F.lit((count or 0) + 1).cast("long").alias("size"), F.col("grp").alias("lo"), (F.col("grp") + 1).alias("hi"), "digest")
    whole = _levels(saved(several, "subroots"), 0 if count is None else count + 1)
    root = _tops(whole).select("grp", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    over = _paths(whole, root).select(F.col("lo").alias("grp"), F.col("digest").alias("subroot"), "root", "path")

    proved = _paths(trees, over)
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256)
    folded = F.aggregate("path", F.coalesce("given", "digest"), lambda acc, p: F.sha2(F.concat(p["left"], acc, p["right"]), 256))
    out = proved.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
