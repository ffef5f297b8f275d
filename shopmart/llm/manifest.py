"""Merkle manifest of a dataset: one hash over all rows, and a proof for each.

A row is a leaf: the SHA-256 of its columns, each with its length. Per group (a source) leaves are
ordered by id, and every ``FAN`` consecutive nodes become the hash of their hashes until one node
remains, the group's root. The roots, ordered by group, make a tree in the same way, whose root
stands for the dataset.

Every node carries the interval of leaf ranks that it covers. Intervals of a level nest in those of
the next, so going down from the root a join attaches ancestors to nodes: its bucket is the rank
divided by the width of the upper level, so a bucket has one ancestor and at most ``FAN`` nodes, and its
condition is that one interval contains the other. What an ancestor's interval holds beside
the node's own are the node's siblings: those before it and those behind it. They are added to
the ancestor's own path; a leaf's path is its proof.

Ranks are found without a group in one task: rows are dealt out by ranges of group and id, ranked
within a range, and the sizes of earlier ranges (one row per group and range) are added. So a group with a third
of all rows is spread like any other. Texts are read once and never shuffled, as only their hashes go on.

Nulls: a null column is hashed as ``-``; a null group is the first group, null ids are the first of
their group. Rows that repeat an id are ordered by their hash, so the result does not depend on the
order of the input; equal rows are leaves of their own. An empty table gives no rows. Columns beside
those that are hashed are not read. All is DataFrame functions.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopmart.llm.common import stored

FAN = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(value: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(value.cast("binary"), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The hash of a row's values in order, each `-` or its byte count, a colon and itself."""
    return digest(F.concat(*[_field(v) for v in values]))


def ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``lo`` (rank from 0 among the rows of the same ``g``), ``hi`` (one more) and ``total``.

    ``g`` is a struct and never null itself. Nulls come first.
    """
    by_range = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    dealt = rows.repartitionByRange(*by_range)
    # Written, so that counts and ranks see the same ranges.
    placed = stored(dealt.select("*", F.spark_partition_id().alias("range")), name)
    counts = placed.groupBy("g", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    offsets = counts.select(
        "g",
        "range",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )
    inside = Window.partitionBy("g", "range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = placed.withColumn("own", F.row_number().over(inside) - 1)
    lo = (F.col("before") + F.col("own")).cast("long")
    found = numbered.join(offsets, ["g", "range"]).withColumn("lo", lo)
    return found.withColumn("hi", F.col("lo") + 1).drop("range", "own", "before")


def build(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Upper levels of the trees over ``leaves`` (``g``, ``total``, ``lo``, ``hi``, ``hash``), and each group's root.

    A level's rows are its nodes with their ``children`` (interval and hash, in order). Roots have
    their ``level``. There are as many levels as the largest group needs.
    """
    most = leaves.agg(F.max("total")).first()[0] or 0
    nodes = leaves.select("g", "total", "lo", "hi", "hash")
    levels: list[DataFrame] = []
    roots = _roots(nodes, 0)
    width = 1
    while width < most:
        width *= FAN
        children = F.sort_array(F.collect_list(F.struct("lo", "hi", "hash")))
        grouped = _pending(nodes).groupBy("g", "total", F.floor(F.col("lo") / width).alias("bucket"))
        parents = grouped.agg(children.alias("children"))
        parents = parents.select(
            "g",
            "total",
            F.col("children")[0]["lo"].alias("lo"),
            F.element_at("children", -1)["hi"].alias("hi"),
            digest(F.array_join(F.col("children.hash"), "")).alias("hash"),
            "children",
        )
        nodes = stored(parents, f"{name}-{len(levels) + 1}")
        levels.append(nodes)
        roots = roots.unionByName(_roots(nodes, len(levels)))
    return levels, roots


def _pending(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("hi") - F.col("lo") < F.col("total"))


def _roots(nodes: DataFrame, level: int) -> DataFrame:
    whole = nodes.where(F.col("hi") - F.col("lo") == F.col("total"))
    return whole.select("g", "hash", F.lit(level).alias("level"))


def _hashes(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["hash"]), "")


def paths(leaves: DataFrame, levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """``leaves`` with the columns of ``above`` (one row per ``g``, with a ``path``), the path being that
    of the group's root with the siblings of all nodes below it put before: those that come
    earlier (``left``) and later (``right``) as one text of hashes each."""
    carried = [c for c in above.columns if c not in ("g", "path")]
    upper = None
    for k in range(len(levels), -1, -1):
        nodes = levels[k - 1] if k else leaves
        own = [c for c in nodes.columns if c != "g"]
        whole = nodes.where(F.col("hi") - F.col("lo") == F.col("total"))
        found = whole.join(above, "g").select("g", *own, "path", *carried)
        if upper is not None:
            width = FAN ** (k + 1)
            bucket = F.floor(F.col("lo") / width).alias("bucket")
            n = _pending(nodes).select("*", bucket).alias("n")
            ancestors = upper.select("g", bucket, "lo", "hi", "children", "path", *carried).alias("a")
            contains = (F.col("a.lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("a.hi"))
            same = (F.col("n.g") == F.col("a.g")) & (F.col("n.bucket") == F.col("a.bucket"))
            siblings = F.struct(
                _hashes(F.filter("a.children", lambda x: x["hi"] <= F.col("n.lo"))).alias("left"),
                _hashes(F.filter("a.children", lambda x: x["lo"] >= F.col("n.hi"))).alias("right"),
            )
            attached = n.join(ancestors, same & contains).select(
                F.col("n.g").alias("g"),
                *[F.col(f"n.{c}").alias(c) for c in own],
                F.concat(F.array(siblings), F.col("a.path")).alias("path"),
                *[F.col(f"a.{c}").alias(c) for c in carried],
            )
            found = found.unionByName(attached)
        upper = found
    return upper


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, start, lambda own, p: digest(F.concat(p["left"], own, p["right"])))


def proof(path: Column) -> Column:
    """The hash of all siblings' hashes, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def manifest(leaves: DataFrame) -> DataFrame:
    """Every row of ``leaves`` with ``subroot`` (its group's), ``path`` and ``root``.

    ``leaves`` has ``group``, ``id``, ``hash`` and any others but ``g``, ``total``, ``lo``, ``hi``, ``range``, ``own``, ``before`` and
    ``bucket``, which are kept.
    """
    # Written first: dealing out by ranges reads its input twice, and texts should be read once.
    hashed = stored(leaves.withColumn("g", F.struct(F.col("group"))), "manifest-hashes")
    own = stored(ranked(hashed, ["id", "hash"], "manifest-leaves"), "manifest-ranks")
    levels, roots = build(own, "manifest-nodes")

    # The groups' roots are leaves of one more tree.
    one = F.struct(F.lit(0).alias("all"))
    tops = roots.select(F.col("g").alias("of"), F.col("hash"), one.alias("g"))
    tops = stored(ranked(tops, ["of"], "manifest-groups"), "manifest-group-ranks")
    top_levels, top_roots = build(tops, "manifest-tops")
    root = top_roots.select("hash").first()
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    top = tops.limit(1).select("g", no_path.alias("path"))
    above = paths(tops, top_levels, top).select(
        F.col("of").alias("g"), F.col("hash").alias("subroot"), "path"
    )
    above = stored(above, "manifest-group-paths")
    found = paths(own, levels, above)
    return found.withColumn("root", F.lit(root.hash if root else None).cast("string")).drop(
        "g", "total", "lo", "hi"
    )


def verified_manifest(
    docs: DataFrame,
    tampered: Column,
    columns: Sequence[str] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Every row's id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    Where ``tampered`` holds, A-Z in the text were lower-cased after the manifest was made, so the leaf's
    path no longer leads to the root, unless nothing changed by it.
    """
    lowered = F.translate(F.col(text_col), string.ascii_uppercase, string.ascii_lowercase)
    changed = [lowered if c == text_col else F.col(c) for c in columns]
    later = F.when(tampered & (lowered != F.col(text_col)), leaf(changed))
    leaves = docs.select(
        F.col(group_col).alias("group"),
        F.col(id_col).alias("id"),
        leaf([F.col(c) for c in columns]).alias("hash"),
        later.alias("later"),
    )
    found = manifest(leaves).withColumn("folded_root", fold(F.coalesce("later", "hash"), F.col("path")))
    return found.select(
        F.col("id").alias(id_col),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
