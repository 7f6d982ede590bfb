"""A Merkle manifest of a table of documents: one tree per language, one root over the languages, a proof per row.

A leaf is the digest of a row's doc_id, source, lang, n_chars and text. Leaves of a language ascend by doc_id and become a tree of
`arity` children per node; the roots of the languages, in order of the languages, become a tree of the same kind.

Every level is one equi-join of its nodes with themselves on the computed place of the sibling: place XOR 1 in a binary tree, one
row per slot offset otherwise. The rows in slot zero then hold a whole run and emit the parent. Levels shrink by the arity, so that
all of them together hold about twice the leaves; each is written, so that a lost executor costs one level at most. Proofs go down
the same levels: a node's path is its own siblings before the path of its parent. Nothing is gathered: leaves get their places from
a range partitioning and the sizes of its ranges, so that a language that holds most rows is spread like any other. Joins are on
(tree, place) and never on a language alone. Only the table of ranges (one row per range and language in it) is broadcast, if it is small.

Defined results: a null field counts as `-`; null languages are a tree of their own, before all others; null doc_ids come first in
their tree; rows that share a doc_id are ordered by their leaf, and equal rows share everything but their place. The empty table gives no
rows. Texts of any length are hashed whole. Columns other than the five do not enter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from connlens.llm.common import broadcast_if_small, written
from connlens.sources.storage import cut_lineage

#: Children of a node.
ARITY = 2
#: Levels that proofs descend in one job.
LEVELS_A_JOB = 4
#: A proof: from the leaf to the root, the node's slot in its run and the digests of the others of the run, left to right.
PATH = "array<struct<slot: int, siblings: array<binary>>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(n_chars: Column | None = None) -> Column:
    """Hexadecimal digest of a row; `n_chars` may stand in for the column of that name."""
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") if n_chars is None else n_chars, F.col("text")]
    return F.sha2(F.concat(*[_field(f) for f in fields]), 256)


def _joined(digests: Column) -> Column:
    """Digest (binary) of an array of digests, as hexadecimal text one after the other."""
    return F.unhex(F.sha2(F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), ""), 256))


def _up(n: str, arity: int) -> Column:
    """How many parents n nodes have."""
    return F.expr(f"({n} + {arity - 1}) div {arity}")


def _div(name: str, arity: int) -> Column:
    return F.expr(f"{name} div {arity}")


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """The rows with `place` (from 0, in the given order) and `n` (their number) within each `tree`.

    Rows that are equal in all of `order` are dealt out by their place in the input, so that no range holds more of them than others do.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "_salt"]
    dealt = nodes.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    ranges = cut_lineage(dealt.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_salt")).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    )
    sizes = ranges.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(W.partitionBy("tree").orderBy("_part")) - F.col("_rows")
    starts = written(
        sizes.select("tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(W.partitionBy("tree")).alias("n")),
        "manifest-ranges",
    )
    return ranges.join(broadcast_if_small(starts), ["tree", "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """The nodes with `siblings`: the digests of the others of their run, left to right."""
    if arity == 2:
        other = nodes.select("tree", F.col("place").bitwiseXOR(1).alias("place"), F.array("digest").alias("siblings"))
        return nodes.join(other, ["tree", "place"], "left").withColumn("siblings", F.coalesce("siblings", F.array().cast("array<binary>")))
    slot = F.pmod("place", F.lit(arity))
    asked = nodes.select("tree", "place", F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("_offset"))
    asked = asked.select("tree", F.col("place").alias("_of"), (F.col("place") - slot + F.pmod(slot + F.col("_offset"), F.lit(arity))).alias("place"))
    found = asked.join(nodes.select("tree", "place", "digest"), ["tree", "place"])
    runs = found.groupBy("tree", F.col("_of").alias("place")).agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("_run"))
    joined = nodes.join(runs, ["tree", "place"], "left")
    siblings = F.coalesce(F.col("_run.digest"), F.array().cast("array<binary>"))
    return joined.withColumn("siblings", siblings).drop("_run")


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """Rows in slot zero hold their whole run: they emit the parent."""
    heads = level.filter(F.pmod("place", F.lit(arity)) == 0)
    digest = _joined(F.concat(F.array("digest"), F.col("siblings")))
    return heads.select("tree", _div("place", arity).alias("place"), _up("n", arity).alias("n"), digest.alias("digest"))


def grown(leaves: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """(levels, roots) of the trees of `leaves` (tree, place, n, digest and any others).

    A level holds the nodes of all trees that have more than one node there, with their siblings; roots are (tree, digest).
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels, roots = leaves, [], leaves.filter("n = 1").select("tree", "digest")
    while most > 1:
        levels.append(written(_with_siblings(nodes.filter("n > 1"), arity), "manifest-level"))
        nodes, most = _parents(levels[-1], arity), -(-most // arity)
        roots = roots.unionByName(nodes.filter("n = 1").select("tree", "digest"))
    return levels, roots


def proved(leaves: DataFrame, levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """Every leaf with `path` and the columns of `above`: one row per tree, with tree, path and others that all leaves get."""
    others = [c for c in above.columns if c not in ("tree", "path")]
    tops = above.select("tree", F.lit(0).cast("long").alias("_up"), F.lit(1).cast("long").alias("_n"), "path", *others)
    step = F.array(F.struct(F.pmod("place", F.lit(arity)).cast("int").alias("slot"), F.col("siblings")))
    # A parent is known by its tree, its place and the size of its level: the root of a low tree is no node of a higher one.
    parents = tops
    for i in reversed(range(len(levels))):
        level = levels[i].withColumns({"_up": _div("place", arity), "_n": _up("n", arity)})
        met = level.join(parents, ["tree", "_up", "_n"]).withColumn("path", F.concat(step.cast(PATH), "path")).drop("_up", "_n")
        if i:
            paths = met.select("tree", F.col("place").alias("_up"), F.col("n").alias("_n"), "path", *others)
            parents = (written(paths, "manifest-paths") if i % LEVELS_A_JOB == 0 else paths).unionByName(tops)
    lone = leaves.filter("n = 1").join(tops.drop("_up", "_n"), "tree")
    if not levels:
        return lone
    return met.drop("siblings").unionByName(lone)


def manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """One row per document: doc_id, lang, leaf, altered, place, n, path, subroot, root (digests as binary).

    `altered` is the leaf of a tampered row: n_chars one higher, where 7 divides the crc32 of the decimal doc_id; else null.
    """
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        F.unhex(leaf_digest()).alias("digest"),
        F.when(hit & F.col("n_chars").isNotNull(), F.unhex(leaf_digest(F.col("n_chars") + 1))).alias("altered"),
    )
    leaves = written(placed(written(leaves, "manifest-leaves"), "doc_id", "digest"), "manifest-places")
    levels, roots = grown(leaves, arity)
    # The trees become the leaves of one tree above them; `-` for null sorts before `=` and a language.
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("lang_tree"), "digest")
    tops = written(placed(tops, "lang_tree"), "manifest-tops")
    top_levels, root = grown(tops, arity)
    start = root.select("tree", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    above = proved(tops, top_levels, start, arity)
    above = written(above.select(F.col("lang_tree").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "manifest-tops")
    rows = proved(leaves, levels, above, arity)
    return rows.select("doc_id", "lang", F.col("digest").alias("leaf"), "altered", "place", "n", "path", "subroot", "root")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""

    def step(digest: Column, at: Column) -> Column:
        left = F.slice(at["siblings"], F.lit(1), at["slot"])
        right = F.slice(at["siblings"], at["slot"] + 1, F.size(at["siblings"]))
        return _joined(F.concat(left, F.array(digest), right))

    return F.aggregate(path, leaf, step)


def proofs(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """The digests of every row's proof, and whether the row, tampered or not, still folds to the root."""
    siblings = F.flatten(F.transform("path", lambda at: at["siblings"]))

    def text(name: str) -> Column:
        return F.lower(F.hex(name)).alias(name)

    rows = manifest(docs, arity).withColumns(
        {"proof_sha256": F.lower(F.hex(_joined(siblings))), "folded_root": folded(F.coalesce("altered", "leaf"), F.col("path"))}
    )
    return rows.select(
        "doc_id", text("leaf"), text("subroot"), text("root"), "proof_sha256", text("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"), "lang", "place",
    )


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE concat(strlen(CAST({value} AS VARCHAR)), ':', CAST({value} AS VARCHAR)) END"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(concat(" + ", ".join(map(_field_sql, ("doc_id", "source", "lang", n_chars, "text"))) + "))"


#: One turn of the CRC-32 register for each of the eight bits of a character, begun and ended with all bits set.
_CRC = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), "
    "lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))), lambda c, b: "
    "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"
)


def _tree_sql(name: str, leaves: str) -> str:
    return (
        f"{name}(tree, lvl, place, n, digest) AS (SELECT tree, 0, place, n, digest FROM {leaves} UNION ALL "
        f"SELECT tree, lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY place)) FROM {name} "
        "WHERE n > 1 GROUP BY tree, lvl, place // 2, (n + 1) // 2)"
    )


def _path_sql(name: str, leaves: str, tree: str) -> str:
    """Per leaf, its place and what stands beside it, level by level: R or L and the sibling on that side, N for none."""
    return (
        f"{name} AS (SELECT l.tree, l.place, list(CASE WHEN s.digest IS NULL THEN 'N' WHEN (l.place >> u.lvl) % 2 = 0 "
        "THEN concat('R', s.digest) ELSE concat('L', s.digest) END ORDER BY u.lvl) AS path "
        f"FROM {leaves} l JOIN {tree} u ON u.tree = l.tree AND u.place = l.place >> u.lvl AND u.n > 1 "
        f"LEFT JOIN {tree} s ON s.tree = u.tree AND s.lvl = u.lvl AND s.place = xor(u.place, 1::BIGINT) GROUP BY l.tree, l.place)"
    )


ORACLE = (
    f"WITH RECURSIVE hit AS (SELECT *, CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS altered_chars FROM documents), "
    "leaf AS (SELECT doc_id, lang, CASE WHEN lang IS NULL THEN '-' ELSE concat('=', lang) END AS tree, "
    f"{_leaf_sql('n_chars')} AS digest, {_leaf_sql('altered_chars')} AS altered FROM hit), "
    "low AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place, "
    "count(*) OVER (PARTITION BY tree) AS n FROM leaf), "
    f"{_tree_sql('lows', 'low')}, "
    "high AS (SELECT '' AS tree, tree AS lang_tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n "
    "FROM lows WHERE n = 1), "
    f"{_tree_sql('highs', 'high')}, {_path_sql('low_path', 'low', 'lows')}, {_path_sql('high_path', 'high', 'highs')}, "
    "whole AS (SELECT l.doc_id, l.lang, l.digest AS leaf, l.altered, h.digest AS subroot, l.place, "
    "list_concat(coalesce(lp.path, []), coalesce(hp.path, [])) AS path "
    "FROM low l JOIN high h ON h.lang_tree = l.tree LEFT JOIN low_path lp ON lp.tree = l.tree AND lp.place = l.place "
    "LEFT JOIN high_path hp ON hp.place = h.place), "
    "ended AS (SELECT *, (SELECT digest FROM highs WHERE n = 1) AS root, "
    "sha256(array_to_string(list_transform(list_filter(path, lambda s: s <> 'N'), lambda s: s[2:]), '')) AS proof_sha256, "
    "list_reduce(list_concat([altered], path), lambda d, s: sha256(CASE s[1] WHEN 'R' THEN concat(d, s[2:]) "
    "WHEN 'L' THEN concat(s[2:], d) ELSE d END)) AS folded_root FROM whole) "
    "SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified, lang, place FROM ended"
)
