"""A Merkle manifest of a table: a content-addressed store of nodes, and proofs by descent from the root."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import ranked
from lakestrata.session import work_folder

#: Children of a node.
FAN_OUT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one behind the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as a leaf holds it: `-` if null, else its number of UTF-8 bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _depth(n: Column) -> Column:
    """Levels above `n` nodes until one is left."""
    powers = F.array(*(F.lit(FAN_OUT**i) for i in range(21)))
    return F.size(F.filter(powers, lambda p: p < n))


def build(nodes: DataFrame, folder: str) -> DataFrame:
    """Trees over `nodes` (tree, rank, depth, digest): every `FAN_OUT` neighbours of a level become one.

    Writes a level of the store at a time, below `folder`, and returns the roots:
    tree, depth, digest. Each level is made from the one before it as written, by
    groups of eight rows, so no task holds a tree.
    """
    spark = nodes.sparkSession
    columns = ["tree", "rank", "depth", "digest"]
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    level, roots = nodes.select(*columns), []
    for number in range(deepest + 1):
        roots.append(level.where(F.col("depth") == number).select("tree", "depth", "digest"))
        if number == deepest:
            break
        children = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda c: c["digest"])
        path = f"{folder}/level={number + 1}"
        (
            level.where(F.col("depth") > number)
            .groupBy("tree", "depth", F.shiftright("rank", 3).alias("parent"))
            .agg(children.alias("children"))
            .select(
                "tree", F.col("parent").alias("rank"), "depth", digest(F.array_join("children", "")).alias("digest"), "children"
            )
            .write.parquet(path)
        )
        level = spark.read.parquet(path).select(*columns)
    return reduce(DataFrame.unionAll, roots)


def records(spark: SparkSession, folder: str, level: int) -> DataFrame:
    """The store's records of a level: digest and children, each digest once however many nodes have it."""
    stored = spark.read.parquet(f"{folder}/level={level}")
    return stored.groupBy("digest").agg(F.any_value("children").alias("children"))


def descend(starts: DataFrame, requests: DataFrame, folder: str) -> DataFrame:
    """The path from a tree's root to each requested leaf.

    `starts`: tree, depth, digest, path (what was collected above the root);
    `requests`: tree, rank, depth and columns of their own (none named like those
    returned). Returns tree, top (the tree's root), rank, digest, path (the segments
    from the root down: what stands left and right of the chosen child in its run)
    and the requests' columns.

    All requests whose ranks agree in the digits so far walk together. At each
    level the record of their digest is looked up, the next digit picks a child,
    and the others go into the path. Requests are reduced to their different digits
    before a level's shuffle. What repeats a digest (rows that are equal in every
    column) makes a look-up uneven; its join is a plain one, which adaptive
    execution splits.
    """
    spark = starts.sparkSession
    deepest = starts.agg(F.max("depth")).first()[0] or 0
    wanted = [requests.select("tree", "rank", "depth")]
    for number in range(1, deepest):
        below = wanted[-1].where(F.col("depth") >= number)
        path = f"{folder}/asked={number}"
        below.select("tree", F.shiftright("rank", 3).alias("rank"), "depth").distinct().write.parquet(path)
        wanted.append(spark.read.parquet(path))
    own = [c for c in requests.columns if c not in ("tree", "rank", "depth")]
    at_root = starts.select("tree", F.col("digest").alias("top"), F.lit(0).cast("long").alias("rank"), "digest", "path", "depth")
    columns = ["tree", "top", "rank", "digest", "path"]
    front = at_root.where(F.col("depth") == deepest).select(*columns)
    for number in range(deepest, 0, -1):
        # The leaves' level brings the requests' own columns along.
        more = own if number == 1 else []
        found = front.join(records(spark, folder, number), "digest").select("tree", "top", "rank", "path", "children")
        asked = (requests if number == 1 else wanted[number - 1]).where(F.col("depth") >= number)
        asked = asked.select(
            F.col("tree").alias("__tree"),
            F.shiftright("rank", 3).alias("__parent"),
            F.col("rank").alias("__rank"),
            (F.col("rank") % FAN_OUT).cast("int").alias("__digit"),
            *more,
        )
        children, digit = F.col("children"), F.col("__digit")
        left = F.array_join(F.slice(children, F.lit(1), digit), "")
        right = F.array_join(F.slice(children, digit + 2, F.lit(FAN_OUT)), "")
        front = found.join(asked, (F.col("tree") == F.col("__tree")) & (F.col("rank") == F.col("__parent"))).select(
            "tree",
            "top",
            F.col("__rank").alias("rank"),
            F.element_at(children, digit + 1).alias("digest"),
            F.concat("path", F.array(F.struct(left.alias("left"), right.alias("right")))).alias("path"),
            *more,
        )
        if number > 1:
            path = f"{folder}/front={number - 1}"
            front.unionAll(at_root.where(F.col("depth") == number - 1).select(*columns)).write.parquet(path)
            front = spark.read.parquet(path)
    # A tree of one leaf: its root is the leaf.
    alone = at_root.where(F.col("depth") == 0).select(*columns).join(
        requests.where(F.col("depth") == 0).select(F.col("tree").alias("__tree"), *own), F.col("tree") == F.col("__tree")
    )
    alone = alone.select(*columns, *own)
    return front.unionAll(alone) if deepest else alone


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path, segments from the root down, give."""
    return F.aggregate(F.reverse(path), leaf, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(
    documents: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    text_col: str = "text",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of the columns `columns`; each group of `group_col` (null
    is one) is a tree of its leaves in ascending order of the id, and the trees'
    roots, by group in byte order and null first, are the leaves of one tree more.
    `proof_sha256` is the digest of a leaf's siblings from the leaf up.
    `folded_root` is what the siblings give with the leaf of the row after tampering
    (text in lower case, A-Z only, where 3 divides the crc32 of the id), and
    `verified` whether that is the root.

    Null values are leaves' parts of their own (`-`), unlike empty texts (`0:`);
    null ids come first and are not tampered with. Rows of one id are ordered by
    their leaves; equal rows are leaves each, in any order, as they cannot be told
    apart. Long texts are hashed whole. An empty table gives no rows; columns that
    are not named are not read.
    """
    spark = documents.sparkSession
    folder = work_folder(spark, "merkle")
    col = {c: F.col(quoted(c)) for c in {*columns, id_col, group_col, text_col}}
    tampered = F.crc32(col[id_col].cast("string").cast("binary")) % 3 == 0
    values = [(c, col[c]) for c in columns]
    lowered = [(c, F.translate(v, _UPPER, _LOWER) if c == text_col else v) for c, v in values]
    group = col[group_col].cast("string")
    leaves = documents.select(
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("tree"),
        col[id_col].alias("doc_id"),
        digest(*(field(v) for _, v in values)).alias("digest"),
        F.when(tampered, digest(*(field(v) for _, v in lowered))).alias("altered"),
    )
    leaves = ranked(leaves, "tree", ["doc_id", "digest"], f"{folder}/leaves")
    leaves.withColumn("depth", _depth(F.col("of"))).write.parquet(f"{folder}/ranked")
    leaves = spark.read.parquet(f"{folder}/ranked")
    build(leaves, f"{folder}/groups").write.parquet(f"{folder}/subroots")
    subroots = spark.read.parquet(f"{folder}/subroots")

    # The roots of all groups form the tree above them.
    top = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest", F.col("depth").alias("below"))
    top = ranked(top, "tree", ["group"], f"{folder}/top")
    top.withColumn("depth", _depth(F.col("of"))).write.parquet(f"{folder}/top-ranked")
    top = spark.read.parquet(f"{folder}/top-ranked")
    root = build(top, f"{folder}/root").select("digest", "tree", "depth").first()
    none = F.array().cast("array<struct<left: string, right: string>>")
    start = spark.createDataFrame([root] if root else [], "digest string, tree string, depth int").withColumn("path", none)
    reached = descend(start, top.select("tree", "rank", "depth", "group", "below"), f"{folder}/root")
    starts = reached.select(F.col("group").alias("tree"), F.col("below").alias("depth"), "digest", "path")
    starts.write.parquet(f"{folder}/starts")
    starts = spark.read.parquet(f"{folder}/starts")

    paths = descend(starts, leaves.select("tree", "rank", "depth", "doc_id", "altered"), f"{folder}/groups")
    siblings = F.aggregate(
        F.reverse("path"), F.lit(""), lambda text, s: F.concat(text, s["left"], s["right"])
    )
    folded = fold(F.coalesce("altered", "digest"), F.col("path"))
    root = F.lit(root["digest"] if root else None).cast("string")
    return paths.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        root.alias("root"),
        digest(siblings).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
