"""Near-duplicates by DartMinHash signatures, banded joining and exact checks of the candidates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import small_batches
from lakestrata.llm.shingles import mix, weighted_shingles
from lakestrata.session import work_folder

#: Values of a signature and of a band: texts of similarity 0.8 share a band with probability 0.9999.
SIGNATURE, BAND = 120, 5
#: A pair is compared in full if its signatures agree at no less than the threshold minus this.
SLACK = 0.16
#: About so many members on each side of a cell, and bytes of cells that a task compares at a time.
CELL, GROUP = 256, 4 << 20
_CHUNK = 1 << 18
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Up to so many darts fall on a unit of area; more has a probability below 2 ** -64.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(21)])


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)) * (1.0 / (1 << 53))


def dart_minhash(elements: np.ndarray, weights: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """The signature (unsigned 64-bit) of a weighted set; two agree at a place with their weighted Jaccard similarity.

    Every element has a strip of the plane, as wide as its weight and endless in
    rank. Each unit square of it gets a Poisson number of darts from a generator
    seeded by element and square, so all sets see the same darts. Those within the
    weight and below a rank that lets about size * (ln size + 2) darts through
    are dealt to the places by hash; each place keeps its dart of lowest rank. If
    a place stays empty, the rank is doubled, which changes no place that is full.
    """
    keep = weights > 0
    elements, weights = elements[keep], weights[keep].astype(float)
    if not len(elements):
        return np.zeros(size, np.uint64)
    limit = size * (math.log(size) + 2) / weights.sum()
    while True:
        lowest, darts = np.full(size, np.inf), np.zeros(size, np.uint64)
        blocks = math.ceil(limit)
        across = np.ceil(weights).astype(np.int64)
        squares = across * blocks
        cuts = np.searchsorted(np.cumsum(squares), np.arange(_CHUNK, squares.sum(), _CHUNK)) + 1
        for some in np.split(np.arange(len(elements)), np.unique(cuts)):
            if not len(some):
                continue
            own = np.repeat(some, squares[some])
            number = np.arange(len(own)) - np.repeat(np.cumsum(squares[some]) - squares[some], squares[some])
            column, row = number // blocks, number % blocks
            seed = mix(elements[own] + mix(column.astype(np.uint64) << np.uint64(32) | row.astype(np.uint64)))
            count = np.searchsorted(_POISSON, _unit(seed))
            at = np.repeat(np.arange(len(own)), count)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            dart = mix(seed[at] + _GOLD * (nth + 1).astype(np.uint64))
            rank = row[at] + _unit(dart)
            other = mix(dart ^ _GOLD)
            hit = (rank < limit) & (column[at] + _unit(other) < weights[own[at]])
            rank, dart = rank[hit], dart[hit]
            place = (mix(dart + _GOLD) % np.uint64(size)).astype(np.int64)
            order = np.lexsort((dart, rank))
            found, first = np.unique(place[order], return_index=True)
            best = order[first]
            better = rank[best] < lowest[found]
            lowest[found[better]] = rank[best[better]]
            darts[found[better]] = dart[best[better]]
        if np.isfinite(lowest).all():
            return darts
        limit *= 2


def bands(signature: np.ndarray, rows: int = BAND) -> np.ndarray:
    """One hash (signed 64-bit) per run of `rows` values, different for every run."""
    parts = signature[: len(signature) // rows * rows].reshape(-1, rows)
    out = np.arange(len(parts), dtype=np.uint64)
    for i in range(rows):
        out = mix(out * _GOLD + parts[:, i])
    return out.view(np.int64)


def marks(signature: np.ndarray) -> bytes:
    """16 bits of each value: two signatures agree where their marks do, but for one case in 65,536."""
    return (mix(signature) >> np.uint64(48)).astype("<u2").tobytes()


def expanded(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A multiset as an ascending set of 32-bit numbers, one for each copy of each element."""
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.unique((mix(np.repeat(elements, counts) + _GOLD * nth.astype(np.uint64)) >> np.uint64(32)).astype("<u4"))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity of two ascending sets: the weighted one of the multisets they were."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int((b[at] == a).sum())
    return shared / (len(a) + len(b) - shared)


def _key(text: Column) -> Column:
    """128 bits of the text's SHA-256; equal texts are one node."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


_SKETCH = "key binary, bands array<long>, marks binary, runs binary"


def _sketch(words: int, size: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, tuple] = {}
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key not in seen:
                    elements, counts = weighted_shingles(text.as_py(), words)
                    signature = dart_minhash(elements, counts, size)
                    seen[key] = bands(signature, rows), marks(signature), expanded(elements, counts).tobytes()
            columns = zip(*seen.values(), strict=True) if seen else [()] * 3
            kinds = [pa.list_(pa.int64()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), *map(pa.array, columns, kinds)], ["key", "bands", "marks", "runs"]
            )

    return sketch


def _verify(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                similarity(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")) >= threshold
                for x, y in zip(batch.column("runs_a").to_pylist(), batch.column("runs_b").to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return verify


def _compare(threshold: float, least: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the members of each cell, its strangers on one side and all its members on the other."""
        found: list[tuple[bytes, bytes]] = []
        rows = rows.sort_values(["bucket", "own", "other"], kind="stable")
        cell = rows[["bucket", "own", "other"]].to_numpy()
        cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
        for part in np.split(np.arange(len(rows)), cuts):
            here = rows.iloc[part]
            stranger = here["stranger"].to_numpy()
            if not stranger.any() or stranger.all():
                continue
            mine, all_ = here[stranger], here[~stranger]
            keys, roots, runs = (all_[c].to_numpy() for c in ("key", "root", "runs"))
            sketches = np.frombuffer(b"".join(all_["marks"]), "<u2").reshape(len(all_), -1)
            joined: dict[bytes, bytes] = {}  # roots met here

            def top(root: bytes) -> bytes:
                while root in joined:
                    root = joined[root]
                return root

            for key, root, run, mark in mine[["key", "root", "runs", "marks"]].itertuples(index=False):
                share = (sketches == np.frombuffer(mark, "<u2")).mean(axis=1)
                own = np.frombuffer(run, "<u4")
                for i in np.flatnonzero((share >= least) & (roots != root)):
                    x, y = top(root), top(roots[i])
                    if x != y and similarity(own, np.frombuffer(runs[i], "<u4")) >= threshold:
                        joined[max(x, y)] = min(x, y)
                        found.append((min(key, keys[i]), max(key, keys[i])))
        return pd.DataFrame(found, columns=["a", "b"])

    return compare


def _links(
    spark: SparkSession, texts: DataFrame, folder: str, words: int, threshold: float, size: int, rows: int
) -> DataFrame:
    """Key and root of every text that is linked to another one."""
    texts.mapInArrow(_sketch(words, size, rows), _SKETCH).write.parquet(f"{folder}/sketches")
    sketches = spark.read.parquet(f"{folder}/sketches")
    members = sketches.select("key", "bands").dropDuplicates(["key"]).select("key", F.explode("bands").alias("bucket"))
    # The smallest key leads one half of the buckets, the largest the other.
    ends = members.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high")
    leaders = ends.select("bucket", F.when(F.col("bucket") % 2 == 0, F.col("low")).otherwise(F.col("high")).alias("leader"))
    members.join(leaders, "bucket").write.parquet(f"{folder}/live")
    live = spark.read.parquet(f"{folder}/live")
    # Only texts that share a band with another one are compared.
    suspects = live.select("key").distinct()
    sketches.join(suspects, "key", "left_semi").dropDuplicates(["key"]).select("key", "marks", "runs").write.parquet(
        f"{folder}/sets"
    )
    sets = spark.read.parquet(f"{folder}/sets")

    met = live.where("key <> leader")
    pairs = met.select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("runs").alias("runs_a")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("runs").alias("runs_b")), "b"
    )
    both.mapInArrow(_verify(threshold), "a binary, b binary").write.parquet(f"{folder}/links-first")
    first = spark.read.parquet(f"{folder}/links-first")
    roots = _components(spark, first, f"{folder}/first")

    # Members of a bucket outside its most frequent component are compared with all others of it.
    placed = live.select("bucket", "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    placed.write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")
    homes = (
        placed.groupBy("bucket", "root")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket")
        .agg(F.max(F.struct("n", "root")).alias("home"), F.sum("n").alias("n"))
        .where("home.n < n")
        .select(
            "bucket",
            F.col("home.root").alias("home"),
            F.ceil(F.col("n") / CELL).alias("n_other"),
            F.ceil((F.col("n") - F.col("home.n")) / CELL).alias("n_own"),
        )
    )
    split = placed.join(homes, "bucket")
    block = lambda n: F.pmod(F.xxhash64("key"), n)
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    kept = ["bucket", "key", "root"]
    strangers = split.where("root <> home").select(
        *kept, F.lit(True).alias("stranger"), block(F.col("n_own")).alias("own"), all_of(F.col("n_other")).alias("other")
    )
    others = split.select(
        *kept, F.lit(False).alias("stranger"), all_of(F.col("n_own")).alias("own"), block(F.col("n_other")).alias("other")
    )
    strangers.unionByName(others).write.parquet(f"{folder}/cells")
    cells = spark.read.parquet(f"{folder}/cells")
    sizes = sets.select("key", (F.octet_length("runs") + F.octet_length("marks") + 64).alias("size"))
    total = cells.join(sizes, "key").agg(F.sum("size")).first()[0] or 0
    groups = -(-total // GROUP) or 1
    cells.join(sets, "key").withColumn("group", F.pmod(F.xxhash64("bucket", "own", "other"), F.lit(groups))).groupBy(
        "group"
    ).applyInPandas(_compare(threshold, threshold - SLACK), "a binary, b binary").write.parquet(f"{folder}/links-second")
    second = spark.read.parquet(f"{folder}/links-second")
    if second.isEmpty():
        return roots
    return _components(spark, first.unionByName(second), f"{folder}/second")


def _components(spark: SparkSession, links: DataFrame, folder: str) -> DataFrame:
    """Key and root (its smallest connected key) of every linked key, by alternating large and small stars."""
    step = 0
    links.select(F.col("b").alias("u"), F.col("a").alias("v")).distinct().write.parquet(f"{folder}/edges-0")
    edges, before = spark.read.parquet(f"{folder}/edges-0"), None
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    while (now := tuple(edges.agg(F.count(F.lit(1)), mark).first())) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Larger neighbours go to the smallest of the neighbourhood.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("v < u")
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        # So do the smaller ones, and the key itself.
        own, neighbour = F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        small = (
            down.join(lowest, "u")
            .select(F.explode(F.array(own, neighbour)).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        step += 1
        small.write.parquet(f"{folder}/edges-{step}")
        edges = spark.read.parquet(f"{folder}/edges-{step}")
    return edges.groupBy(F.col("u").alias("key")).agg(F.min("v").alias("root"))


def near_duplicates(
    df: DataFrame,
    threshold: float = 0.8,
    words: int = 5,
    size: int = SIGNATURE,
    rows: int = BAND,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """One row per row of `df`: doc_id, class_id, class_size, kept.

    Texts are alike if the multisets of their word runs have a weighted Jaccard
    similarity of at least `threshold`; classes are what such links connect.
    class_id is the smallest id of the class, whose row is `kept` (one row, if
    several have that id; a null id only if all are null). `carry` adds the whole
    source row as the struct `row`. Equal texts are one node and never make pairs;
    a null text is empty. Texts of fewer than `words` words are one run of all
    they have, so they are alike only if their words are equal; a text without
    words equals any other such. An empty table gives no rows; other columns are
    read only for `carry`.

    Texts that share a band are candidates. Each bucket first compares its members
    with one leader. What those links connect needs no more comparing among
    itself, so of each bucket only the members outside its most frequent component
    are then compared with all others of it, in cells of bounded size: no bucket is
    gathered, capped or spelt out in pairs, and no link between two classes is
    missed within a bucket. Signatures sort out pairs whose agreement is more than
    four standard deviations below the threshold; each link is checked on the
    runs of both whole texts. The steps write to the shared folder, so nothing is
    computed twice and a lost executor costs its tasks only.
    """
    spark = df.sparkSession
    small_batches(spark)
    folder = work_folder(spark, "near-dup")
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    texts = df.select(_key(text).alias("key"), text.alias("text"))
    roots = _links(spark, texts, folder, words, threshold, size, rows)
    carried = [F.struct(*(F.col(quoted(c)) for c in df.columns)).alias("row")] if carry else []
    named = (
        df.select(
            F.col(quoted(id_col)).alias("doc_id"),
            _key(text).alias("key"),
            F.monotonically_increasing_id().alias("place"),
            *carried,
        )
        .join(roots, "key", "left")
        .withColumn("class", F.coalesce("root", "key"))
        .drop("key", "root")
    )
    # Both sides of the last join read one table, so that equal rows have one place.
    named.write.parquet(f"{folder}/named")
    named = spark.read.parquet(f"{folder}/named")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place")
    classes = spark.read.parquet(f"{folder}/named").groupBy("class").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("class_size"))
    return named.join(classes, "class").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("place") == F.col("first.place")).alias("kept"),
        *(["row"] if carry else []),
    )
