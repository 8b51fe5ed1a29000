"""Which values break a suite's rules, and how often."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.quality.expectations import Expectation
from lakestrata.quality.suite import _find, suite_name

#: Values a rule's summary keeps. Its counts are then off by at most 3.5 / 16384 of the rows that break the rule.
TRACKED = 10_000
_MAP_SIZE = 1 << 14
_SHARES = 64
_OUTPUT = "table string, suite string, expectation string, column string, rank long, value string, n_rows long"


def _broken(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """rule, value: a row for each value that breaks a rule; rules of types and keys, and of absent columns, have none."""
    found = []
    for i, expectation in enumerate(suite):
        name = _find(df, expectation.column)
        if name is None or expectation.broken is None or expectation.name == "expect_column_values_to_be_of_type":
            continue
        value = F.col(quoted(name))
        breaks = value.isNotNull() & expectation.broken(df, name)
        found.append(F.when(breaks, F.struct(F.lit(i).alias("rule"), value.cast("string").alias("value"))))
    if not found:
        return df.sparkSession.createDataFrame([], "rule int, value string")
    return df.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select("x.*")


def _ranked(counts: DataFrame, top: int) -> DataFrame:
    """The `top` of each rule; first those of each share of its values, so that no task ranks them all."""
    order = [F.desc("n_rows"), F.asc("value")]
    share = F.pmod(F.xxhash64("value"), F.lit(_SHARES))
    for keys in (["rule", share], ["rule"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
        counts = counts.withColumn("rank", place).where(F.col("rank") <= top)
    return counts


def unexpected_values(
    df: DataFrame, suite: Sequence[Expectation], table: str, top: int = 20, tracked: int = TRACKED
) -> DataFrame:
    """The `top` most frequent values that break each row-wise rule: rank by number of rows, then by value.

    Counts are exact. One pass keeps a mergeable summary of frequent values a rule,
    of at most `tracked` values each, so what is shuffled does not grow with the
    table; a second pass counts only the values of the summaries. A summary may miss a
    value that is rarer than its error bound. Where the last rank found is not
    clearly above that bound (values hardly repeat), that rule's values are counted in full,
    by a shuffle of one row a value and task.
    """
    spark = df.sparkSession
    if not 0 < top <= tracked <= TRACKED:
        raise ValueError(f"0 < top <= tracked <= {TRACKED}")
    broken = _broken(df, suite)
    sketches = broken.groupBy("rule").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(value, {tracked}, {tracked})").alias("found")
    )
    seen = sketches.select("rule", "n", F.transform("found", lambda x: x["item"]).alias("values")).collect()
    if not seen:
        return spark.createDataFrame([], _OUTPUT)
    # At most `tracked` values a rule, which the rows that hold them meet in a broadcast.
    candidates = spark.createDataFrame([(r.rule, r["values"]) for r in seen], "rule int, values array<string>")
    candidates = candidates.select("rule", F.explode("values").alias("value"))
    counted = broken.join(F.broadcast(candidates), ["rule", "value"], "left_semi").groupBy("rule", "value")
    best = _ranked(counted.agg(F.count(F.lit(1)).alias("n_rows")), top).collect()
    unsure = []
    for r in seen:
        own = [b.n_rows for b in best if b.rule == r.rule]
        # Without more values than it can keep, a summary is exact.
        bound = 0 if r.n <= tracked else 3.5 * r.n / _MAP_SIZE
        if bound and (len(own) < top or min(own) <= bound):
            unsure.append(r.rule)
    rows = [b for b in best if b.rule not in unsure]
    if unsure:
        whole = broken.where(F.col("rule").isin(unsure)).groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n_rows"))
        rows += _ranked(whole, top).collect()
    out = [
        (table, suite_name(table), suite[r.rule].name, suite[r.rule].column, r["rank"], r.value, r.n_rows)
        for r in sorted(rows, key=lambda r: (r.rule, r["rank"]))
    ]
    return spark.createDataFrame(out, _OUTPUT)
