"""Document fingerprints by consistent weighted sampling, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import ranked
from lakestrata.session import work_folder

SAMPLES = 16
#: Letters of scripts that are written without blanks: Thai to Lao, Myanmar, Khmer, ideographs with kana and Yi.
_RANGES = (
    (0x0E00, 0x0EFF),
    (0x1000, 0x109F),
    (0x1780, 0x17FF),
    (0x2E80, 0x312F),
    (0x31A0, 0xA4CF),
    (0xAA60, 0xAA7F),
    (0xF900, 0xFAFF),
    (0x20000, 0x323AF),
)
_UNSPACED = "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in _RANGES)
_LATE = rf"[\x{{{_RANGES[0][0]:x}}}-\x{{10ffff}}]"
_BETWEEN = r"[^\p{L}\p{N}\p{M}]+"
_KEY = ["k0", "h1", "h2"]
_UNIT = 1.0 / (1 << 21)


def words(text: Column) -> Column:
    """The words of a text in lower case: runs of letters, numbers and marks; may hold empty strings.

    In scripts written without blanks each letter with its marks is a word.
    """
    low = F.lower(text)
    single = rf"{_BETWEEN}|(?<=[{_UNSPACED}]\p{{M}}{{0,4}})(?=[\p{{L}}\p{{N}}])|(?<=[\p{{L}}\p{{N}}])(?=[{_UNSPACED}&&\p{{L}}])"
    return F.when(low.rlike(_LATE), F.split(low, single)).otherwise(F.split(low, _BETWEEN))


def _uniform(bits: Column, shift: int) -> Column:
    """21 bits of a hash as a number between 0 and 1."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(0x1FFFFF).cast("double") + 0.5) * F.lit(_UNIT)


def draw(sample: int | Column, term: Column, *log_weights: Column) -> list[Column]:
    """One consistent weighted sample of a term, for each of its log weights.

    r and c follow the gamma law of shape 2 and b is uniform, all made from hashes of
    the sample's number and the term. t = floor(log weight / r + b) is the step that
    the weight has reached, and the term with the least log c - r (t - b + 1)
    wins. The value has that number, 31 bits, above 32 bits that stand for term and t,
    so the least value names the winner.
    """
    one, two = F.xxhash64(F.lit(2 * sample), term), F.xxhash64(F.lit(2 * sample + 1), term)
    r = -F.ln(_uniform(one, 0) * _uniform(one, 21))
    log_c = F.ln(-F.ln(_uniform(two, 0) * _uniform(two, 21)))
    b = _uniform(one, 42)
    values = []
    for weight in log_weights:
        t = F.floor(weight / r + b)
        place = F.floor((log_c - r * (t - b + 1) + 100) * float(1 << 24))
        values.append(F.shiftleft(place, 32).bitwiseOR(one.bitwiseXOR(t).bitwiseAND(0xFFFFFFFF)))
    return values


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value.bitwiseAND(0xFFFFFFFF)), 8, "0")


def likeness(one: Column, other: Column, samples: int) -> Column:
    """The share of samples that two fingerprints have in common."""
    same = [F.substring(one, 8 * i + 1, 8) == F.substring(other, 8 * i + 1, 8) for i in range(samples)]
    return sum((s.cast("int") for s in same), F.lit(0)).cast("double") / float(samples)


def fingerprints(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The terms of a text are its words; a word weighs its occurrences times its
    letters. A fingerprint holds `samples` consistent weighted samples, eight hex
    digits each; two texts agree in a sample with a probability of their
    generalised Jaccard similarity, the sum of the smaller weights over that of the
    larger ones. The edited text has the last quarter of the code points replaced by
    the first of the next document in ascending order of the id (after the last: the first).

    Null texts are empty. A text without words is one term. Null ids come
    first; of one id's rows the order is that of their texts' hashes. Rows that are equal
    in id and text are counted, handled as one, and returned as often: the next
    document of all but the last is such a row itself. Long texts take part whole. An
    empty table gives no rows; other columns are not read.

    Texts go through one shuffle, by a hash of id and text; what a document lends to
    the one before it, and nothing else of it, through a second. Terms are then
    counted and sampled where their text lies. No key can be hot, as equal rows are put
    together before the shuffle.
    """
    spark = documents.sparkSession
    folder = work_folder(spark, "fingerprints")
    doc_id, text = F.col("doc_id"), F.col("text")
    source = documents.select(
        F.col(quoted(id_col)).alias("doc_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text")
    ).select(
        F.xxhash64(doc_id.isNull(), doc_id).alias("k0"),
        F.xxhash64(F.lit(1), text).alias("h1"),
        F.xxhash64(F.lit(2), text).alias("h2"),
        "doc_id",
        "text",
    )
    # What orders the documents: ids, hashes and lengths, no texts.
    light = source.groupBy(*_KEY, "doc_id", F.char_length(text).alias("n")).agg(F.count(F.lit(1)).alias("copies"))
    ranked(light.withColumn("all", F.lit("")), "all", ["doc_id", "h1", "h2"], f"{folder}/order").select(
        *_KEY, "doc_id", F.col("n").cast("long").alias("n"), "copies", "rank", "of"
    ).write.parquet(f"{folder}/ranked")
    order = spark.read.parquet(f"{folder}/ranked")
    take = F.shiftright("n", 2)
    following = F.when(F.col("rank") + 1 < F.col("of"), F.col("rank") + 1).otherwise(F.lit(0).cast("long"))
    owners = order.select(*(F.col(c).alias(f"o_{c}") for c in _KEY), take.alias("take"), following.alias("next"))
    lent = order.select(*_KEY, "rank").join(owners, F.col("rank") == F.col("next")).drop("rank", "next")

    texts = source.groupBy(*_KEY).agg(F.any_value("text").alias("text"))
    prefixes = texts.join(lent, _KEY).select(
        *(F.col(f"o_{c}").alias(c) for c in _KEY), F.expr("substring(text, 1, take)").alias("added")
    )
    own = order.select(*_KEY, "doc_id", "n", "copies", "rank", "of")
    both = texts.join(own, _KEY).join(prefixes, _KEY)
    # Equal rows follow each other, the last of them is followed by another document.
    variant = F.struct(F.lit(False).alias("self"), F.lit(1).cast("long").alias("times"), F.col("added").alias("added"))
    among = F.struct(
        F.lit(True).alias("self"), (F.col("copies") - 1).alias("times"), F.expr("substring(text, 1, n div 4)").alias("added")
    )
    variants = F.explode(F.when(F.col("copies") > 1, F.array(variant, among)).otherwise(F.array(variant)))
    edits = both.withColumn("v", variants).select(
        *_KEY,
        "doc_id",
        "n",
        "rank",
        "of",
        "v.self",
        "v.times",
        "text",
        F.expr("concat(substring(text, 1, cast(n - n div 4 as int)), v.added)").alias("edited"),
    )

    sides = F.array(
        F.struct(F.lit(0).alias("side"), words(F.col("text")).alias("words")),
        F.struct(F.lit(1).alias("side"), words(F.col("edited")).alias("words")),
    )
    letters = F.char_length("word")
    weighted = (
        edits.select(*_KEY, "self", F.explode(sides).alias("s"))
        .select(*_KEY, "self", "s.side", F.explode("s.words").alias("word"))
        .where("word <> ''")
        .select(*_KEY, "self", "side", F.xxhash64("word").alias("term"), letters.alias("letters"))
        .groupBy(*_KEY, "self", "term")
        .agg(
            F.sum(F.when(F.col("side") == 0, F.col("letters"))).alias("w0"),
            F.sum(F.when(F.col("side") == 1, F.col("letters"))).alias("w1"),
        )
    )
    logs = weighted.select(
        *_KEY, "self", "term", F.ln(F.col("w0").cast("double")).alias("l0"), F.ln(F.col("w1").cast("double")).alias("l1")
    )
    least = []
    for i in range(samples):
        for side, value in enumerate(draw(i, F.col("term"), F.col("l0"), F.col("l1"))):
            least.append(F.min(value).alias(f"s{side}_{i}"))
    signed = logs.groupBy(*_KEY, "self").agg(*least)
    columns = [F.concat(*(_hex(F.col(f"s{side}_{i}")) for i in range(samples))).alias(f"f{side}") for side in (0, 1)]
    signed = signed.select(*(F.col(c).alias(f"s_{c}") for c in _KEY), F.col("self").alias("s_self"), *columns)

    def print_of(side: int, text: str) -> Column:
        """A text without words is its own only term."""
        whole = F.concat(*(_hex(F.xxhash64(F.lit(i), F.col(text))) for i in range(samples)))
        return F.coalesce(F.col(f"f{side}"), whole)

    # Both sides lie by the key. As an equality, the variant would be a join key too, and texts would move again.
    same = F.when(F.col("self"), F.col("s_self")).otherwise(~F.col("s_self"))
    for c in _KEY:
        same = same & (F.col(c) == F.col(f"s_{c}"))
    edits.join(signed, same, "left").select(
        "doc_id",
        "n",
        "rank",
        "of",
        "self",
        "times",
        F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
        print_of(0, "text").alias("own"),
        print_of(1, "edited").alias("changed"),
    ).write.parquet(f"{folder}/signed")
    signed = spark.read.parquet(f"{folder}/signed")
    behind = signed.where("not self").select(
        F.when(F.col("rank") > 0, F.col("rank")).otherwise(F.col("of")).alias("behind"), F.col("own").alias("next")
    )
    near_next = F.when(F.col("self"), F.lit(1.0)).otherwise(likeness(F.col("own"), F.col("next"), samples))
    return (
        signed.join(behind, F.col("rank") + 1 == F.col("behind"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select(
            "doc_id",
            F.col("n").alias("n_chars"),
            F.col("sha").alias("edited_sha256"),
            F.col("own").alias("fingerprint"),
            F.col("changed").alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed"), samples).alias("near_edited"),
            near_next.alias("near_next"),
        )
    )
