"""Document fingerprints: bottom-k sketches of word shingle hashes, by
DataFrame functions alone.

A sketch is the sorted array of the k smallest distinct 48-bit hashes of a
text's shingles of five lower-cased words (fewer words are one shingle).
Sketches of parts merge into the sketch of the whole; two sketches estimate
resemblance and containment, one the number of distinct shingles.

The next document in descending doc_id order is found without one global
sort: documents are dealt into ranges of doc_id (bounds are quantiles, their
number a multiple of the shuffle partitions), the first document of each
range is copied to the end of the range above, and a window over the range
does the rest.

Defined results: null and empty texts have the empty sketch, which resembles
itself with 1 and any other with 0; null ids come last in the order; rows of
one id are ordered by their text's hash; one document follows itself; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from elcorpus.llm.common import shuffle_parts

K = 256
WORDS = 5
HASH_BITS = 48
#: Ranges of doc_id for each shuffle partition.
RANGES = 6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The bottom-k sketch of a text (array<bigint>)."""
    tokens = F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    # one-element arrays bind the word hashes and their number once
    bound = F.transform(F.array(hashes), lambda h: F.when(F.size(h) >= words, F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - (words - 1), F.lit(1))), lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i - 1 + j) for j in range(words)]), 64 - HASH_BITS))).when(F.size(h) > 0, F.array(F.shiftrightunsigned(F.xxhash64(h), 64 - HASH_BITS))).otherwise(F.array().cast("array<bigint>")))
    return bottom(F.element_at(bound, 1), k)


def bottom(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct hashes of an array."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_groups(rows: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of sketches: hashes are made distinct before
    they are ranked, in salted groups first, so a group of any size keeps k
    hashes for each salt."""
    each = rows.select(*by, F.explode(column).alias("_h")).distinct()
    salts = shuffle_parts(rows.sparkSession)
    each = each.withColumn("_s", F.pmod(F.xxhash64("_h"), F.lit(salts)))
    for keys in ([*by, "_s"], list(by)):
        each = each.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).where(F.col("_r") <= k).drop("_r")
    return each.groupBy(*by).agg(F.array_sort(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's sketch in both."""
    union = merged(a, b, k)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.greatest(F.size(union), F.lit(1)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below k)."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (F.element_at(a, -1) / F.lit(float(1 << HASH_BITS))))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds."""
    j = resemblance(a, b, k)
    shared = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as fixed-width lower-case hexadecimal numbers."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), HASH_BITS // 4, "0"))), "")


def with_next(docs: DataFrame, ranges: int) -> tuple[DataFrame, Column]:
    """Rows (part, copy, doc_id, o, t, text) in ranges of doc_id, each range
    ending with a copy of the document that follows; and the order."""
    o = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"o": o, "t": F.xxhash64("text")})
    bounds = docs.agg(F.percentile_approx("o", [x / ranges for x in range(1, ranges)], 100 * ranges).alias("b")).first()["b"]
    edges = sorted(set(bounds or []))
    docs = docs.withColumn("part", _range_of(edges))
    # the first document of each range: at most `ranges` rows of numbers
    tops = docs.groupBy("part").agg(F.max("o").alias("o")).orderBy("part").collect()
    above = {r["o"]: tops[(i + 1) % len(tops)]["part"] for i, r in enumerate(tops)}
    if tops:
        first = F.create_map(*[F.lit(x) for k, v in above.items() for x in (k, v)])
        to = F.element_at(first, F.col("o"))
        docs = docs.select("*", F.explode(F.when(F.col("o").isin(*above), F.array(F.lit(None).cast("int"), to)).otherwise(F.array(F.lit(None).cast("int")))).alias("to"))
    else:
        docs = docs.withColumn("to", F.lit(None).cast("int"))
    docs = docs.select(F.coalesce("to", "part").alias("part"), F.col("to").isNotNull().alias("copy"), "doc_id", "o", "t", "text")
    return docs, Window.partitionBy("part").orderBy("copy", F.desc("o"), "t")


def _range_of(edges: list[int]) -> Column:
    """The number of the range of ``o`` between sorted bounds."""
    bits = max(1, len(edges).bit_length())
    bounds = F.lit(edges) if edges else F.array().cast("array<bigint>")
    # a binary search: each step goes on if the bound there is smaller
    return F.aggregate(F.lit([1 << b for b in reversed(range(bits))]), F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < F.col("o"), at + step).otherwise(at))


def fingerprints(documents: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: sketches of its text and of its edited text (the
    last half replaced by the first half of the next document), and how much
    they resemble each other and the next document's."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, order = with_next(docs, max(2, RANGES * shuffle_parts(documents.sparkSession)))
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("own", sketch(F.col("text"), k))
    rows = rows.withColumn("next_own", F.lead("own").over(order)).where(~F.col("copy"))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "own", "next_own", sketch(F.col("edited"), k).alias("edited_own"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited_own")).alias("edited_fingerprint"), resemblance(F.col("own"), F.col("edited_own"), k).alias("near_edited"), resemblance(F.col("own"), F.col("next_own"), k).alias("near_next"), distinct_shingles(F.col("own"), k).alias("n_shingles_estimate"))
