"""Threshold-scaled document fingerprints (DataFrame operations only).

A text's five-word shingles are hashed (XXH64, signed 64-bit order). Its sketch keeps
every distinct hash in the lowest FRACTION of the hash range, and the LEAST lowest hashes
in any case, so that short texts keep all theirs. Sketches of different documents are
comparable below the lower of their two bounds, up to which each is complete; merging is
the union cut at that bound. Because the fraction is fixed, not the sketch size, a short
document's hashes are found again in a very long one that contains it: containment does
not suffer from unequal lengths.

A sketch is a struct (hashes: sorted array<bigint>, bound: bigint, complete up to there).
Its string is the hashes as 16 hex digits each, in order.

The query compares each document with an edited text and with the next document in order
of doc_id. The order comes from range partitions of (doc_id, row) with a small table of
each partition's first row for the seams; a document's text moves by one shuffle on the
row number, only the first quarter that its predecessor takes and its sketch move again.

Edge cases: null text counts as empty; a text without words has an empty fingerprint, and
two such texts have likeness 1; with fewer than five words the whole sequence is one
shingle; a very long text is hashed whole; repeated rows and equal doc_ids follow each other in row order, null doc_ids
first; a single row is its own next; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from molarflow.llm.common import checkpointed, stable_rows

SHINGLE = 5
SPACE = r"[\x20\x09-\x0D]+"
FRACTION = 1 / 8
LEAST = 64
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
THRESHOLD = LOWEST + int(FRACTION * (1 << 64))


def with_sketch(df: DataFrame, text: Column, out: str) -> DataFrame:
    """`df` and the sketch of `text` (not null) in column `out`."""
    w, h = f"__{out}_words", f"__{out}_hashes"
    df = df.withColumn(w, F.array_remove(F.split(text, SPACE), ""))
    n = F.size(w)
    windows = F.transform(F.sequence(F.lit(0), n - SHINGLE),
                          lambda i: F.xxhash64(*[F.get(F.col(w), i + d) for d in range(SHINGLE)]))
    hashes = F.when(n >= SHINGLE, windows).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))) \
        .otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(h, F.sort_array(F.array_distinct(hashes)))
    kept = F.when(F.size(h) <= LEAST, F.col(h)).otherwise(F.filter(h, lambda x, i: (i < LEAST) | (x < THRESHOLD)))
    df = df.withColumn(h, F.struct(kept.alias("hashes"), (F.size(kept) == F.size(h)).alias("whole")))
    bound = F.when(F.col(f"{h}.whole"), HIGHEST).otherwise(F.greatest(F.lit(THRESHOLD - 1), F.element_at(f"{h}.hashes", -1)))
    return df.withColumn(out, F.struct(F.col(f"{h}.hashes").alias("hashes"), bound.alias("bound"))).drop(w, h)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts together."""
    bound = F.least(a["bound"], b["bound"])
    both = F.sort_array(F.array_union(a["hashes"], b["hashes"]))
    return F.struct(F.filter(both, lambda x: x <= bound).alias("hashes"), bound.alias("bound"))


def _shares(a: Column, b: Column) -> tuple[Column, Column, Column]:
    bound = F.least(a["bound"], b["bound"])
    x, y = (F.when(s["bound"] == bound, s["hashes"]).otherwise(F.filter(s["hashes"], lambda v: v <= bound)) for s in (a, b))
    return F.size(x), F.size(y), F.size(F.array_intersect(x, y))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all shingles of both (0 to 1)."""
    x, y, common = _shares(a, b)
    return F.when(x + y > 0, common / (x + y - common)).otherwise(F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 1 if a has none, 0 if none of a's is comparable."""
    x, _, common = _shares(a, b)
    return F.when(x > 0, common / x).otherwise((F.size(a["hashes"]) == 0).cast("double"))


def as_string(sketch: Column) -> Column:
    return F.lower(F.array_join(F.transform(sketch["hashes"], lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def followers(rows: DataFrame) -> DataFrame:
    """(row, next_row) for a materialised table (doc_id, row): the next row in order of (doc_id, row), after the last the first."""
    dealt = checkpointed(rows.select("doc_id", "row").repartitionByRange("doc_id", "row")
                         .select("*", F.spark_partition_id().alias("part")))
    first = dealt.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row")).alias("first"))
    seam = Window.orderBy("part")  # one row per partition
    all_parts = seam.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seams = first.select("part", F.coalesce(F.lead("first.row").over(seam), F.first("first.row").over(all_parts)).alias("after"))
    inner = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "row")
    return (dealt.select("row", "part", F.lead("row").over(inner).alias("inside")).join(seams, "part")
            .select("row", F.coalesce("inside", "after").alias("next_row")))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and its edited text, and their likeness to each other and to the next document."""
    docs = stable_rows(docs, "documents")
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = checkpointed(texts.select("doc_id", "row", F.length("text").alias("n")))
    taken = (followers(sizes).join(sizes.select("row", "n"), "row")
             .select(F.col("next_row").alias("row"), F.col("row").alias("before"), F.floor(F.col("n") / 4).cast("int").alias("q")))
    taken = checkpointed(taken)
    given = with_sketch(texts.join(taken, "row"), F.col("text"), "next_sketch").select(
        F.col("before").alias("row"), F.col("doc_id").alias("next_doc_id"), "q", F.col("text").substr(F.lit(1), F.col("q")).alias("head"),
        "next_sketch")
    both = texts.join(given, "row")
    both = both.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), F.length("text") - F.col("q")), "head"))
    both = with_sketch(both, F.col("text"), "sketch")
    both = with_sketch(both, F.col("edited"), "edited_sketch")
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(own).alias("fingerprint"), as_string(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, following).alias("near_next"),
        containment(own, edited).alias("kept_in_edited"), "next_doc_id")
