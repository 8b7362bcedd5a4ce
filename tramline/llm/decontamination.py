"""Documents that contain benchmark items.

Method: size-partitioned MinHash containment search. Texts are sets of five-word
shingles, lower case. An item of n shingles is contained in a document if at
least ``share`` of them are in the document's set, however long that is. Then
of any ``n - ceil(share * n) + 1`` of its shingles one at least is in the
document. An item's sketch is that many of its least hashes, so a document that
contains the item meets its sketch for certain: candidates are never missed.

Items are partitioned by size, a class for each power of two. A class has a
threshold, the greatest hash in its sketches; a document's MinHash sketch for a
class is its hashes up to that threshold, so a short item does not lengthen the
sketches for others. Sketches meet in an equality join on class and hash, and the
candidates are verified by the shingles themselves.

Only DataFrame expressions run. The index of sketches is a written table, so
Spark broadcasts it if its size is below the threshold and shuffles both sides
otherwise, where a shingle that very many documents hold may be split. The
result has a row for each document and item it contains; an item that a third
of all documents hold gives as many rows, not their square.

Defined results: a NULL or blank text has no shingles; a text of fewer than
five words is one shingle of all its words. An item without shingles is in no
document. Rows without id are not looked at. Rows that repeat an id stand for
one document or item each, and a pair is named once, with its best share.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.session import scratch_dir

SIZE = 5
SHARE = 0.8


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _spans(parts: Column, size: int, join) -> Column:
    """``join`` of each run of ``size`` elements, or of all if there are fewer."""
    count = F.size(parts)
    first = F.transform(F.sequence(F.lit(0), count - size), lambda i: join(parts, i))
    return F.when(count >= size, first).when(count > 0, F.array(join(parts, None))).otherwise(F.array())


def shingles(parts: Column, size: int = SIZE) -> Column:
    """The distinct shingles of an array of words."""

    def join(p, i):
        return F.array_join(p if i is None else F.slice(p, i + 1, size), " ")

    return F.array_distinct(_spans(parts, size, join))


def hashes(numbers: Column, size: int = SIZE) -> Column:
    """A 64-bit hash of each shingle, from the hashes of its words."""

    def join(p, i):
        if i is None:
            return F.aggregate(p, F.lit(0).cast("long"), lambda s, x: F.xxhash64(s, x))
        return F.xxhash64(*[F.get(p, i + k) for k in range(size)])

    return _spans(numbers, size, join)


def word_numbers(parts: Column) -> Column:
    return F.transform(parts, lambda w: F.xxhash64(w))


def _index(items: DataFrame, size: int, share: float) -> DataFrame:
    """``item_id, n, size_class, h``: the least hashes of each item's shingles."""
    known = items.where("item_id IS NOT NULL").select(
        F.col("item_id").cast("long"), words(F.col("text").cast("string")).alias("words")
    )
    known = known.select("item_id", "words", word_numbers(F.col("words")).alias("numbers")).select(
        "item_id",
        F.size(shingles(F.col("words"), size)).alias("n"),
        F.array_sort(F.array_distinct(hashes(F.col("numbers"), size))).alias("h"),
    )
    least = (F.col("n") - F.ceil(F.col("n") * F.lit(share) - 1e-9) + 1).cast("int")
    return known.select(
        "item_id",
        "n",
        F.floor(F.log2("n")).cast("int").alias("size_class"),
        F.explode_outer(F.slice("h", F.lit(1), least)).alias("h"),
    ).where("h IS NOT NULL").distinct()


def dealt(hashes: DataFrame, classes: list[tuple[int, int]]) -> DataFrame:
    """``hashes(doc_id, h)`` with a row for each size class whose threshold ``h`` does not exceed."""
    kind = "array<struct<size_class: int, threshold: bigint>>"
    known = F.array(*(F.struct(F.lit(c), F.lit(most).cast("long")) for c, most in sorted(classes))).cast(kind)
    own = F.explode(F.filter(known, lambda c: c.threshold >= F.col("h"))).alias("own")
    return hashes.select("doc_id", "h", own).select("doc_id", "h", "own.size_class")


def contained_items(docs: DataFrame, items: DataFrame, size: int = SIZE, share: float = SHARE) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` of all items in ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    home = scratch_dir(spark, "sketches")
    _index(items, size, share).write.parquet(home)
    index = spark.read.schema("item_id long, n int, size_class int, h long").parquet(home)
    # One row for each power of two, whatever the number of items.
    classes = index.groupBy("size_class").agg(F.max("h").alias("threshold")).collect()
    most = max((c.threshold for c in classes), default=None)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL")
    marks = scratch_dir(spark, "candidates")
    # One step a column: an expression inside a lambda would be computed for every element. The
    # outer form of explode keeps the optimizer from computing the hashes a second time in a filter.
    found = texts.select("doc_id", word_numbers(words(F.col("text"))).alias("numbers"))
    found = found.select("doc_id", hashes(F.col("numbers"), size).alias("h"))
    found = found.select("doc_id", F.explode_outer("h").alias("h")).where(F.col("h") <= F.lit(most).cast("long"))
    found = dealt(found, [(c.size_class, c.threshold) for c in classes])
    (
        found.join(index.select("size_class", "h", "item_id"), ["size_class", "h"])
        .select("doc_id", "item_id")
        .distinct()
        .write.parquet(marks)
    )
    pairs = spark.read.schema("doc_id long, item_id long").parquet(marks)
    asked = items.select(F.col("item_id").cast("long"), words(F.col("text").cast("string")).alias("words"))
    asked = asked.select("item_id", shingles(F.col("words"), size).alias("item_shingles"))
    near = texts.join(pairs.select("doc_id").distinct(), "doc_id").select("doc_id", words(F.col("text")).alias("words"))
    near = near.select("doc_id", shingles(F.col("words"), size).alias("doc_shingles"))
    shared = F.size(F.array_intersect("item_shingles", "doc_shingles"))
    return (
        pairs.join(near, "doc_id")
        .join(asked, "item_id")
        .select("doc_id", "item_id", F.size("item_shingles").cast("long").alias("n_shingles"), shared.cast("long").alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .where(F.col("containment") >= share)
        .groupBy("doc_id", "item_id")
        .agg(F.max_by(F.struct("n_shingles", "n_shared", "containment"), F.struct("containment", "n_shingles")).alias("best"))
        .select("doc_id", "item_id", "best.*")
    )
