"""Bottom-k sketches of word-shingle hashes, in DataFrame functions alone.

A document's shingles are its `words` consecutive words (five by default; a shorter text is one shingle, a
text without words has none). Its sketch is the k smallest distinct 64-bit hashes. Sketches of parts merge
into the sketch of the whole: the k smallest of their union. From two sketches follow estimates of
resemblance (shared among the k smallest of the union), containment and the number of distinct shingles
((k - 1) over the k-th smallest hash as a share of the range; exact below k).

Defined results: null text is empty; texts without words have empty sketches, resemblance 1 to another
empty one and 0 to any other; rows are treated one by one; a table's other columns are kept or
ignored, never read; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 64
WORDS = 5
#: Documents of one bucket of `with_next`.
BUCKET_ROWS = 2_000
#: Up to so many buckets their first ids (8 bytes each) are broadcast, so the texts stay where they are.
MAX_BROADCAST_BUCKETS = 1_000_000
_SPACE = "[\\x20\\x09-\\x0D]+"


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The k smallest distinct shingle hashes of a text, ascending. Words are hashed once; a
    shingle's hash is made of its words' hashes."""
    hashed = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))
    # one `let` by transform over a single-element array, so that the word hashes are computed once
    shingles = F.element_at(
        F.transform(
            F.array(hashed),
            lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
            .when(F.size(h) < words, F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x))))
            .otherwise(F.transform(F.sequence(F.lit(1), F.size(h) - (words - 1)), lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(words)]))),
        ),
        1,
    )
    return F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(rows: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """The sketch of all rows of each key. Each step keeps k hashes at most, also on the map side:
    the hashes are first thinned to each key's k smallest per partition and salt, then per key."""
    hashes = rows.select(*by, F.explode(column).alias("hash")).distinct()
    least = lambda df, keys: df.groupBy(*keys).agg(F.sort_array(F.collect_set("hash")).alias("all")).select(*keys, F.slice("all", 1, k).alias(column))
    salted = least(hashes.withColumn("salt", F.pmod(F.xxhash64("hash"), F.lit(64))), [*by, "salt"])
    return least(salted.select(*by, F.explode(column).alias("hash")), by)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two sketches."""
    union = merged(a, b, k)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact for fewer than k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too: resemblance times the union's size over a's size."""
    union = distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), resemblance(a, b, k) * union / distinct_shingles(a, k)))


def text_form(a: Column) -> Column:
    """A sketch as text: its hashes in hex, side by side."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _limits(source: DataFrame, segments: int = 64) -> list[int]:
    """Approximate percentiles of doc_id: a fixed number of limits, whatever the table."""
    found = source.agg(F.percentile_approx("doc_id", [i / segments for i in range(segments + 1)], 10_000).alias("p")).first()["p"]
    return sorted(set(found or []))


def _bucket(value: Column, limits: list[int], per_segment: int) -> Column:
    """Number of a doc_id's bucket, larger ids first: the segment between two limits (found by a binary
    search written as an expression) and, within it, one of per_segment parts of equal width."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            low, high = limits[lo], limits[min(lo + 1, len(limits) - 1)]
            part = ((value - F.lit(low)) * F.lit(per_segment / max(1, high - low))).cast("long")
            return F.lit(lo * per_segment) + F.greatest(F.lit(0), F.least(F.lit(per_segment - 1), part))
        middle = (lo + hi + 1) // 2
        return F.when(value < limits[middle], search(lo, middle - 1)).otherwise(search(middle, hi))

    return -search(0, max(0, len(limits) - 1))


def with_next(docs: DataFrame, extra: dict[str, Column] | None = None, id_column: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, text, extra columns, next: struct of the same): the next document in descending doc_id;
    after the last comes the first. Rows of equal doc_id follow one another in order of their text; a null
    doc_id has no next document (null).

    `extra` are expressions over doc_id and text. The texts are shuffled once, to buckets of ids, and
    ordered within a bucket; only the first row of each bucket is also fetched for the bucket before.
    The order of the buckets themselves is found in two levels, so no task sees more than a thousandth
    of them but the last, which sees a thousandth.
    """
    extra = extra or {}
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    limits = _limits(source) or [0]
    per_segment = max(1, -(-source.count() // (bucket_rows * len(limits))))
    known = F.col("doc_id").isNotNull()
    numbered = source.withColumn("bucket", F.when(known, _bucket(F.col("doc_id"), limits, per_segment)).otherwise(F.lit(1) + F.pmod(F.xxhash64("text"), F.lit(1 << 20))))
    fields = ["doc_id", "text", *extra]
    own = Window.partitionBy("bucket").orderBy(F.desc("doc_id"), F.asc("text"))
    rows = numbered.select("*", *(c.alias(n) for n, c in extra.items()))
    rows = rows.select("*", F.lead(F.struct(*fields)).over(own).alias("follower"))

    heads = numbered.where(known).groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    group = F.floor(F.col("bucket") / 1024)
    within = heads.select("bucket", group.alias("group"), F.lead("bucket").over(Window.partitionBy(group).orderBy("bucket")).alias("after"))
    groups = within.groupBy("group").agg(F.min("bucket").alias("first"))
    ring = groups.select("group", F.coalesce(F.lead("first").over(Window.orderBy("group")), F.min("first").over(Window.partitionBy(F.lit(0)))).alias("first_after"))
    links = within.join(ring, "group").select("bucket", F.coalesce("after", "first_after").alias("after"))
    ids = heads.select("doc_id")  # a row per bucket, whose number is known
    ids = F.broadcast(ids) if per_segment * len(limits) <= MAX_BROADCAST_BUCKETS else ids
    head_rows = numbered.join(ids, "doc_id", "left_semi").groupBy("bucket", "doc_id").agg(F.min("text").alias("text"))
    head_rows = head_rows.select(F.col("bucket").alias("after"), "doc_id", "text").select("after", F.struct("doc_id", "text", *(c.alias(n) for n, c in extra.items())).alias("head"))
    rows = rows.join(links.join(head_rows, "after").select("bucket", "head"), "bucket", "left")
    return rows.select(*fields, F.when(known, F.coalesce("follower", "head")).alias("next"))


def edited(text: Column, other: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many of the other."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(F.coalesce(other, F.lit("")), F.lit(1), half))


def compare_neighbours(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, the fingerprints of the text and of its edited form, their
    likeness, and that to the next document's fingerprint, with estimates of containment and size."""
    rows = with_next(docs, {"sketch": sketch(F.col("text"), k, words)})
    rows = rows.select("*", edited(F.col("text"), F.col("next.text")).alias("edited"))
    rows = rows.select("doc_id", "text", "sketch", F.coalesce("next.sketch", F.array().cast("array<bigint>")).alias("next"), F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), k, words).alias("other"))
    a, b, c = F.col("sketch"), F.col("other"), F.col("next")
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "edited_sha256", text_form(a).alias("fingerprint"), text_form(b).alias("edited_fingerprint"),
        resemblance(a, b, k).alias("near_edited"), resemblance(a, c, k).alias("near_next"), containment(a, b, k).alias("contained_in_edited"), distinct_shingles(a, k).alias("distinct_shingles"),
    )
