"""Document fingerprints: a threshold-scaled sketch of word shingles.

The sketch of a text keeps every distinct shingle hash below a fixed fraction
of the hash range, so its size follows the text's, the sketch of a union is the
union of sketches (``merge``), and the containment of one text in another is
estimated however unequal they are.  A text whose hashes all lie above the
threshold (probability (7/8)^n with n shingles: about half of the texts with
five) keeps its smallest one, so that only wordless texts have an empty sketch;
merging drops such a hash as soon as there's one below.  ``containment`` of such
a text is 1 or 0: 1 only if the other has kept the same hash, which then has none
below the threshold either; in a text with hashes below it, it's 0 even if the
text is wholly contained.

Hashes are the first 16 hex digits of the shingle's MD5 (a shingle is five
words joined by spaces; a shorter text is one shingle); as text they sort like
numbers.  A fingerprint is the sorted hashes joined by commas.

Only DataFrame functions run here.  Defined results: null text is empty; an
empty or wordless text has the fingerprint "", alike 1 to another one and 0 to
any other; rows are compared in the order of id (null first), then text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.llm.common import ascii_lower, read_table, text_or_empty

SHINGLE = 5
FRACTION_16 = 2  # sixteenths of the hash range: one eighth
DIGITS = 16


def sketch(text: Column) -> Column:
    """array<string>: the sorted hashes of a text's sketch."""
    words = F.filter(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(F.array(words), _of_words)[0]


def _of_words(words: Column) -> Column:
    # bound once by the lambda: the word list is used several times
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    hashes = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.md5(F.concat_ws(" ", F.slice(words, i, SHINGLE))))
    found = F.transform(F.array(hashes), _below)[0]
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(found)


def _below(hashes: Column) -> Column:
    low = F.filter(hashes, lambda h: h < f"{FRACTION_16:x}")
    some = F.when(F.size(low) > 0, low).otherwise(F.array(F.array_min(hashes)))
    return F.array_sort(F.array_distinct(F.transform(some, lambda h: F.substr(h, F.lit(1), F.lit(DIGITS)))))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h < f"{FRACTION_16:x}")
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other has."""
    n, m = F.size(a), F.size(b)
    return F.when((n == 0) & (m == 0), F.lit(1.0)).when((n == 0) | (m == 0), F.lit(0.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.least(n, m))


def fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``df`` with ``out_col``, replaced if it's there."""
    return df.withColumn(out_col, F.array_join(sketch(text_or_empty(text_col)), ","))


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, sketch, next_text, next_sketch): the next row in order of id,
    after the last one the first.

    Rows are dealt to ranges of ids of about equal size (as many as shuffle
    partitions).  Each range also gets a copy of the first row of the next one,
    so one shuffle and two windows over the same ranges are enough.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = src.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 100 * ranges).alias("q")).first()
    cuts = sorted(set(cuts["q"] or [])) if cuts and ranges > 1 else []
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    src = src.withColumn("range", F.size(F.filter(bounds, lambda c: c < F.col("id"))))
    firsts = src.groupBy("range").agg(F.min(F.struct("id", "text")).alias("r"))
    used = sorted(r["range"] for r in firsts.select("range").collect())  # one per range
    if not used:
        before = F.create_map(F.lit(0), F.lit(0))
    else:
        before = F.create_map(*[F.lit(x) for a, b in zip(used, [used[-1], *used[:-1]]) for x in (a, b)])
    copies = firsts.select("r.id", "r.text", before[F.col("range")].alias("range"), F.lit(1).alias("copy"))
    rows = src.withColumn("copy", F.lit(0)).unionByName(copies)
    order = Window.partitionBy("range").orderBy("copy", F.col("id").asc_nulls_first(), "text")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("sketch", sketch(F.col("text")))
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(order))
    return rows.filter("copy = 0").drop("copy", "range")


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = with_next(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.select("id", "sketch", "next_sketch", n.cast("long").alias("n_chars"), F.concat(
        F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut)).alias("edited"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("sketch", ",").alias("fingerprint"), F.array_join("edited_sketch", ",").alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op8_sql() -> str:
    def sk(text: str) -> str:
        words = (f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                 rf"'[^\x20\x09-\x0D]+')")
        return (f"(SELECT CASE WHEN len(w) = 0 THEN [] WHEN len(list_filter(h, lambda x: x < '{FRACTION_16:x}')) > 0 "
                f"THEN list_sort(list_distinct(list_transform(list_filter(h, lambda x: x < '{FRACTION_16:x}'), "
                f"lambda x: left(x, {DIGITS})))) ELSE [left(list_min(h), {DIGITS})] END FROM (SELECT w, list_transform("
                f"range(greatest(len(w) - {SHINGLE}, 0) + 1), lambda i: md5(array_to_string(w[i + 1:i + {SHINGLE}], ' '))"
                f") AS h FROM (SELECT {words} AS w)))")

    def near(a: str, b: str) -> str:
        return (f"CAST(CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 ELSE "
                f"len(list_intersect({a}, {b})) / least(len({a}), len({b})) END AS DOUBLE)")

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lead(coalesce(text, '')) OVER w,
        first_value(coalesce(text, '')) OVER w) AS nt FROM documents WINDOW w AS (ORDER BY doc_id NULLS FIRST, text)),
e AS (SELECT *, left(t, length(t) - length(t) // 4) || left(nt, length(t) // 4) AS ed FROM d),
s AS (SELECT *, {sk("t")} AS a, {sk("ed")} AS b FROM e),
n AS (SELECT *, coalesce(lead(a) OVER w, first_value(a) OVER w) AS na FROM s WINDOW w AS (ORDER BY doc_id NULLS FIRST, t))
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(ed) AS edited_sha256,
    array_to_string(a, ',') AS fingerprint, array_to_string(b, ',') AS edited_fingerprint,
    {near("a", "b")} AS near_edited, {near("a", "na")} AS near_next FROM n
"""
