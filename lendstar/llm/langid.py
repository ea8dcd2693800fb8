"""Language identification by Bayesian evidence fusion.

For every row the log posterior of each language adds up

* the text's likelihood under a byte-trigram model per language, and under an
  "und" model that finds every trigram equally likely (noise, other scripts);
* the likelihood of the declared markup language, and of the address suffix,
  given the language;
* the prior of the row's host, smoothed towards that of its suffix, and that
  towards the prior of all rows.

Declaration and suffix tables and the three levels of priors are grouped
aggregates of the text-only decisions over all rows.  Only the trigram models
are fitted on a sample of labelled rows: about ``SAMPLE_ROWS`` whole texts per
label (drawn by hash of the id).  Every label has a model.  The driver and the
workers hold them as a (bucket, language) table of the trigrams seen, some ten
bytes for each; a row's evidence is a number per label.

A row is rejected if it has no letters, or if "und" wins with all evidence (it is
``lang_pred``) and the text is noise: its trigrams hardly repeat, as in no language.  A text in a language without a
model is "und" and stays, and so does one too short to tell (``is_noise``).

Defined results: null or empty text is rejected ("und", confidence 1); null
declaration, suffix or host adds no evidence (a null host has its suffix's
prior); without labelled rows all rows with letters are "und" and kept, as
there's nothing to tell; rows with equal id and text get equal results; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendstar.llm.common import fresh_names, read_table, stored
from lendstar.llm.units import release_memory

SAMPLE_ROWS = 400
COUNTED_LABELS = 64   # labels that a worker counts at once before it passes the counts on
DOCUMENT_TRIGRAMS = 500  # what a sampled document counts at most, so that no long one outweighs the rest
BUCKETS = 1 << 16
UNSEEN = 0.05
UND = "und"
UND_PRIOR = 1e-3
TEXT_WEIGHT = 0.3     # neighbouring trigrams overlap: each counts for less than one
TABLE_WEIGHT = 20.0   # rows that a table's prior is worth
DECLARED_RIGHT = 0.9
NOISE_KINDS = 4000    # as many equally likely trigrams: languages have about 1000 or fewer, random letters 10,000
NOISE_PAIRS = 3       # equal pairs to be expected of so many kinds before a text is called noise

_LOWER = np.full(256, 32, dtype=np.uint8)  # everything but letters is a space
_LOWER[128:] = np.arange(128, 256)
_LOWER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def letters(text: str | None) -> int:
    """Bytes of letters (all of a character beyond ASCII count)."""
    return int((_LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)] != 32).sum())


def trigrams(text: str | None) -> np.ndarray:
    """Bucket of every byte trigram that holds two letters or more."""
    b = _LOWER[np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)]
    letter = b != 32
    near = letter[:-2].astype(np.int8) + letter[1:-1] + letter[2:] >= 2
    b = b.astype(np.uint32)
    code = (b[:-2] * np.uint32(65599) + b[1:-1]) * np.uint32(65599) + b[2:]
    return ((code * np.uint32(2654435769)) >> np.uint32(16))[near].astype(np.int64)


def is_noise(counts: np.ndarray) -> bool:
    """Whether trigrams with these counts repeat less than ``NOISE_KINDS`` equally
    likely ones would; below about 155 trigrams that can't be told."""
    n = int(counts.sum())
    expected = n * (n - 1) / 2 / NOISE_KINDS
    return expected >= NOISE_PAIRS and float((counts * (counts - 1)).sum()) / 2 < expected


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release_memory()
    totals: dict[str, np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, t in totals.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(t[at])],
                                             names=["lang", "bucket", "n"])
        totals.clear()

    for b in (w.slice(lo, 512) for w in batches for lo in range(0, w.num_rows, 512)):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if lang not in totals and len(totals) == COUNTED_LABELS:
                yield from counted()
            t, found = totals.setdefault(lang, np.zeros(BUCKETS)), trigrams(text)
            t += np.bincount(found, minlength=BUCKETS) * min(1.0, DOCUMENT_TRIGRAMS / max(1, len(found)))
    yield from counted()


class Models:
    """Log probabilities of trigrams per language, "und" (all alike) last.

    ``unseen``: that of a trigram the language's sample doesn't have; what the
    others have above it is held by bucket: entries ``start[b]`` to
    ``start[b + 1]`` of ``lang`` and ``gain``.
    """

    def __init__(self, langs: int, lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        total = np.bincount(lang, weights=n, minlength=langs) + UNSEEN * BUCKETS
        self.unseen = np.append(np.log(UNSEEN / total), -np.log(BUCKETS))
        order = np.argsort(bucket, kind="stable")
        self.lang = lang[order].astype(np.int32)
        self.gain = np.log1p(n[order] / UNSEEN).astype(np.float32)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))])

    def score(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Log likelihood per language of distinct buckets with their counts."""
        lo = self.start[buckets]
        size = self.start[buckets + 1] - lo
        at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        gain = np.bincount(self.lang[at], weights=self.gain[at] * np.repeat(counts, size), minlength=len(self.unseen))
        return counts.sum() * self.unseen + gain


def fit(df: DataFrame, id_col: str, text_col: str, label: Column, rows: int = SAMPLE_ROWS) -> tuple[list[str], Models]:
    """Languages, "und" last, and their models."""
    labelled = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), label.alias("lang"))
    labelled = labelled.filter((F.col("lang") != "") & (F.col("lang") != UND))
    sizes = labelled.groupBy("lang").count().orderBy("lang").collect()  # a row per label
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        none = np.zeros(0, dtype=np.int64)
        return [UND], Models(0, none, none, none)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, rows / r["count"]))])
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("lang")] * float(1 << 20)
    counts = labelled.filter(draw).select("lang", "text").mapInArrow(_sample_counts, "lang string, bucket long, n double")
    table = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = table.select(number[F.col("lang")].alias("lang"), F.col("bucket").cast("int"), F.col("n").cast("float")).toArrow()
    return [*langs, UND], Models(len(langs), table["lang"].to_numpy(), table["bucket"].to_numpy(),
                                 table["n"].to_numpy().astype(np.float64))


def _likelihoods(models: Models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                b = whole.slice(lo, 512)
                n, noise, ll = [], [], []
                for text in b.column(b.num_columns - 1).to_pylist():
                    t = trigrams(text)
                    buckets, counts = np.unique(t, return_counts=True)
                    n.append(len(t) or letters(text))
                    noise.append(is_noise(counts))
                    ll.append(models.score(buckets, counts).tolist())
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], pa.array(n, pa.int64()), pa.array(noise, pa.bool_()),
                     pa.array(ll, pa.list_(pa.float64()))],
                    names=["id", "tag", "declared", "suffix", "host", "evidence", "noise", "ll"])
        release_memory()

    return run


def _given(table: DataFrame, key: str, langs: int, right: Column | None) -> DataFrame:
    """(key, log P(key | language) array) of the text-only decisions: counts with a
    prior of TABLE_WEIGHT rows; ``right``: the prior's index of the right language."""
    total = table.groupBy("best").count().groupBy().agg(F.map_from_entries(
        F.collect_list(F.struct("best", "count"))).alias("total"))  # a row per language
    by_key = table.filter(F.col(key).isNotNull()).groupBy(key, "best").count().groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("best", "count"))).alias("n"))
    wrong = (1 - DECLARED_RIGHT) / max(1, langs - 1)

    def cell(i: Column) -> Column:
        prior = F.lit(1.0 / langs) if right is None else F.when(
            right.isNull(), 1.0 / langs).when(right == i, DECLARED_RIGHT).otherwise(wrong)
        n = F.coalesce(F.col("n")[i], F.lit(0)).cast("double")
        of = F.coalesce(F.col("total")[i], F.lit(0)).cast("double")
        return F.log((n + TABLE_WEIGHT * prior) / (of + TABLE_WEIGHT))

    return by_key.withColumn("total", total.scalar()).select(key, F.transform(F.sequence(F.lit(0), F.lit(langs - 1)), cell).alias(f"given_{key}"))


def _share(counts: Column, langs: int, above: Column) -> Column:
    """Counts per language smoothed towards the level above."""
    n = F.aggregate(F.map_values(counts), F.lit(0.0), lambda a, x: a + x)
    return F.transform(F.sequence(F.lit(0), F.lit(langs - 1)), lambda i: (
        F.coalesce(counts[i], F.lit(0)) + TABLE_WEIGHT * F.get(above, i)) / (n + TABLE_WEIGHT))


def decisions(df: DataFrame, id_col: str, text_col: str, declared: Column | None = None,
              suffix: Column | None = None, host: Column | None = None, label: Column | None = None) -> DataFrame:
    """(id, tag, lang_pred, confidence, text_lang, rejected), one row per row."""
    none = F.lit(None).cast("string")
    declared, suffix, host = (none if c is None else c for c in (declared, suffix, host))
    langs, models = fit(df, id_col, text_col, declared if label is None else label)
    n = len(langs)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tag"),
                    declared.alias("declared"), suffix.alias("suffix"), host.alias("host"),
                    F.col(text_col).alias("text"))
    seen = src.mapInArrow(_likelihoods(models), "id long, tag long, declared string, suffix string, host string, "
                                                "evidence long, noise boolean, ll array<double>")
    prior0 = F.concat(F.array_repeat(F.lit((1 - UND_PRIOR) / max(1, n - 1)), n - 1), F.array(F.lit(UND_PRIOR)))
    text = F.transform("ll", lambda x, i: x * TEXT_WEIGHT + F.log(F.get(prior0, i)))
    seen = stored(seen.withColumn("text", text).withColumn(
        "best", (F.array_position("text", F.array_max("text")) - 1).cast("int")).drop("ll"), "language")

    known = seen.filter("evidence > 0").select("declared", "suffix", "host", "best")
    index = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    says = _given(known, "declared", n, index[F.col("declared")])
    ends = _given(known, "suffix", n, None)
    # Priors: all rows (a row per language), suffixes, hosts; each level smooths the next.
    entries = lambda g: g.agg(F.map_from_entries(F.collect_list(F.struct("best", "count"))).alias("n"))
    whole = entries(known.groupBy("best").count().groupBy())
    whole = whole.select(_share(F.col("n"), n, prior0).alias("p"))
    by_suffix = entries(known.filter("suffix IS NOT NULL").groupBy("suffix", "best").count().groupBy("suffix"))
    by_suffix = stored(by_suffix.withColumn("p", whole.scalar()).select(
        "suffix", _share(F.col("n"), n, F.col("p")).alias("suffix_prior")), "suffix-priors")
    by_host = entries(known.filter("host IS NOT NULL").groupBy("host", "suffix", "best").count()
                      .groupBy("host", "suffix"))
    by_host = by_host.join(by_suffix, "suffix", "left").withColumn("p", whole.scalar())
    by_host = by_host.select(F.col("host").alias("own_host"), F.col("suffix").alias("own_suffix"), _share(
        F.col("n"), n, F.coalesce("suffix_prior", "p")).alias("host_prior"))

    at_host = (F.col("host") == F.col("own_host")) & F.col("suffix").eqNullSafe(F.col("own_suffix"))
    fused = (seen.join(says, "declared", "left").join(ends, "suffix", "left")
             .join(by_suffix, "suffix", "left").join(by_host, at_host, "left").withColumn("p", whole.scalar()))
    log_prior = F.transform(F.coalesce("host_prior", "suffix_prior", "p"), lambda x: F.log(x))
    zero = F.array_repeat(F.lit(0.0), n)

    def total(x: Column, i: Column) -> Column:
        return (x - F.log(F.get(prior0, i)) + F.get(F.coalesce(log_prior, zero), i)
                + F.get(F.coalesce("given_declared", zero), i) + F.get(F.coalesce("given_suffix", zero), i))

    names = F.array(*[F.lit(x) for x in langs])
    top = F.array_max("post")
    fused = fused.withColumn("post", F.transform("text", total))
    mass = F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    blank = F.col("evidence") == 0
    pick = (F.array_position("post", top) - 1).cast("int")
    return fused.select(
        "id", "tag", F.when(blank, UND).otherwise(F.get(names, pick)).alias("lang_pred"),
        F.when(blank, F.lit(1.0)).otherwise(F.lit(1.0) / mass).alias("confidence"),
        F.when(blank, UND).otherwise(F.get(names, F.col("best"))).alias("text_lang"),
        (blank | (F.lit(n > 1) & (pick == n - 1) & F.col("noise"))).alias("rejected"))


def drop_rejected(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **evidence: Column) -> DataFrame:
    """``df`` without the rows that language ID rejects."""
    bad = stored(decisions(df, id_col, text_col, **evidence).filter("rejected").select("id", "tag").distinct(), "rejected")
    i, t = fresh_names(df, "id", "tag")
    bad = bad.select(F.col("id").alias(i), F.col("tag").alias(t))
    return df.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(t)), "left_anti")


def url_host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def url_suffix(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url_host(url), r"\.([a-z][a-z0-9-]*)$", 1), F.lit(""))


def markup_language(html: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit(""))


def markup_text(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>", " ")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: its text, its declared language, its source's prior."""
    docs = read_table(spark, sf_dir, "documents")
    out = decisions(docs, "doc_id", "text", declared=F.col("lang"), host=F.col("source"))
    return out.select(F.col("id").alias("doc_id"), "lang_pred", F.round("confidence", 6).alias("confidence"),
                      "text_lang", "rejected", (~F.col("rejected")).alias("kept"))


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for ``pages``: markup language, address suffix and host are there."""
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", markup_text(F.col("html")).alias("text"), markup_language(F.col("html")).alias("declared"),
        url_host(F.col("url")).alias("host"), url_suffix(F.col("url")).alias("suffix"))
    out = decisions(pages, "page_id", "text", F.col("declared"), F.col("suffix"), F.col("host"))
    return out.select(F.col("id").alias("page_id"), "lang_pred", F.round("confidence", 6).alias("confidence"),
                      "text_lang", "rejected")
