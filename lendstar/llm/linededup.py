"""Line dedup by a deletion-neighbourhood join: edit distance 1, earliest stays.

A line is compared trimmed of spaces, A-Z as a-z.  Empty lines stay.  A line goes
when an earlier place (document id, line number) holds an equal line or, where
both have ``MIN_CHARS`` characters or more, a line within one inserted, deleted
or replaced character of it, itself removed or not.

Two lines are within one edit exactly if they are equal, or one variant with one
character deleted is shared at the same place (replacement), or one line is such
a variant of the other (insertion, deletion).  Variants are emitted as hashed
keys and met by their minimum place per key, so a key shared by any number of
lines costs one aggregate and one join, never their pairs.  Most lines need no
variants; three exact filters come first:

1. equal lines are one class, named by digest, standing at its earliest place;
2. lines within one edit share a prefix or a suffix of at least a quarter of
   their length (a power of two); a class alone with both leaves;
3. what is left is cut into blocks of ``BLOCK`` characters; lines within one
   edit have everything in front of and behind one block in common.  Only blocks
   for which another class has the same surroundings emit their variants.  In
   lines of more than ``LONG`` characters the surroundings are named by running
   sums over the blocks' hashes, so the work is linear in their length.

Links found by keys are verified with the edit distance of the lines' texts.

Only DataFrame functions run here.  Defined results: a null text stays null and
counts as one empty line; rows with a null id stay as they are and count for no
one; rows that share an id are one document (a line number stays if it stays in
one of them); an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendstar.llm.common import ascii_lower, fresh_names, read_table, stored, text_or_empty

MIN_CHARS = 10
BLOCK = 32
LONG = 8192


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def normal(line: Column) -> Column:
    return ascii_lower(F.trim(line))


def _part_length(n: Column) -> Column:
    """The largest power of two of which two fit into ``n`` characters."""
    return F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double") / 2))).cast("int")


def _part_keys(line: Column, n: Column) -> Column:
    """Hashes of the prefix and the suffix that a line shares with one of its own
    length, one character shorter or one longer."""
    own, longer = _part_length(n), _part_length(n + 1)

    def pair(p: Column) -> list[Column]:
        return [F.xxhash64(F.lit("p"), p, F.substr(line, F.lit(1), p)),
                F.xxhash64(F.lit("s"), p, F.substr(line, n - p + 1, p))]

    return F.when(own == longer, F.array(*pair(own))).otherwise(F.array(*pair(own), *pair(longer)))


def classes(src: DataFrame) -> DataFrame:
    """(cls, place, keys) of the distinct lines; src: id, text."""
    line = src.select("id", F.posexplode(lines_of(text_or_empty("text"))).alias("pos", "raw"))
    line = line.select("id", "pos", normal(F.col("raw")).alias("line")).withColumn("n", F.length("line"))
    line = line.filter((F.col("n") > 0) & F.col("id").isNotNull())
    keys = F.when(F.col("n") >= MIN_CHARS, _part_keys(F.col("line"), F.col("n"))).otherwise(F.array().cast("array<long>"))
    row = line.select(F.unhex(F.md5("line")).alias("cls"), F.struct("id", "pos").alias("place"), keys.alias("keys"))
    return stored(row.groupBy("cls").agg(F.min("place").alias("place"), F.first("keys").alias("keys")), "line-classes")


def shared_only(rows: DataFrame, key: str, who: str) -> DataFrame:
    """Rows whose key more than one ``who`` has."""
    both = rows.groupBy(key).agg(F.min(who).alias("lo"), F.max(who).alias("hi")).filter("lo < hi").select(key)
    return rows.join(both, key, "left_semi")


def _blocks(line: Column, n: Column, cut: int) -> Column:
    """(key, block) for every block; cut 0: of a line of its own length, cut 1:
    of the shorter of two (its block has one character less)."""
    full = n + cut
    return F.transform(F.sequence(F.lit(0), F.floor((full - 1) / BLOCK).cast("int")), lambda j: F.struct(
        F.xxhash64(j, full, F.substr(line, F.lit(1), j * BLOCK),
                   F.substr(line, (j + 1) * BLOCK - cut + 1, n)).alias("key"),
        F.substr(line, j * BLOCK + 1, F.lit(BLOCK - cut)).alias("block")))


def _long_blocks(line: DataFrame, cut: int) -> DataFrame:
    """The same of long lines, a row a block: what surrounds a block is named by
    the exclusive-or of the hashes, each with its number, of the blocks on either
    side.  The shorter of two lines has its blocks behind the cut one a character
    earlier, so those are taken from the line with one character in front."""
    full = F.col("n") + cut
    of = ["cls", "place"]

    def blocks(text: Column) -> DataFrame:
        # Cut in two steps: finding a place in a text takes as long as it's far.
        part = F.transform(F.sequence(F.lit(0), F.floor((full - 1) / LONG).cast("int")), lambda g: F.struct(
            g.alias("g"), F.substr(text, g * LONG + 1, F.lit(LONG)).alias("part")))
        rows = line.select(*of, full.alias("full"), F.explode(part).alias("p"))
        count = F.ceil(F.length("p.part") / BLOCK).cast("int")
        inner = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
            (F.col("p.g") * (LONG // BLOCK) + i).alias("j"), F.substr("p.part", i * BLOCK + 1, F.lit(BLOCK)).alias("block")))
        rows = rows.filter(F.length("p.part") > 0)
        return rows.select(*of, "full", F.explode(inner).alias("b")).select(*of, "full", "b.*")

    w = Window.partitionBy(*of)  # the blocks of one line
    upto = w.orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    named = blocks(F.col("line")).withColumn("h", F.xxhash64("j", "block"))
    if cut:
        late = blocks(F.concat(F.lit("\n"), F.col("line"))).withColumnRenamed("block", "late")
        named = named.join(late, [*of, "full", "j"], "full").withColumn("h", F.coalesce("h", F.lit(0)))
        named = named.withColumn("behind", F.coalesce(F.xxhash64("j", "late"), F.lit(0)))
        named = named.withColumn("block", F.substr(F.coalesce("block", F.lit("")), F.lit(1), F.lit(BLOCK - 1)))
    else:
        named = named.withColumn("behind", F.col("h"))
    named = named.withColumn("before", F.bit_xor("h").over(upto).bitwiseXOR(F.col("h")))
    named = named.withColumn("after", F.bit_xor("behind").over(w).bitwiseXOR(F.bit_xor("behind").over(upto)))
    key = F.xxhash64(F.lit("long"), "j", "full", "before", "after")
    return named.select(*of, F.lit(cut).alias("role"), key.alias("key"), "block")


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether one inserted, deleted or replaced character at most parts two texts:
    the common start, found by halving, then what's behind it."""
    n, m = F.length(a), F.length(b)
    steps = F.sequence(F.floor(F.log2(F.least(n, m).cast("double") + 1)).cast("int"), F.lit(0), F.lit(-1))

    def longer(at: Column, bit: Column) -> Column:
        to = at + F.pow(F.lit(2.0), bit).cast("int")
        same = (to <= F.least(n, m)) & (F.substr(a, F.lit(1), to) == F.substr(b, F.lit(1), to))
        return F.when(same, to).otherwise(at)

    start = F.aggregate(steps, F.lit(0), longer)
    behind = lambda at: (
        (F.substr(a, at + 2, n) == F.substr(b, at + 2, m)) | (F.substr(a, at + 1, n) == F.substr(b, at + 2, m))
        | (F.substr(a, at + 2, n) == F.substr(b, at + 1, m)))
    return (F.abs(n - m) <= 1) & F.transform(F.array(start), behind)[0]


def near_links(src: DataFrame, found: DataFrame) -> DataFrame:
    """(cls): classes with an earlier one within one edit."""
    key = found.select("cls", F.explode("keys").alias("key"), F.xxhash64("cls").alias("who"))
    left = shared_only(key, "key", "who").select("cls").distinct()
    at = found.join(left, "cls").select("cls", "place").groupBy(F.col("place.id").alias("id")).agg(
        F.collect_list(F.struct("cls", "place")).alias("wanted"))
    text = src.join(at, "id").select(lines_of(text_or_empty("text")).alias("lines"), F.explode("wanted").alias("w"))
    # Rows that share an id: the digest tells which one has the line.
    line = text.select("w.cls", "w.place", normal(F.get("lines", F.col("w.place.pos"))).alias("line"))
    line = stored(line.filter(F.unhex(F.md5("line")) == F.col("cls")).distinct()
                  .withColumn("n", F.length("line")), "line-texts")

    block = None
    for cut in (0, 1):  # keys are made one way for the longer line and the shorter one
        usual = line.filter(F.col("n") + cut <= LONG).select("cls", "place", F.lit(cut).alias("role"), F.explode(
            _blocks(F.col("line"), F.col("n"), cut)).alias("b")).select("cls", "place", "role", "b.key", "b.block")
        both = usual.unionByName(_long_blocks(line.filter(F.col("n") + cut > LONG), cut))
        block = both if block is None else block.unionByName(both)
    block = block.withColumn("who", F.xxhash64("cls"))
    block = stored(shared_only(block, "key", "who").drop("who"), "line-blocks")

    i, b = F.col("i"), F.col("block")
    cut = block.filter("role = 0").withColumn("i", F.explode(F.sequence(F.lit(1), F.length(b))))
    cut = cut.withColumn("variant", F.concat(F.substr(b, F.lit(1), i - 1), F.substr(b, i + 1, F.length(b))))
    replaced = cut.select("cls", "place", F.lit(0).alias("role"), F.xxhash64("key", "i", "variant").alias("v"))
    longer = cut.select("cls", "place", F.lit(1).alias("role"), F.xxhash64("key", F.lit("-"), "variant").alias("v")).distinct()
    shorter = block.filter("role = 1").select("cls", "place", F.lit(2).alias("role"),
                                              F.xxhash64("key", F.lit("-"), "block").alias("v"))
    variant = stored(replaced.unionByName(longer).unionByName(shorter), "line-variants")

    def first(role: int) -> Column:
        return F.min(F.when(F.col("role") == role, F.struct("place", "cls"))).alias(f"first{role}")

    met = variant.groupBy("v").agg(*[first(r) for r in (0, 1, 2)], F.count("*").alias("n")).filter("n > 1").drop("n")
    # A replacement meets any line of the key; a longer line its shorter ones and the reverse.
    other = F.when(F.col("role") == 0, F.col("first0")).when(F.col("role") == 1, F.col("first2")).otherwise(F.col("first1"))
    link = variant.join(met, "v").select("cls", "place", other.alias("other")).filter("other.place < place")
    link = link.select("cls", F.col("other.cls").alias("earlier")).distinct()
    mine = line.select("cls", F.col("line").alias("mine"))
    theirs = line.select(F.col("cls").alias("earlier"), F.col("line").alias("theirs"))
    return (link.join(mine, "cls").join(theirs, "earlier")
            .filter(within_one_edit(F.col("mine"), F.col("theirs"))).select("cls").distinct())


def kept_places(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, kept): the numbers (from 0) of the lines that stay and aren't empty."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    src = src.filter("id IS NOT NULL")
    found = classes(src)
    stay = found.join(near_links(src, found), "cls", "left_anti")
    return stay.groupBy(F.col("place.id").alias("id")).agg(F.array_sort(F.collect_list("place.pos")).alias("kept"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the lines that go taken out of ``text_col``."""
    key, kept = fresh_names(df, "id", "kept")
    places = kept_places(df, id_col, text_col).select(F.col("id").alias(key), F.col("kept").alias(kept))
    joined = df.join(places, F.col(id_col).cast("long") == F.col(key), "left")
    stays = F.filter(lines_of(F.col(text_col)), lambda line, i: (F.trim(line) == "")
                     | F.coalesce(F.array_contains(F.col(kept), i), F.lit(False)))
    text = F.when(F.col(id_col).isNull(), F.col(text_col)).otherwise(F.array_join(stays, "\n"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in df.columns])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many go, and which compared lines stay."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = lines_of(text_or_empty("text"))
    counts = docs.select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.size(
        F.filter(lines, lambda x: F.trim(x) != "")).cast("long").alias("n_compared"))
    places = kept_places(docs).withColumnRenamed("id", "doc_id")
    return counts.join(places, "doc_id", "left").select(
        "doc_id", "n_lines", (F.col("n_compared") - F.coalesce(F.size("kept"), F.lit(0))).alias("n_removed"),
        F.coalesce(F.array_join("kept", ","), F.lit("")).alias("kept_lines"))


def op5_sql() -> str:
    """The same with candidates by equal halves and edit checks character by character."""
    low = "translate(trim(l, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM d),
x AS (SELECT doc_id, pos, {low} AS t FROM l WHERE length({low}) > 0),
c AS (SELECT t, length(t) AS n, min((doc_id, pos)) AS place FROM x GROUP BY t),
k AS (SELECT t, n, place, m, m // 2 AS h FROM (SELECT *, unnest([n, n + 1]) AS m FROM c WHERE n >= {MIN_CHARS})),
keys AS (SELECT t, n, place, m, 'l' AS side, left(t, h) AS part FROM k
    UNION ALL SELECT t, n, place, m, 'r', right(t, m - h) FROM k),
pair AS (SELECT DISTINCT a.t AS a, b.t AS b, a.n AS n, b.n AS bn, a.place AS pa, b.place AS pb
    FROM keys a JOIN keys b ON a.m = b.m AND a.side = b.side AND a.part = b.part
    AND a.n = a.m AND (b.n < a.n OR b.t > a.t)),
link AS (SELECT pa, pb FROM pair
    WHERE len(list_filter(range(n), lambda i: left(a, i) = left(b, i) AND substr(a, i + 2) = substr(b, i + 2 - n + bn))) > 0),
gone AS (SELECT greatest(pa, pb) AS place FROM link),
kept AS (SELECT place FROM c WHERE place NOT IN (SELECT place FROM gone)),
g AS (SELECT place[1] AS doc_id, count(*) AS n, string_agg(place[2], ',' ORDER BY place[2]) AS kept_lines
    FROM kept GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ls) AS BIGINT) AS n_lines,
    CAST(coalesce(m.n, 0) - coalesce(g.n, 0) AS BIGINT) AS n_removed, coalesce(g.kept_lines, '') AS kept_lines
FROM d LEFT JOIN m USING (doc_id) LEFT JOIN g USING (doc_id)
"""
