"""Line deduplication by an exact set-similarity join, with DataFrame functions only.

A line is removed when an earlier line (by document id, then position) has a word set of Jaccard similarity `threshold` or
more, whether or not that earlier line stays. Words are what stands between ASCII white space; lines without words stay.

1. A sketch of 2**16 counters over all words of all documents gives each word a rarity level. Level, then hash, is one global
   order of words; any order is exact, this one keeps posting lists short. The sketch is one byte a counter, whatever the corpus.
2. Lines with equal word sets form one class, named by its first line; all others of it are removed. Copies meet as
   partial minima, so a line that half of all documents repeat is one row from each task.
3. Prefix filter: sets of n words that reach the threshold share a word among the first n - ceil(t n) + 1, their prefix. Leaders
   come first: classes whose least or largest hash is the same try up to 8 early classes of their group. One match is enough, so
   a group of k near-equal lines costs a fixed multiple of k comparisons here, and what is matched needs no other partner.
4. Every class that no leader matched meets all classes that share a word of its prefix, in a self-join by that word and a
   class of sizes. Of a pair the smaller set brings only its first n - ceil(2 t n / (1 + t)) + 1 words, which is enough as the two
   share more of these. Filters: length, position, and parity (the XOR of one of 128 bits for each word differs in no more bits
   than the sets in words).
5. Pairs of both steps are verified on the words, which are read again for their lines only; fixed-size bit filters keep
   most other lines out of that shuffle, and what they let through falls to the join.

Words are compared as 64-bit hashes and equal sets as two of them, so a verdict is wrong only where different words of
two compared lines share a hash: a chance of about n * n / 2**64 for lines of n words (5e-16 for 100 words).

Edge cases: null and empty texts have no lines to remove; blank lines stay; rows that repeat an id and a text share their
lines and keep them alike; an id with several texts is several documents, in the order of their hashes; null ids are carried
through unchanged and take part in nothing; a very long line is one line like others (of 65,535 words and more, lines skip
the positional and parity filters); an empty table gives an empty result; other columns are carried along by
`drop_repeated_lines`, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parityline.llm.common import free_name, staged, text_of

THRESHOLD = 0.8
SKETCH_BITS = 16
#: Bits of the filters over documents and lines to read again: 256 bitmaps of 32,768.
FILTER_BITMAPS, BITMAP_BITS = 256, 32768
#: Sizes travel in 16 bits, positions in 14; the largest size means "or more".
FULL, LAST = (1 << 16) - 1, (1 << 14) - 1
#: Longs of parity bits.
PARITY = ("parity", "odd_parity")
#: The least and the largest hash of a line's words, 32 bits of each.
ENDS = ("least", "largest")
#: Leaders of a group that a line tries before it meets all others.
TRIES = 8
#: Steps of the threshold in a class of sizes: more give fewer rows to the self-join, and more pairs.
SIZE_STEPS = 6
#: What names a line: its document, and the number of the text under that id (normally 0) with the line number.
NAME = ("doc_id", "place")


def spaced(text: Column) -> Column:
    """All white space of a line as spaces, so that a plain split gives the words."""
    for c in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def ceil_share(n: Column, share: float) -> Column:
    """ceil(share * n) without a rounding error at whole numbers."""
    return F.ceil(n * share - 1e-9)


def hashes(line: Column) -> Column:
    """The hashes of the distinct words of a line."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def parities(words: Column) -> list[Column]:
    """Bits of 64 places, the words of a place XORed: of all words, and of those with an odd seventh bit.

    Together they tell 128 places apart, and sets that differ in d words differ in d of them at most.
    """

    def part(one: Callable[[Column], Column]) -> Column:
        return F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc.bitwiseXOR(F.call_function("shiftleft", one(w), w.bitwiseAND(63).cast("int"))))

    return [part(lambda w: F.lit(1).cast("long")), part(lambda w: F.shiftright(w, 6).bitwiseAND(1))]


def bits_apart(a: list[Column], b: list[Column]) -> Column:
    every, odd = (x.bitwiseXOR(y) for x, y in zip(a, b, strict=True))
    return F.bit_count(odd) + F.bit_count(every.bitwiseXOR(odd))


def numbered(docs: DataFrame, id_col: str, text_col: str, number: str) -> DataFrame:
    """docs with the number of each row's text among the texts of its id: 0 where an id has one text."""
    own_id, own_text = free_name("_id", docs), free_name("_text", docs)
    counts = docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(own_id)).agg(F.count("*").alias("_rows"))
    repeated = staged(counts.filter("_rows > 1").select(own_id), "line-repeated")
    if repeated.isEmpty():
        return docs.withColumn(number, F.lit(0).cast("long"))
    text = F.xxhash64(text_of(text_col))
    texts = docs.select(F.col(id_col).alias(own_id), text.alias(own_text)).join(repeated, own_id, "left_semi").distinct()
    texts = staged(texts.withColumn(number, F.row_number().over(Window.partitionBy(own_id).orderBy(own_text)).cast("long") - 1), "line-texts")
    joined = docs.join(texts, (F.col(id_col) == F.col(own_id)) & (text == F.col(own_text)), "left")
    return joined.select(*docs.columns, F.coalesce(number, F.lit(0)).alias(number))


def sketch_of(docs: DataFrame, text_col: str) -> bytes:
    """The rarity level (0 to 31) of each of the 2**SKETCH_BITS buckets of words: one byte each, whatever the corpus."""
    word = F.explode(F.split(F.replace(spaced(text_of(text_col)), F.lit("\n"), F.lit(" ")), " "))
    bucket = F.xxhash64("w").bitwiseAND((1 << SKETCH_BITS) - 1).cast("int")
    counts = docs.select(word.alias("w")).filter("w <> ''").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    level = F.least(F.lit(31), F.floor(F.log2(F.col("n").cast("double")))).cast("int")
    levels = bytearray(1 << SKETCH_BITS)
    for x in counts.agg(F.collect_list(F.shiftleft("bucket", 5).bitwiseOR(level)).alias("all")).first()["all"]:
        levels[x >> 5] = x & 31
    return bytes(levels)


def lines_of(docs: DataFrame, id_col: str, text_col: str, number: str) -> DataFrame:
    """doc_id, place, line of each line; docs without an id have none."""
    line = F.posexplode(F.split(spaced(text_of(text_col)), "\n")).alias("line_no", "line")
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(number).alias("_number"), line)
    return rows.select("doc_id", F.shiftleft("_number", 32).bitwiseOR(F.col("line_no").cast("long")).alias("place"), "line")


def coded_words(line: Column, levels: bytes) -> Column:
    """The distinct words of a line as level, then hash, in that order."""
    return coded(hashes(line), levels)


def coded(words: Column, levels: bytes) -> Column:
    """Hashes of words as level, then hash, in that order."""
    table = F.from_json(F.lit(str(list(levels))), "array<tinyint>")  # folded to one constant

    def code(h: Column) -> Column:
        # Never null, as Spark sorts an array of longs that may hold nulls as boxed objects.
        level = F.coalesce(F.get(table, h.bitwiseAND((1 << SKETCH_BITS) - 1).cast("int")), F.lit(0).cast("tinyint"))
        return F.shiftleft(level.cast("long"), 58).bitwiseOR(F.shiftrightunsigned(h, 6))

    return F.sort_array(F.transform(words, code))


def classes_of(lines: DataFrame, levels: bytes, threshold: float) -> DataFrame:
    """One row for each word set: doc_id and place of its first line, n (its size), two parities, prefix, least and largest hash."""
    n = F.size("words")
    parity = [c.alias(name) for c, name in zip(parities(F.col("words")), PARITY, strict=True)]
    # 31 bits of each prefix word are enough to find candidates.
    prefix = F.transform(F.slice("words", F.lit(1), (n - ceil_share(n, threshold) + 1).cast("int")), lambda w: F.shiftrightunsigned(w, 20).bitwiseAND(0x7FFFFFFF).cast("int"))
    hashed = lines.filter(F.trim("line") != "").select(*NAME, hashes(F.col("line")).alias("hashes"))
    ends = [F.shiftright(f("hashes"), 32).cast("int").alias(name) for f, name in zip((F.array_min, F.array_max), ENDS, strict=True)]
    # Two hashes of 64 bits name a set.
    named = hashed.select(*NAME, *ends, coded(F.col("hashes"), levels).alias("words")).select(
        F.xxhash64("words").alias("key"),
        F.xxhash64(F.lit("line set"), "words").alias("set"),
        F.struct(*NAME, n.alias("n"), *parity, *ENDS, prefix.alias("prefix")).alias("first"),
    )
    return staged(named.groupBy("key", "set").agg(F.min("first").alias("first")).select("first.*"), "line-classes")


def only(rows: DataFrame, wanted: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows that may be among wanted by the columns names: a fixed-size bit filter, exact but for what it lets through."""

    def spot() -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(FILTER_BITMAPS * BITMAP_BITS)) + 1

    maps = wanted.select(spot().alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    every = rows.sparkSession.range(1, FILTER_BITMAPS + 1).withColumnRenamed("id", "bucket").join(maps, "bucket", "left")
    none = F.unhex(F.lit("00" * (BITMAP_BITS // 8)))
    row = every.select(F.struct("bucket", F.coalesce("bits", none).alias("bits")).alias("x")).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["bits"]).alias("maps"))
    maps = staged(row, "line-filter").select("maps").scalar()
    at = F.bitmap_bit_position(spot())
    byte = F.conv(F.hex(F.substring(F.get(maps, (F.bitmap_bucket_number(spot()) - 1).cast("int")), (at / 8).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    return rows.filter(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1)


def word_sets(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, number: str) -> DataFrame:
    """line (doc_id, place), words of the lines of pairs (late, early), read from the texts."""
    ends = [pairs.select(F.col(c).alias("line")).distinct() for c in ("late", "early")]
    wanted = staged(ends[0].unionByName(ends[1]).distinct().select("line.*"), "line-wanted")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(number).alias("number"))
    some = only(own, wanted.select("doc_id").distinct(), NAME[:1])
    lines = only(lines_of(some, "doc_id", "text", "number"), wanted, NAME).join(wanted, list(NAME))
    # Rows that repeat an id and a text give a line several times.
    once = lines.groupBy(*NAME).agg(F.min("line").alias("line"))
    return staged(once.select(F.struct(*NAME).alias("line"), hashes(F.col("line")).alias("words")), "line-sets")


def matched(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """late: lines that one of their pairs matches. Each line tries its earliest pair first, and all others only if that fails."""
    x, y = (sets.select(F.col("line").alias(c), F.col("words").alias(f"words_{c}")) for c in ("early", "late"))
    common = F.size(F.array_intersect("words_early", "words_late"))
    union = F.size("words_early") + F.size("words_late") - common

    def hits(some: DataFrame) -> DataFrame:
        return staged(some.join(x, "early").join(y, "late").filter(common >= threshold * union - 1e-9).select("late").distinct(), "line-later")

    first = hits(pairs.groupBy("late").agg(F.min("early").alias("early")))
    return first.unionByName(hits(pairs.join(first, "late", "left_anti")))


def near(n_a: Column, n_b: Column, parity_a: list[Column], parity_b: list[Column], threshold: float) -> tuple[Column, Column, Column]:
    """The length filter, the parity filter, and how many words two sets must share."""
    need = ceil_share(n_a + n_b, threshold / (1 + threshold))
    lengths = (n_a >= threshold * n_b - 1e-9) & (n_b >= threshold * n_a - 1e-9)
    return lengths, bits_apart(parity_a, parity_b) <= n_a + n_b - 2 * need, need


def leaders(classes: DataFrame, threshold: float, tries: int = TRIES) -> DataFrame:
    """Pairs of lines (late, early): early leads a group of lines whose least or largest hash is the same.

    Two sets share either hash with a chance of their similarity, whatever words set them apart. A group has up to `tries`
    leaders, a line of the first document of each part into which a hash deals its lines.
    """
    rows = classes.select(F.explode(F.array(*[F.col(c).cast("long") for c in ENDS])).alias("group"), *NAME, "n", *PARITY)
    part = F.pmod(F.xxhash64(*NAME), F.lit(tries))
    # Of single values, not of a struct, so that the groups are hashed and not sorted.
    rest = [F.min_by(c, "doc_id").alias(f"lead_{c}") for c in (NAME[1], "n", *PARITY)]
    firsts = rows.groupBy("group", part.alias("part")).agg(F.min("doc_id").alias("lead_doc_id"), *rest).drop("part")
    late, early = F.struct(*NAME).alias("late"), F.struct(*[F.col(f"lead_{c}").alias(c) for c in NAME]).alias("early")
    lengths, parity, _ = near(F.col("lead_n"), F.col("n"), [F.col(f"lead_{c}") for c in PARITY], [F.col(c) for c in PARITY], threshold)
    tried = rows.join(firsts.hint("shuffle_hash"), "group").filter(lengths & parity).select(late, early).filter("early < late")
    return staged(tried.distinct(), "line-led")


def least_size(threshold: float) -> int:
    """Smaller sets reach the threshold only when they are equal: the bound is n / (n + 1) for n words against n + 1."""
    return next(n for n in range(1, 1000) if n / (n + 1) >= threshold) if threshold < 1 else 1 << 30


def size_class(n: Column, threshold: float) -> Column:
    """A number that does not fall as n grows: sets that reach the threshold are of one such class or of two that are neighbours."""
    return F.floor(F.log(n.cast("double")) / max(-SIZE_STEPS * math.log(threshold), 0.01) + 1e-9)


def candidates(classes: DataFrame, gone: DataFrame, threshold: float) -> DataFrame:
    """Pairs of lines (late, early) that pass the filters; late lines that are gone need none."""
    done = gone.select("late.*", F.lit(1).alias("done"))
    open_ = classes.join(done, list(NAME), "left").withColumn("done", F.coalesce("done", F.lit(0)))
    # One long carries the word with the class of sizes, the mark, the size and the position: fewer bytes in the only large shuffle.
    fields = (("done", 30), ("n", 14), ("pos", 0))
    limits = {"n": FULL, "pos": LAST}

    def rows(x: str, prefix: Column, low: Column, high: Column) -> DataFrame:
        some = open_.select(*NAME, *PARITY, "n", "done", F.posexplode(prefix).alias("pos", "word"))
        some = some.withColumn("sizes", F.explode(F.sequence(low, high)))
        packed = F.shiftleft(F.hash("word", "sizes").bitwiseAND(0x7FFFFFFF).cast("long"), 31)
        for name, shift in fields:
            value = F.least(name, F.lit(limits[name])) if name in limits else F.col(name)
            packed = packed.bitwiseOR(F.shiftleft(value.cast("long"), shift))
        return some.select(*[F.col(c).alias(f"{c}_{x}") for c in (*NAME, *PARITY)], packed.alias(f"packed_{x}"))

    def n(x: str) -> Column:
        return F.shiftright(f"packed_{x}", 14).bitwiseAND(FULL)

    def pos(x: str) -> Column:
        return F.col(f"packed_{x}").bitwiseAND(LAST)

    def mark(x: str) -> Column:
        return F.shiftright(f"packed_{x}", 30).bitwiseAND(1) == 1

    # Of a pair, a is the smaller set: a shorter prefix serves it, under the classes of all sizes that it can match.
    size, most = F.col("n"), F.floor(F.col("n") / threshold + 1e-9)
    own = size_class(size, threshold)
    shorter = F.slice("prefix", F.lit(1), (size - ceil_share(size, 2 * threshold / (1 + threshold)) + 1).cast("int"))
    a, b = rows("a", shorter, own, size_class(most, threshold)), rows("b", F.col("prefix"), own, own)
    n_a, n_b = n("a"), n("b")
    lengths, parity, need = near(n_a, n_b, *[[F.col(f"{c}_{x}") for c in PARITY] for x in "ab"], threshold)
    positions = F.least(n_a - pos("a"), n_b - pos("b")) >= need
    fits = lengths & ((n_a == FULL) | (n_b == FULL) | (positions & parity))
    earlier = (F.col("doc_id_a") < F.col("doc_id_b")) | ((F.col("doc_id_a") == F.col("doc_id_b")) & (F.col("place_a") < F.col("place_b")))
    later = (F.col("doc_id_a") > F.col("doc_id_b")) | ((F.col("doc_id_a") == F.col("doc_id_b")) & (F.col("place_a") > F.col("place_b")))
    ordered = (n_a < n_b) | (n_a == FULL) | ((n_a == n_b) & earlier)
    wanted = (earlier & ~mark("b")) | (later & ~mark("a"))
    found = a.join(b, (F.shiftright("packed_a", 31) == F.shiftright("packed_b", 31)) & ordered & fits & wanted)
    x, y = (F.struct(*[F.col(f"{c}_{x}").alias(c) for c in NAME]) for x in "ab")
    return staged(found.select(F.greatest(x, y).alias("late"), F.least(x, y).alias("early")).distinct(), "line-candidates")


def kept_lines(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", number: str | None = None) -> DataFrame:
    """doc_id, number, kept: the positions of the lines with words that stay, for each document that keeps any.

    number tells the texts of an id apart, as `numbered` does; it is the name of that column where docs has it already.
    """
    if number is None:
        number = free_name("line_number", docs)
        docs = numbered(docs.select(id_col, text_col), id_col, text_col, number)
    read = (id_col, text_col, number)
    classes = classes_of(lines_of(docs, *read), sketch_of(docs, text_col), threshold)
    long = classes.filter(F.col("n") >= least_size(threshold))
    pairs = leaders(long, threshold)
    led = matched(pairs, word_sets(docs, pairs, *read), threshold)
    pairs = candidates(long, led, threshold)
    gone = led.unionByName(matched(pairs, word_sets(docs, pairs, *read), threshold))
    stay = classes.select(*NAME).join(gone.select("late.*"), list(NAME), "left_anti")
    line_no = F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")
    return stay.groupBy("doc_id", F.shiftright("place", 32).alias("number")).agg(F.sort_array(F.collect_set(line_no)).alias("kept"))


def _with_kept(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """docs with the positions of the kept lines in a column of that name."""
    number, own_id, own_number, own = (free_name(c, docs) for c in ("line_number", "line_doc_id", "line_own_number", "line_kept"))
    docs = numbered(docs, id_col, text_col, number)
    kept = kept_lines(docs, threshold, id_col, text_col, number).withColumnsRenamed({"doc_id": own_id, "number": own_number, "kept": own})
    return docs.join(kept, (F.col(id_col) == F.col(own_id)) & (F.col(number) == F.col(own_number)), "left"), own


def drop_repeated_lines(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the repeated lines taken out of the text; all rows and columns stay."""
    joined, own = _with_kept(docs, threshold, id_col, text_col)
    split = F.split(F.col(text_col), "\n")
    keep = F.filter(split, lambda line, i: (F.trim(spaced(line)) == "") | F.coalesce(F.array_contains(own, i), F.lit(False)))
    cleaned = F.when(F.col(id_col).isNull(), F.col(text_col)).otherwise(F.array_join(keep, "\n"))
    return joined.select(*[cleaned.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines (with words), n_kept, kept_lines (positions, comma-separated) of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n_lines = F.size(F.filter(F.split(text_of("text"), "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))))
    joined, own = _with_kept(docs.withColumn("n_lines", n_lines), THRESHOLD, "doc_id", "text")
    return joined.select("doc_id", "n_lines", F.coalesce(F.size(own), F.lit(0)).alias("n_kept"), F.coalesce(F.array_join(own, ","), F.lit("")).alias("kept_lines"))


ORACLE = r"""
WITH s AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), l AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM s
), w AS (
    SELECT doc_id, line_no, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS words FROM l
), lines AS MATERIALIZED (
    SELECT * FROM w WHERE len(words) > 0
), classes AS MATERIALIZED (
    SELECT words, len(words) AS n, min((doc_id, line_no)) AS first, row_number() OVER () AS id FROM lines GROUP BY words
), tokens AS MATERIALIZED (
    SELECT id, n, unnest(words) AS token FROM classes
), pairs AS (
    SELECT a.id AS a, b.id AS b, count(*) AS common
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.id < b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
    GROUP BY a.id, b.id
), later AS (
    SELECT DISTINCT greatest(x.first, y.first) AS first
    FROM pairs JOIN classes x ON x.id = a JOIN classes y ON y.id = b WHERE 5 * common >= 4 * (x.n + y.n - common)
), kept AS (
    SELECT first[1] AS doc_id, list_sort(list(first[2])) AS kept FROM classes
    WHERE first NOT IN (SELECT first FROM later) GROUP BY first[1]
), counts AS (
    SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(len(kept), 0) AS n_kept, coalesce(array_to_string(kept, ','), '') AS kept_lines
FROM documents d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
