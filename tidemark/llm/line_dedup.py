"""Near-duplicate lines by an exact set-similarity join; later matches are removed.

A line is the set of its words. Lines with equal sets are one set, standing at its first
line. Sets order their words from rare to frequent; two sets with Jaccard similarity of at
least ``SIMILARITY`` share a word among the first few (prefix filter), have near sizes
(length filter), and share it near enough to both starts to reach the overlap needed
(position filter); a parity bitmap of the words bounds the overlap as well. Pairs left are
verified on their words.

The place of a word in a set bounds the sizes of the sets that can share it: its ``reach``.
Words of a prefix that no other set of fitting size and reach has are dropped before sets
are compared.

A set is removed if any earlier set is similar. So that groups of near copies do not meet
in all pairs, each set is first compared with its leads: the earliest set at each of a few of
its prefix words, chosen by their hashes. Only sets not removed by that are compared with all
earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, any_of, hashes, passes, sieve, stored, table_of

# Similarity as a fraction: 4/5 = 0.8.
NUMERATOR, DENOMINATOR = 4, 5
RARITY_SLOTS = 1 << 19
HASH_BITS = 47
# Ranks run from 0 to 64000. Words of at least this rank are 1/4096 of all words or more.
TOP_RANK, HEAVY_RANK = 64_000, 52_000
LEAD_WORDS = 3
# Sets of at least so many words have a bitmap twice as long.
LONG_SET = 40
# Sets meet by words and by bands of sizes; each band's largest size is so many times its smallest.
BAND = 1.5
HOME = 1 << 31
LAST = (1 << 63) - 1


def _pieces(line: Column) -> Column:
    """Words of a line without line feeds, and empty strings. Most lines hold no white space but blanks."""
    other = any_of([F.contains(line, F.lit(c)) for c in "\t\x0b\x0c\r"])
    return F.when(other, F.split(F.lower(line), SPACES)).otherwise(F.split(F.lower(line), " "))


def _words(line: Column) -> Column:
    return F.array_remove(_pieces(line), "")


def _slot(word_hash: Column) -> Column:
    return F.shiftrightunsigned(word_hash, 64 - RARITY_SLOTS.bit_length() + 1)


def rarity(docs: DataFrame) -> Column:
    """How frequent the words of each hash slot are: an array of fixed size.

    64000 + 1000 log2 of their share of all words, in the high bits of a long. Counted over
    all documents. Words that share a slot share its count: any order of the words gives
    the same result, a better one only fewer candidates.
    """
    flat = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    spread = docs.where("text is not null").select(F.explode(_pieces(flat)).alias("w")).where("w <> ''")
    counted = spread.groupBy(_slot(F.xxhash64("w")).alias("slot")).agg(F.count("*").cast("double").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))
    rank = F.round(TOP_RANK + F.log2(share) * 1000).cast("long")
    return table_of(counted.select("slot", F.shiftleft(rank, HASH_BITS).alias("value")), RARITY_SLOTS, "long")


def _short(key: Column) -> Column:
    """31 bits of a key, negative for frequent words: words that share them only make more candidates."""
    low = key.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    return F.when(key >= F.lit(HEAVY_RANK << HASH_BITS), F.bitwise_not(low)).otherwise(low)


def reach(n: Column, at: Column) -> Column:
    """Largest size of a similar set that shares the word at place ``at`` of ``n`` as first word.

    From there on at most n - at words are common, and similar sets of n and m words have
    NUMERATOR / (NUMERATOR + DENOMINATOR) of n + m in common at least.
    """
    return F.floor((n * DENOMINATOR - at * (NUMERATOR + DENOMINATOR)) / F.lit(float(NUMERATOR))).cast("int")


def prefix_length(n: Column) -> Column:
    """Words among which similar sets of any size must share one."""
    return n - F.ceil(n * NUMERATOR / F.lit(float(DENOMINATOR)) - 1e-9) + 1


def line_sets(docs: DataFrame) -> DataFrame:
    """doc (doc_id, null as the last), line, and of its set: s1, s2, n, parity, upper, prefix."""
    lines = docs.where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.posexplode(F.split("text", "\n")).alias("line", "string")
    ).withColumn("ranks", rarity(docs))

    def key(h: Column) -> Column:
        # Never null, so that arrays of keys are sorted as plain longs.
        rank = F.coalesce(F.get(F.col("ranks"), _slot(h).cast("int")), F.lit(0).cast("long"))
        return rank.bitwiseOR(h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))

    # Distinct by hash: sets are told apart on their words where a pair is verified.
    distinct = F.array_distinct(hashes(_words(F.col("string"))))
    made = lines.select("doc", "line", F.sort_array(F.transform(distinct, key)).alias("made"))
    # Exploding one array of keys makes it once, although many columns use it. It comes after
    # a projection of its own, so that no row carries the table of ranks.
    keyed = made.select("doc", "line", F.explode(F.array("made")).alias("keys"))
    keyed = keyed.where(F.size("keys") > 0)
    n = F.size("keys")
    at = lambda k: k.bitwiseAND(F.lit(63)).cast("int")
    parity = lambda value: F.aggregate(
        "keys", F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(F.call_function("shiftleft", value(k), at(k)))
    )
    one = F.lit(1).cast("long")
    return keyed.select(
        "doc",
        "line",
        F.xxhash64("keys").alias("s1"),
        F.hash("keys").alias("s2"),
        n.alias("n"),
        parity(lambda k: one).alias("parity"),
        # Of those words alone whose next bit is set, six places on: with parity a bitmap of 122 bits.
        F.when(n >= LONG_SET, parity(lambda k: k.bitwiseAND(one * 64))).otherwise(0 * one).alias("upper"),
        F.transform(F.slice("keys", F.lit(1), prefix_length(n).cast("int")), _short).alias("prefix"),
    )


def _reach(entry: Callable[[str], Column]) -> Column:
    return F.shiftright(entry("span"), 32)


def _limit(entry: Callable[[str], Column]) -> Column:
    return entry("span").bitwiseAND(F.lit(0x7FFFFFFF))


def _may_match(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Filters on two postings of one word; a is the earlier set."""
    earlier = (a("doc") < b("doc")) | ((a("doc") == b("doc")) & (a("line") < b("line")))
    within = (a("n") <= _limit(b)) & (b("n") <= _reach(a))
    # In the band of the larger one, and not in a further one as well.
    home = a("span").bitwiseOR(b("span")).bitwiseAND(F.lit(HOME)) != 0
    return within & home & earlier & _near(a, b)


def _near(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """False only if the bitmaps of two sets differ in more places than similar sets do."""
    both = a("n") + b("n")
    upper = F.when(F.least(a("n"), b("n")) >= LONG_SET, a("upper").bitwiseXOR(b("upper"))).otherwise(F.lit(0).cast("long"))
    lower = a("parity").bitwiseXOR(b("parity")).bitwiseXOR(F.shiftrightunsigned(upper, 6))
    # Twice the common words, for each of which the needed share of both sizes.
    return (both - F.bit_count(upper) - F.bit_count(lower)) * (NUMERATOR + DENOMINATOR) >= both * (2 * NUMERATOR)


def distinct_sets(docs: DataFrame) -> DataFrame:
    """doc, line, n, parity, upper, prefix of the first line of each set; ``copy`` marks its other lines."""
    rows = stored(line_sets(docs), "line-rows")
    group = ["s1", "s2", "n", "parity", "upper"]
    place = F.struct("doc", "line")
    # A line that very many documents hold is one row a task before it is shuffled.
    several = rows.groupBy(*group).agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copy = F.coalesce(place > F.col("first"), F.lit(False))
    known = rows.join(several, group, "left")
    return known.select(
        "doc", "line", "n", "parity", "upper", F.when(~copy, F.col("prefix")).alias("prefix"), copy.alias("copy")
    )


ENTRY = ["doc", "line", "n", "parity", "upper"]


def leads(sets: DataFrame) -> DataFrame:
    """doc, line and the places of at most LEAD_WORDS earlier sets that may be similar.

    Few words are frequent; they meet their leads by a join, since a window would gather each
    such word in one task.
    """
    # The smallest hashes of a prefix: near copies have most of them in common.
    few = F.slice(F.sort_array("prefix"), 1, LEAD_WORDS)
    spread = sets.select(*ENTRY, "prefix", F.explode(few).alias("key"))
    rare, frequent = spread.drop("prefix").where("key >= 0"), spread.where((F.array_min("prefix") < 0) & (F.col("key") < 0))
    first = Window.partitionBy("key").orderBy("doc", "line").rowsBetween(Window.unboundedPreceding, 0)
    least = frequent.groupBy("key").agg(F.min(F.struct(*ENTRY)).alias("lead"))
    met = rare.select("*", F.first(F.struct(*ENTRY)).over(first).alias("lead")).unionByName(
        frequent.drop("prefix").join(least, "key")
    )
    lead = lambda c: F.col(f"lead.{c}")
    other = (lead("doc") < F.col("doc")) | (lead("line") < F.col("line"))
    sizes = (lead("n") * DENOMINATOR >= F.col("n") * NUMERATOR) & (F.col("n") * DENOMINATOR >= lead("n") * NUMERATOR)
    led = met.where(other & sizes & _near(lead, F.col))
    return led.select("doc", "line", "lead.doc", "lead.line").toDF(*PAIR).distinct()


def postings(sets: DataFrame, removed: DataFrame) -> DataFrame:
    """The prefix words of all sets: key, ENTRY, and span, which holds reach (high) and limit (low half).

    ``limit`` is the size of earlier sets that a set is compared with: none if it is removed.
    In one column, so that both sides of a join on these rows have the same columns. The key
    is the word and a band of sizes: those of the set's size up to its reach, so that two
    similar sets meet in the band of the larger one. Between reach and limit stands whether
    the band is that of the set's own size.
    """
    known = sets.join(removed.withColumn("gone", F.lit(True)), ["doc", "line"], "left")
    within = F.greatest(reach(F.col("n"), F.col("at")), F.lit(0))
    spread = known.select(*ENTRY, "gone", F.posexplode("prefix").alias("at", "word")).select(
        *ENTRY, "gone", "word", within.alias("within")
    )
    band = lambda size: F.floor(F.log(size) / F.log(F.lit(BAND))).cast("int")
    up = F.greatest(F.col("within"), F.col("n"))
    bands = spread.select("*", F.explode(F.sequence(band(F.col("n")), band(up))).alias("band"))
    key = F.shiftleft(F.col("word").cast("long"), 8).bitwiseOR(F.col("band").cast("long"))
    wide = F.col("within").cast("long")
    home = F.when(F.col("band") == band(F.col("n")), F.lit(HOME)).otherwise(0)
    span = F.shiftleft(wide, 32).bitwiseOR(home).bitwiseOR(F.when(F.col("gone").isNull(), wide).otherwise(0))
    return bands.select(key.alias("key"), *ENTRY, span.alias("span"))


PAIR = ["doc", "line", "other_doc", "other_line"]


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc, line) of those pairs whose whole word sets are similar."""
    other = pairs.select(F.col("other_doc").alias("doc"), F.col("other_line").alias("line"))
    wanted = stored(pairs.select("doc", "line").union(other).distinct(), "lines-wanted")
    in_doc = sieve(wanted, "doc")
    at_line = sieve(wanted.select(F.xxhash64("doc", "line").alias("place")), "place")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    # Only documents that may hold a wanted line are taken apart again.
    lines = (
        docs.where("text is not null")
        .select(doc.alias("doc"), "text")
        .where(passes(in_doc, F.col("doc")))
        .select("doc", F.posexplode(F.split("text", "\n")).alias("line", "string"))
        .where(passes(at_line, F.xxhash64("doc", "line")))
        .join(wanted, ["doc", "line"])
    )
    # Lines travel as strings, a fraction of the size of their word arrays.
    lines = stored(lines, "lines-compared")
    both = pairs.join(lines, ["doc", "line"]).join(
        lines.toDF("other_doc", "other_line", "other"), ["other_doc", "other_line"]
    )
    # Exploding one array makes it once, although the test uses it several times.
    sets = F.struct(*(F.array_distinct(_words(F.col(c))).alias(c) for c in ("string", "other")))
    met = both.select("doc", "line", F.explode(F.array(sets)).alias("w")).select(
        "doc", "line", F.size("w.string").alias("n"), F.size("w.other").alias("m"),
        F.size(F.array_intersect("w.string", "w.other")).alias("common"),
    )
    similar = F.col("common") * DENOMINATOR >= (F.col("n") + F.col("m") - F.col("common")) * NUMERATOR
    return met.where((F.col("common") > 0) & similar).select("doc", "line").distinct()


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc and line of every line to remove; doc is doc_id, null as the last."""
    lines = stored(distinct_sets(docs), "line-sets")
    sets = lines.where("not copy").drop("copy")
    firsts = stored(leads(sets), "line-leaders")
    by_first = stored(verified(docs, firsts), "line-matched")
    posted = postings(sets, by_first)
    side = lambda name: lambda c: F.col(f"{name}.{c}")
    # Both sides are one shuffle: which sets are compared is told by their limit.
    met = posted.alias("b").join(posted.alias("a"), (F.col("a.key") == F.col("b.key")) & _may_match(side("a"), side("b")))
    pairs = met.select("b.doc", "b.line", "a.doc", "a.line").toDF(*PAIR).distinct()
    rest = stored(pairs.join(firsts, PAIR, "left_anti"), "line-rest")
    return lines.where("copy").select("doc", "line").union(by_first).union(verified(docs, rest))


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed and the removed line numbers.

    Lines end at line feeds and are numbered from 0; words are lower-cased and end at white
    space. A line is removed if an earlier one (by doc_id, then number) has the same set of
    words or a Jaccard similarity of at least 0.8 with it, whether or not that one is
    removed itself. Lines without words are kept. A null text has no lines; documents
    without doc_id come last and are judged together. Rows that repeat a doc_id and text
    are one document. Other columns are not looked at.
    """
    gone = removed_lines(docs).groupBy("doc").agg(F.sort_array(F.collect_set("line")).alias("gone"))
    own = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    return own.join(gone, "doc", "left").select(
        "doc_id",
        "n_lines",
        F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines taken out of the texts; n_chars is left as it is."""
    gone = removed_lines(docs).groupBy("doc").agg(F.collect_set("line").alias("_gone"))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    joined = docs.withColumn("_doc", own).join(gone.withColumnRenamed("doc", "_doc"), "_doc", "left")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)
