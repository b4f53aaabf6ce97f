"""Line dedup by an exact set-similarity join, with DataFrame functions alone.

A line is the set of its words. Lines of one set are a class, known by its earliest line; all others of it go. Only classes
are joined, so copies of a line, however many, take part once. Words are ordered from rare to frequent; two sets of
similarity t share a word among the first ``n - ceil(t n) + 1`` of each, so only those prefixes are matched. Matches are
dropped where the set sizes, the places of the shared word or the sets' bitmaps (each word flips one bit) can't allow the
similarity; the rest is verified on the whole sets.

A class goes if an earlier class is similar to it: an earlier line that resembles its first line has a class whose own first
line is earlier still. Large groups of near copies are thinned out first: classes that have a least or greatest word hash
in common with more than ``HOT`` others are compared with the earliest of these. Pairs of two classes that go by that are
not compared again.

Rarity is counted over all texts in a fixed number of buckets of word hashes. Any order of words gives the same result;
the counts only make prefixes selective. Texts are shuffled only for documents with lines to verify or to remove, as far
as a bitmap of hashes can tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import named, whole_row
from millrace.llm.tables import written

#: Least Jaccard similarity of a line to an earlier one that removes it, in hundredths.
PERCENT = 80
#: Buckets in which word frequencies are counted.
BUCKET_BITS = 17
#: Bits of a word's code below its rank.
LOW_BITS = 56
#: Groups of more classes are first compared with their earliest class.
HOT = 1000
#: The greatest set size that a tag holds.
MOST = (1 << 20) - 1
#: Words above which a set has a second bitmap.
LONG = 50
#: Bits of the map of rows that a join is about.
MAP_BITS = 24
#: What names a line: its document, a hash of the document's text (rows of one id may differ), its number.
LINE = ["doc", "version", "line"]


def _words(line: Column) -> Column:
    """A line's words, repeats included: runs of characters other than white space, in lower case."""
    spaced = F.lower(line)
    for other in "\t\n\x0b\f\r":  # one plain blank to split at takes half the time of a pattern
        spaced = F.replace(spaced, F.lit(other), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = F.coalesce(named(text).cast("string"), F.lit(""))
    return docs.select(named(doc_id).alias("doc"), F.xxhash64(content).alias("version"), content.alias("text")).filter("doc IS NOT NULL")


def rarity(docs: DataFrame, text: str) -> Column:
    """The rank of each bucket of word hashes by how many words of lines it has: four ranks for each doubling."""
    words = docs.select(F.explode(_words(named(text).cast("string"))).alias("word"))
    words = words.select(_bucket(F.xxhash64("word")).alias("bucket"))
    ranks = ["0"] * (1 << BUCKET_BITS)
    for bucket, rank in words.groupBy("bucket").agg(F.floor(4 * F.log2(F.count("*"))).cast("int")).collect():
        ranks[bucket] = str(min(rank, 127))
    return F.split(F.lit(",".join(ranks)), ",").cast("array<tinyint>")


def _hashes(line: Column) -> Column:
    """The distinct words of a line, as hashes."""
    return F.array_distinct(F.transform(_words(line), lambda word: F.xxhash64(word)))


def _codes(hashes: Column, ranks: Column) -> Column:
    """The hashes as sorted numbers, rare ones first: rank of the bucket above, hash below."""
    low = F.lit((1 << LOW_BITS) - 1)
    code = lambda h: F.shiftleft(F.get(ranks, _bucket(h)).cast("bigint"), LOW_BITS).bitwiseOR(h.bitwiseAND(low))
    return F.sort_array(F.transform(hashes, code))


def _may_match(percent: int) -> Column:
    """Length and bitmap filter for rows (n, bits) and (fn, fbits)."""
    differ = F.bit_count(F.col("bits").bitwiseXOR(F.col("fbits")))
    return (
        (F.least("n", "fn") * 100 >= F.greatest("n", "fn") * percent)
        & (differ * (100 + percent) <= (F.col("n") + F.col("fn")) * (100 - percent))
    )


def _meet(percent: int) -> Column:
    """Order, length, bitmap and positional filter for rows (bits, tag) and (fbits, ftag) that share a prefix word. Sizes and
    places above what a tag holds are cut to that, which only lets more pairs pass."""
    n, fn = [F.shiftright(t, 11).bitwiseAND(F.lit(MOST)) for t in ("tag", "ftag")]
    pos, fpos = [F.shiftright(t, 1).bitwiseAND(F.lit(1023)) for t in ("tag", "ftag")]
    differ = F.bit_count(F.col("bits").bitwiseXOR(F.col("fbits")))
    return (
        (n * 100 >= fn * percent)
        & ((n < fn) | ((n == fn) & ((F.col("bits") < F.col("fbits")) | ((F.col("bits") == F.col("fbits")) & (_name("tag") < _name("ftag"))))))
        & (differ * (100 + percent) <= (n + fn) * (100 - percent))
        & (F.least(n - pos, fn - fpos) * (100 + percent) >= (n + fn) * percent)
        & (F.col("tag").bitwiseAND(F.col("ftag")).bitwiseAND(F.lit(1)) == 0)
    )


def _halves_may_match(percent: int) -> Column:
    """For two classes l and e, the later of which may still go: the bitmap filter by halves, if both have them."""
    half = F.col("l.half").bitwiseXOR(F.col("e.half"))
    differ = F.bit_count(half) + F.bit_count(half.bitwiseXOR(F.col("l.bits")).bitwiseXOR(F.col("e.bits")))
    fits = differ * (100 + percent) <= (F.col("l.n") + F.col("e.n")) * (100 - percent)
    return (F.col("l.went") == 0) & ((F.least("l.n", "e.n") <= LONG) | fits)


def _name(tag: str) -> Column:
    """A tag without what differs between the words of a class."""
    return F.col(tag).bitwiseAND(F.lit(-1 << 11))


def _marked(docs: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """docs and a column ``marked``: true for all rows whose key is wanted, and false for nearly all others."""
    at = F.pmod(F.xxhash64(*key), F.lit(1 << MAP_BITS))
    place = wanted.select(F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit"))
    maps = place.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("map"))
    docs = docs.withColumn("part", F.bitmap_bucket_number(at)).withColumn("bit", F.bitmap_bit_position(at))
    docs = docs.join(F.broadcast(maps), "part", "left")
    byte = F.conv(F.hex(F.substr("map", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False))
    return docs.withColumn("marked", marked).drop("part", "bit", "map")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Later lines of the pairs whose whole sets are similar enough."""
    pairs = written(pairs, "pairs")
    ends = pairs.select(*LINE).union(pairs.select(*[f"f{c}" for c in LINE])).distinct()
    wanted = written(ends.groupBy("doc", "version").agg(F.collect_list("line").alias("wanted")), "wanted")  # lines of one document
    mine = _marked(texts, wanted, ["doc", "version"]).filter("marked").drop("marked").join(wanted, ["doc", "version"])
    sets = mine.select("doc", "version", F.explode("wanted").alias("line"), F.split("text", "\n").alias("all"))
    sets = sets.select(*LINE, _hashes(F.get("all", F.col("line"))).alias("set"))
    sets = written(sets.dropDuplicates(LINE), "sets")  # rows of one id and text are one document
    other = sets.toDF(*[f"f{c}" for c in LINE], "fset")
    both = pairs.join(sets, LINE).join(other, [f"f{c}" for c in LINE])
    common = F.size(F.array_intersect("set", "fset"))
    either = F.size("set") + F.size("fset") - F.col("common")
    return both.withColumn("common", common).filter(F.col("common") * 100 >= either * percent).select(*LINE).distinct()


def _line_classes(texts: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """One row for each set of words: its earliest line, hash, size, bitmap, three of its word hashes, and its prefix."""
    flip = lambda acc, h: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int")))
    lines = texts.select("doc", "version", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    lines = lines.select(*LINE, _hashes(F.col("content")).alias("hashes")).withColumn("codes", _codes(F.col("hashes"), ranks))
    codes, hashes, n = F.col("codes"), F.col("hashes"), F.size("codes")
    prefix = F.slice(codes, 1, (n - F.ceil(n * percent / 100) + 1).cast("int"))
    # The bitmap of about half the words: with that of all, it gives those of both halves.
    half = F.when(n > LONG, F.aggregate(F.filter(hashes, lambda h: h.bitwiseAND(F.lit(64)) == 0), F.lit(0).cast("bigint"), flip)).otherwise(0)
    turned = F.transform(hashes, lambda h: F.shiftleft(h, 32))
    lines = lines.select(
        *LINE, F.xxhash64(codes).alias("k1"), F.xxhash64(F.sort_array(hashes)).alias("k2"), n.alias("n"),
        F.aggregate(hashes, F.lit(0).cast("bigint"), flip).alias("bits"), half.alias("half"),
        F.array(F.array_min(hashes), F.array_max(hashes), F.array_min(turned)).alias("ends"),
        # 32 bits of a prefix word will do: what meets by chance is filtered and verified.
        F.transform(prefix, lambda c: F.shiftright(F.shiftleft(c, 32), 32).cast("int")).alias("prefix"),
    )
    # Combined before the shuffle, so a line of a million copies is as cheap as one.
    kept = F.min(F.struct(*LINE, "n", "bits", "half", "ends", "prefix"))
    return lines.groupBy("k1", "k2").agg(kept.alias("e")).select("k1", "e.*").filter("n > 0")


def first_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc, version, first): the lines with words that no earlier line is equal or similar to, of documents that have any."""
    texts = _texts(docs, doc_id, text)
    classes = written(_line_classes(texts, rarity(docs, text), percent), "classes")
    earlier = F.struct(*[f"f{c}" for c in LINE]) < F.struct(*LINE)
    both = [*LINE, *[f"f{c}" for c in LINE]]

    # Classes of large groups, against the earliest of their groups.
    hot = classes.select(F.explode("ends").alias("end")).groupBy("end").count().filter(F.col("count") > HOT)
    hot = written(hot.select("end"), "hot")  # fewer than three classes in HOT
    rows = classes.select(*LINE, "n", "bits", F.explode("ends").alias("end")).join(F.broadcast(hot), "end")
    first = rows.groupBy("end").agg(F.min(F.struct(*LINE, "n", "bits")).alias("f"))
    first = first.select("end", *[F.col(f"f.{c}").alias(f"f{c}") for c in (*LINE, "n", "bits")])
    pairs = rows.join(F.broadcast(first), "end").filter(earlier & _may_match(percent)).select(*both).distinct()
    gone = written(_verified(pairs, texts, percent), "gone")

    # All classes with a word of their prefixes in common, but for pairs of two that went above. As there are so many rows,
    # they have three numbers: word, bitmap, and a tag of 33 bits of hash, 20 of size, 10 of the word's place, one if gone.
    known = classes.join(gone.withColumn("went", F.lit(1)), LINE, "left").withColumn("went", F.coalesce("went", F.lit(0)))
    known = known.withColumn("tag", F.col("k1").bitwiseAND(F.lit(-1 << 31)).bitwiseOR(F.shiftleft(F.least("n", F.lit(MOST)).cast("bigint"), 11)))
    place = F.shiftleft(F.least("pos", F.lit(1023)).cast("bigint"), 1)
    rows = known.select("bits", "tag", "went", F.posexplode("prefix").alias("pos", "word"))
    rows = rows.select("word", "bits", (F.col("tag") + place + F.col("went")).alias("tag"))
    pairs = rows.join(rows.toDF("word", "fbits", "ftag"), "word").filter(_meet(percent))
    pairs = pairs.select("bits", _name("tag").alias("tag"), "fbits", _name("ftag").alias("ftag")).distinct()
    pairs = written(pairs, "matches")
    ends = pairs.select("bits", "tag").union(pairs.select("fbits", "ftag"))
    names = _marked(known.select("bits", "tag", F.struct(*LINE, "went", "n", "bits", "half").alias("one")), ends, ["bits", "tag"])
    names = names.filter("marked").drop("marked")
    pairs = pairs.join(names, ["bits", "tag"]).join(names.toDF("fbits", "ftag", "two"), ["fbits", "ftag"])
    pairs = pairs.select(F.greatest("one", "two").alias("l"), F.least("one", "two").alias("e")).filter(_halves_may_match(percent))
    pairs = pairs.select(*[F.col(f"l.{c}").alias(c) for c in LINE], *[F.col(f"e.{c}").alias(f"f{c}") for c in LINE]).distinct()
    gone = gone.union(written(_verified(pairs, texts, percent), "gone"))
    all_ = classes.select(*LINE, F.lit(False).alias("went")).union(gone.withColumn("went", F.lit(True)))
    lists = all_.groupBy("doc", "version").agg(F.collect_list(F.when(~F.col("went"), F.col("line"))).alias("all"), F.collect_set(F.when(F.col("went"), F.col("line"))).alias("went"))
    return lists.select("doc", "version", F.array_except("all", "went").alias("first")).filter(F.size("first") > 0)


def repeated_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc, line) of every line that an earlier one is equal or similar to, in ascending order of (doc_id, line)."""
    removed = dedup_lines(docs, doc_id=doc_id, text=text, percent=percent, keep=[doc_id])
    return removed.select(F.col("row").getField(doc_id).alias("doc"), F.explode("removed").alias("line")).distinct()


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, keep=None) -> DataFrame:
    """``row`` (a struct of the kept columns of docs, default all), ``n_lines``, ``removed`` (line numbers, ascending) and
    ``kept`` (the text without them).

    Lines end at line feeds. A line goes if some earlier line (smaller doc_id, or the same and an earlier line) has an
    equal word set, or one of a Jaccard similarity of ``percent`` hundredths or more; all lines are judged on the input.
    Lines without words stay. Null texts are empty: one line without words. Rows of one doc_id and one text are one
    document, and are left alike; rows of one doc_id and different texts are documents of their own, in the order of a hash
    of their texts. Rows without a doc_id stay as they are. Extra columns pass through.
    """
    first = written(first_lines(docs, doc_id=doc_id, text=text, percent=percent), "first")
    content = F.coalesce(named(text).cast("string"), F.lit(""))
    rows = docs.select(whole_row(docs, keep).alias("row"), named(doc_id).alias("doc"), F.xxhash64(content).alias("version"), F.split(content, "\n").alias("lines"))
    # Only documents with lines to remove, fewer of which are first than have words, need to meet their lines.
    with_words = rows.select("doc", "version", F.size(F.filter("lines", lambda line: line.rlike(r"\S"))).alias("n")).filter("n > 0 AND doc IS NOT NULL")
    some = with_words.join(first, ["doc", "version"], "left").filter(F.col("n") > F.coalesce(F.size("first"), F.lit(0)))
    rows = _marked(rows, written(some.select("doc", "version"), "some"), ["doc", "version"])
    joined = rows.filter("marked").join(first, ["doc", "version"], "left").withColumn("first", F.coalesce("first", F.array().cast("array<int>")))
    words = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("lines", i).rlike(r"\S"))
    joined = joined.withColumn("removed", F.array_except(words, F.col("first")))
    kept = F.array_join(F.filter("lines", lambda _, i: ~F.array_contains("removed", i)), "\n")
    joined = joined.select("row", F.size("lines").alias("n_lines"), "removed", F.when(F.size("removed") == 0, F.array_join("lines", "\n")).otherwise(kept).alias("kept"))
    others = rows.filter(~F.col("marked"))
    return joined.union(others.select("row", F.size("lines"), F.array().cast("array<int>"), F.array_join("lines", "\n")))
