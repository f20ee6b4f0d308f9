"""Fuzzy deduplication of lines across documents, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.components import connected_components
from rowloom.llm.shared import store

#: 64-bit words of a SimHash. Each is cut into PIECES pieces of 16 bits, and every two pieces of a word make a block.
WORDS, PIECES = 4, 4
#: Lines whose SimHashes differ in at most so many bits share a block: to leave no two pieces of a word equal takes
#: differences in PIECES - 1 pieces of every word.
RADIUS = WORDS * (PIECES - 1) - 1
#: Lines that share a block and differ in more bits are not compared by edit distance (of 64 * WORDS bits; unrelated
#: lines differ in about half, lines within the radius in RADIUS at most).
MOST_BITS = 80
#: Words of a line whose votes are counted in one byte a bit.
VOTERS = 127
_ONES = 0x0101010101010101
#: Ids that are broadcast to filter a table: 16 bytes each, 32 MB at most.
BROADCAST_IDS = 2_000_000
#: Lines of one chunk when a block is compared pair by pair.
CHUNK_ROWS = 64
#: Lines of fewer words are never removed, unless they have so many code points.
LEAST_WORDS, LEAST_CHARS = 3, 20
#: Edits up to which distances are sought first.
FEW_EDITS = 16
#: Lines are alike whose edit distance is at most this share (percent) of the longer one's code points.
EDITS_PERCENT = 15


def normalised(text: Column) -> Column:
    """The lines of a text: letters and digits in lower case, anything between them as one space, some at the ends."""
    return F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " "), "\n")


def lines_of(docs: DataFrame) -> DataFrame:
    """key, doc (a hash of key and text), line (its number from 0), id (hash of the plain line) and plain (normalised).

    Lines of fewer than LEAST_WORDS words, in letters and
    digits, and fewer than LEAST_CHARS code points are left out, and so are those without letters and digits.
    """
    parts = F.posexplode(normalised(F.coalesce("text", F.lit(""))))  # once a text, before any line is looked at
    cut = docs.where("key IS NOT NULL").select("key", _doc().alias("doc"), parts)
    cut = cut.select("key", "doc", F.col("pos").alias("line"), F.trim("col").alias("plain"))
    blanks = F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(" ")))
    large = (blanks >= LEAST_WORDS - 1) | (F.char_length("plain") >= LEAST_CHARS)
    return cut.where(large).select("key", "doc", "line", F.xxhash64("plain").alias("id"), "plain")


def _doc() -> Column:
    """Tells rows of one key apart by their texts."""
    return F.xxhash64("key", "text")


def simhashes(lines: DataFrame) -> DataFrame:
    """id, h0 to h{WORDS - 1} (bigint): the SimHash of each distinct line, made once however often it stands there.

    A bit is set where more than half of the line's distinct words have it set in their hashes: were repeats counted,
    the commonest words would make unrelated lines alike. The bits are
    counted in bytes, eight to a long, over VOTERS words at a time and then in full, so a line may have any number of
    words. Once lines are dealt by id, no row moves between tasks.
    """
    distinct = lines.groupBy("id").agg(F.any_value("plain").alias("plain"))
    words = distinct.select("id", F.posexplode(F.array_distinct(F.split("plain", " "))).alias("at", "word"))
    hashed = words.select("id", F.expr(f"at div {VOTERS}").alias("part"), *[F.xxhash64(F.lit(w), "word").alias(f"h{w}") for w in range(WORDS)])
    planes = [F.sum(F.shiftrightunsigned(f"h{w}", k).bitwiseAND(F.lit(_ONES))).alias(f"s{w}_{k}") for w in range(WORDS) for k in range(8)]
    parts = hashed.groupBy("id", "part").agg(F.count("*").alias("n"), *planes)
    part = F.struct("n", F.array(*[f"s{w}_{k}" for w in range(WORDS) for k in range(8)]).alias("s"))
    held = parts.groupBy("id").agg(F.collect_list(part).alias("parts"))
    bits = F.when(F.size("parts") == 1, _bits_of_one(F.get("parts", F.lit(0)))).otherwise(_bits_of_many(F.col("parts")))
    voted = held.select("id", bits.alias("bits"))
    return voted.select("id", *[reduce(Column.bitwiseOR, [F.shiftleft(F.get("bits", F.lit(8 * w + k)), k) for k in range(8)]).alias(f"h{w}") for w in range(WORDS)])


def _bits_of_one(part: Column) -> Column:
    """For each count of 8 bytes, a 1 in every byte that more than half of n reaches.

    Bytes are taken as two sets of four 16-bit lanes; c > n div 2 where c + 255 - n div 2 carries into a lane's bit 8.
    """
    lift = (F.lit(255) - F.expr("parts[0].n div 2")) * F.lit(0x0001000100010001)
    lane, carry = F.lit(0x00FF00FF00FF00FF), F.lit(0x0100010001000100)

    def voted(s: Column, lift: Column) -> Column:
        even, odd = [(x.bitwiseAND(lane) + lift).bitwiseAND(carry) for x in (s, F.shiftrightunsigned(s, 8))]
        return F.shiftrightunsigned(even, 8).bitwiseOR(odd)

    return _with(lift, lambda one: F.transform(part["s"], lambda s: voted(s, one)))


def _bits_of_many(parts: Column) -> Column:
    """The same where a line's words were counted in several parts."""
    total = F.aggregate(parts, F.lit(0).cast("bigint"), lambda sum_, p: sum_ + p["n"])

    def voted(plane: Column, n: Column) -> Column:
        def count(f: int) -> Column:
            byte = lambda p: F.shiftrightunsigned(F.get(p["s"], plane), 8 * f).bitwiseAND(F.lit(255))
            return F.aggregate(parts, F.lit(0).cast("bigint"), lambda sum_, p: sum_ + byte(p))

        return reduce(Column.bitwiseOR, [F.when(count(f) * 2 > n, F.lit(1 << 8 * f).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for f in range(8)])

    return _with(total, lambda n: F.transform(F.sequence(F.lit(0), F.lit(8 * WORDS - 1)), lambda plane: voted(plane, n)))


def blocks() -> Column:
    """The blocks of a SimHash: for every two pieces of a word, the bits of both and which pieces they are."""
    found = []
    for w in range(WORDS):
        pieces = [F.shiftrightunsigned(f"h{w}", 16 * p).bitwiseAND(F.lit(0xFFFF)) for p in range(PIECES)]
        for low, high in combinations(pieces, 2):
            found.append(F.lit(len(found) << 32) + F.shiftleft(high, 16) + low)
    return F.array(*found)


def _near(left: str, right: str) -> Column:
    """Whether two SimHashes differ in at most MOST_BITS bits: columns h0, ... with these suffixes."""
    differing = [F.bit_count(F.col(f"h{w}{left}").bitwiseXOR(F.col(f"h{w}{right}"))) for w in range(WORDS)]
    return reduce(Column.__add__, differing) <= MOST_BITS


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value being made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _equal_words(left: Column, right: Column) -> Column:
    """How many words two lists begin with in common."""
    unlike = F.array_position(F.zip_with(left, right, lambda x, y: x.eqNullSafe(y)), False)
    return F.least(F.coalesce(F.nullif(unlike, F.lit(0)) - 1, F.size(left)), F.size(left), F.size(right)).cast("int")


def _middles(left: Column, right: Column) -> Column:
    """l and r: the words of two lines without the ones that both begin or end with."""

    def cut(words: Column) -> Column:
        one, two = words["l"], words["r"]
        first = _equal_words(one, two)
        last = F.least(_equal_words(F.reverse(one), F.reverse(two)), F.least(F.size(one), F.size(two)) - first)
        ends = F.struct(first.alias("first"), (first + last).alias("both"))
        return _with(ends, lambda e: F.struct(*[F.slice(words[c], e["first"] + 1, F.size(words[c]) - e["both"]).alias(c) for c in "lr"]))

    return _with(F.struct(F.split(left, " ").alias("l"), F.split(right, " ").alias("r")), cut)


def _edits(left: Column, right: Column, most: Column) -> Column:
    """The edit distance of two texts, or -1 where it is above `most`: work grows with the bound, so a small one comes first."""
    first = F.call_function("levenshtein", left, right, F.least(most, F.lit(FEW_EDITS)))
    return _with(first, lambda d: F.when((d >= 0) | (most <= FEW_EDITS), d).otherwise(F.call_function("levenshtein", left, right, most)))


def _within_by_words(one: Column, two: Column, most: Column) -> Column:
    """True where edits of whole words already show two lists of words to be within an edit distance; else false.

    Place by place: words at one place cost the longer one at most. By the edit distance of the lists, words being
    characters numbered in their union: k edits cost at most the k longest of all words, with a blank each.
    """
    costs = F.zip_with(one, two, lambda x, y: F.when(x == y, 0).otherwise(F.greatest(F.char_length(x), F.char_length(y))))
    placed = (F.size(one) == F.size(two)) & (F.aggregate(costs, F.lit(0), lambda total, c: total + c) <= most)
    union = F.array_union(one, two)

    def by_edits(held: Column) -> Column:
        def spelled(words: Column) -> Column:
            numbers = F.transform(words, lambda w: F.lpad(F.hex(F.array_position(held["union"], w)), 4, "0"))
            return F.decode(F.unhex(F.array_join(numbers, "")), "UTF-16BE")

        lengths = F.sort_array(F.transform(F.concat(one, two), lambda w: F.char_length(w) + 1), asc=False)
        spelt = F.struct(spelled(one).alias("l"), spelled(two).alias("r"))
        edits = _with(spelt, lambda s: _edits(s["l"], s["r"], F.floor(most / 2).cast("int")))
        longest = lambda k: F.aggregate(F.slice(lengths, 1, k), F.lit(0), lambda total, n: total + n)
        return _with(edits, lambda k: (k >= 0) & (longest(F.greatest(k, F.lit(0))) <= most))

    # numbers stay below the code units that UTF-16 pairs up
    edited = F.when(F.size(union) < 0xD800, _with(F.struct(union.alias("union")), by_edits)).otherwise(False)
    return F.when(placed, True).otherwise(edited)


def _alike(left: Column, right: Column, percent: int) -> Column:
    """Whether two whole lines' edit distance is at most `percent` of the longer one's code points.

    Words that both begin or end with do not change the distance, and most lines that are compared differ in a few
    words; only where edits of whole words do not decide are the code points between compared.
    """
    most = F.floor(F.greatest(F.char_length(left), F.char_length(right)) * percent / 100).cast("int")
    close = F.abs(F.char_length(left) - F.char_length(right)) <= most

    def within(cut: Column) -> Column:
        def text(words: Column) -> Column:
            return F.array_join(F.transform(words, lambda w: F.concat(w, F.lit(" "))), "")

        texts = F.struct(text(cut["l"]).alias("l"), text(cut["r"]).alias("r"))
        whole = _with(texts, lambda t: _edits(t["l"], t["r"], most)) >= 0
        return F.when(_within_by_words(cut["l"], cut["r"], most), True).otherwise(whole)

    return F.when(close, _with(_middles(left, right), within)).otherwise(False)


def _few(rows: DataFrame) -> DataFrame:
    """The distinct rows, to be broadcast where there are at most BROADCAST_IDS of them."""
    named = store(rows.distinct(), "few")
    return F.broadcast(named) if named.count() <= BROADCAST_IDS else named


def _led(hashed: DataFrame) -> DataFrame:
    """bucket, a, b: for each block that several lines share, its smallest id a and every id b."""
    keyed = hashed.select("id", F.explode(blocks()).alias("bucket"))
    shared = _few(keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"))
    members = store(keyed.join(shared, "bucket"), "members")
    first = members.groupBy("bucket").agg(F.min("id").alias("a"))
    return members.join(_few(first), "bucket").select("bucket", "a", F.col("id").alias("b"))


def _named(lines: DataFrame, hashed: DataFrame, ids: DataFrame) -> DataFrame:
    """id, norm (the plain line) and SimHash of the lines that share a block: a stored table."""
    few = _few(ids)
    norms = lines.select("id", F.col("plain").alias("norm")).join(few, "id", "left_semi")
    norms = norms.groupBy("id").agg(F.any_value("norm").alias("norm"))
    return store(norms.join(hashed.join(few, "id", "left_semi"), "id"), "norms")


def line_groups(lines: DataFrame, percent: int = EDITS_PERCENT) -> DataFrame:
    """id and component of the lines that are alike with others, over any number of steps; lines is read twice.

    Two lines are compared where they share a block: first each with the block's smallest id, then, where
    a block still holds several components, every two of different components, which then join those. For that the block is cut into chunks
    of about CHUNK_ROWS lines, and each two chunks meet on a key of their own, so that one block's work is dealt to
    many tasks and only alike lines become pairs. Edit distances are taken of those whose SimHashes are near.
    """
    hashed = store(simhashes(lines), "simhashes")
    led = store(_led(hashed), "blocks")
    named = _named(lines, hashed, led.select(F.col("b").alias("id")))

    def side(end: str) -> DataFrame:
        return named.select(*[F.col(c).alias(end if c == "id" else f"{c}_{end}") for c in named.columns])

    alike = _near("_a", "_b") & _alike(F.col("norm_a"), F.col("norm_b"), percent)
    stars = led.where("a <> b").select("a", "b").distinct()
    links = store(stars.join(side("a"), "a").join(side("b"), "b").where(alike).select("a", "b"), "links")
    found = connected_components(links).withColumnRenamed("node", "b")
    placed = led.select("bucket", "b").join(found, "b", "left").withColumn("component", F.coalesce("component", "b"))
    placed = store(placed, "placed")
    held = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    held = held.where("low < high AND n > 2").select("bucket", F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("chunks"))
    dealt = placed.join(_few(held), "bucket").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
    dealt = dealt.join(side("b"), "b").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    place = {"b": "a", "component": "of_a", "norm_b": "norm_a"} | {f"h{w}_b": f"h{w}_a" for w in range(WORDS)}
    one = dealt.where("chunk <= k").select("bucket", F.col("chunk").alias("i"), F.col("k").alias("j"), *[F.col(c).alias(n) for c, n in place.items()])
    two = dealt.where("k <= chunk").select(
        F.col("bucket").alias("bucket_b"), F.col("k").alias("i_b"), F.col("chunk").alias("j_b"), F.col("component").alias("of_b"), *[c for c in place if c != "component"]
    )
    met = (F.col("bucket") == F.col("bucket_b")) & (F.col("i") == F.col("i_b")) & (F.col("j") == F.col("j_b"))
    apart = one.join(two, met & (F.col("of_a") != F.col("of_b")) & alike)
    joined = connected_components(store(apart.select("of_a", "of_b").distinct(), "apart"), "of_a", "of_b")
    nodes = found.select(F.col("b").alias("node"), "component").union(joined.select("node", F.col("node").alias("component"))).distinct()
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("low"))
    return nodes.join(joined, "component", "left").select("node", F.coalesce("low", "component").alias("component"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = EDITS_PERCENT) -> DataFrame:
    """docs with every repeated line but one removed from its text, and n_lines, n_removed behind its columns.

    Lines are cut at newlines, and their letters and digits in lower case are compared. Those of at least LEAST_WORDS
    words or LEAST_CHARS code points that are equal so, or share a block of their SimHashes and are alike in edit
    distance, over any number of steps, are one group; its occurrence in the smallest key's first line stays. Equal
    lines are collapsed before anything is compared, and the lists of lines to remove are joined to the documents
    once. A line without blanks is one word, so its SimHash finds equal lines only.

    Null and empty texts stay as they are, with one line and none removed; smaller lines always stay. A
    row with a null key takes no part and stays whole. Rows that repeat key and text are one document: each keeps the
    same lines; rows of one key with different texts are documents of their own. Other columns are carried along,
    but for those named n_lines and n_removed, which are replaced. An empty table gives an empty result.
    """
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    given = given.select("row", F.col(f"row.`{key}`").alias("key"), F.col(f"row.`{text}`").alias("text"))
    given = given.withColumn("doc", _doc())
    lines = store(lines_of(given), "lines")
    groups = line_groups(lines, percent).withColumnRenamed("node", "id")
    places = lines.select("key", "doc", "line", "id").join(groups, "id", "left")
    places = places.select("key", "doc", "line", F.coalesce("component", "id").alias("root"))
    place = F.struct("key", "line", "doc")
    first = places.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    repeated = places.join(first.where("n > 1").select("root", "first"), "root")
    gone = repeated.where(place != F.col("first")).groupBy("key", "doc")
    gone = store(gone.agg(F.collect_set("line").alias("gone")), "gone")
    cut = F.split("text", "\n")
    every = F.sequence(F.lit(0), F.size(cut) - 1)
    kept = F.array_except(every, F.coalesce("gone", F.array().cast("array<int>")))
    held = F.transform(F.array(cut), lambda whole: F.transform(kept, lambda k: F.get(whole, k)))  # cuts a text once
    shorter = F.array_join(F.flatten(held), "\n")
    joined = given.join(gone, ["key", "doc"], "left")
    columns = [
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(shorter).alias(text)
        if c == text
        else F.col("row")[c].alias(c)
        for c in docs.columns
        if c not in ("n_lines", "n_removed")
    ]
    n_lines = F.when(F.col("text").isNull(), 1).otherwise(F.size(cut)).cast("bigint")
    return joined.select(
        *columns, n_lines.alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed")
    )
