"""Order MinHash fingerprints, in DataFrame functions alone.

The k-mers of a text are its runs of `k` words, told apart by the number of their occurrence. One hash deals them over
`bins` bins; in each bin the `tuple_size` least are selected, put back into text order, and hashed as a tuple, which is
the bin's component. Likeness is the share of equal components among the bins that either text fills. Moving or
changing words changes tuples, so it follows edit distance where plain MinHash only sees the set.

A k-mer is one 63-bit number: bin and hash above, its place (24 bits, so places repeat beyond 16 million words) below.
Sorting those numbers brings bins, least hashes and occurrences together; no rows are made of k-mers and none shuffled.

Defined results: a null text is empty; a text without words fills no bin, and two such texts are alike (1.0); fewer than
k words are one k-mer; equal texts have equal fingerprints. Documents follow each other by descending doc_id, the first
after the last; where a doc_id has several texts, the one with the least hash is meant as next; a row without a
doc_id has no next text. A single document is its own next. An empty table gives an empty result; only `doc_id` and
`text` are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import cut

K, BINS, TUPLE = 3, 32, 2
_PLACE_BITS = 24
_PLACE = (1 << _PLACE_BITS) - 1
_HASH_BITS = 63 - _PLACE_BITS


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _number(h: Column, place: Column) -> Column:
    return F.shiftrightunsigned(h, 1).bitwiseAND(_long(~_PLACE)).bitwiseOR(place.cast("long"))


def _hash(x: Column) -> Column:
    return F.shiftright(x, _PLACE_BITS)


def _bin(x: Column, bins: int) -> Column:
    return F.shiftright(x, 63 - (bins - 1).bit_length())


def _starts(values: Column, part_of: Callable[[Column], Column]) -> Column:
    """Where in sorted `values` a new part begins."""
    at = F.sequence(F.lit(0), F.size(values) - 1)
    return F.filter(at, lambda i: (i == 0) | (part_of(F.get(values, i)) != part_of(F.get(values, i - 1))))


def _pieces(values: Column, starts: Column, body: Callable[[Column], Column]) -> Column:
    def piece(start: Column, number: Column) -> Column:
        stop = F.coalesce(F.get(starts, number + 1), F.size(values))
        return body(F.slice(values, start + 1, stop - start))

    return F.transform(starts, piece)


def _occurrences(numbers: Column) -> Column:
    """Sorted k-mers with second and later occurrences hashed anew with their number."""

    def anew(again: Column) -> Column:
        def run(own: Column) -> Column:
            return F.transform(own, lambda x, n: _number(F.xxhash64(_hash(x), n + 1), x.bitwiseAND(_long(_PLACE))))

        later = let(_starts(again, _hash), lambda s: F.flatten(_pieces(again, s, run)))
        firsts = F.filter(numbers, lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(numbers, i - 1))))
        return F.when(F.size(again) == 0, numbers).otherwise(F.sort_array(F.concat(firsts, later)))

    return let(F.filter(numbers, lambda x, i: (i > 0) & (_hash(x) == _hash(F.get(numbers, i - 1)))), anew)


def _tuple(own: Column) -> Column:
    """The hash of k-mers in text order."""
    placed = F.transform(own, lambda x: F.shiftleft(x.bitwiseAND(_long(_PLACE)), _HASH_BITS).bitwiseOR(_hash(x)))
    ordered = F.transform(F.sort_array(placed), lambda y: y.bitwiseAND(_long((1 << _HASH_BITS) - 1)))
    return F.xxhash64(ordered).cast("long").bitwiseAND(_long(0x7FFFFFFF)).cast("int")


def fingerprint(text: Column, k: int = K, bins: int = BINS, tuple_size: int = TUPLE) -> Column:
    """The components of a text: `bins` integers, NULL where a bin holds no k-mer."""

    def of_words(words: Column) -> Column:
        n = F.when(F.get(words, F.lit(0)) == "", 0).otherwise(F.size(words))
        first = F.slice(words, F.lit(1), F.greatest(n - (k - 1), F.least(n, F.lit(1))))

        def kmer(word: Column, i: Column) -> Column:
            return _number(F.xxhash64(word, *[F.get(words, i + j) for j in range(1, k)]), i % (_PLACE + 1))

        return let(F.sort_array(F.transform(first, kmer)), lambda numbers: let(_occurrences(numbers), of_numbers))

    def of_numbers(numbers: Column) -> Column:
        least = F.filter(numbers, lambda x, i: (i < tuple_size) | (_bin(F.get(numbers, i - tuple_size), bins) != _bin(x, bins)))
        return let(least, lambda held: F.when(F.size(held) > 0, let(_starts(held, lambda x: _bin(x, bins)), lambda s: of_bins(held, s))))

    def of_bins(held: Column, starts: Column) -> Column:
        keys = F.transform(starts, lambda s: _bin(F.get(held, s), bins).cast("int"))
        found = F.map_from_arrays(keys, _pieces(held, starts, _tuple))
        return let(found, lambda m: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.try_element_at(m, b)))

    empty = F.array_repeat(F.lit(None).cast("int"), bins)
    return F.coalesce(let(F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), "[\x20\x09-\x0d]+"), of_words), empty)


def likeness(a: Column, b: Column) -> Column:
    """Equal components over those that either side fills; 1.0 where neither fills any."""
    filled = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda f: f))
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda e: e))
    return F.when(filled == 0, 1.0).otherwise(equal / filled)


def as_text(components: Column) -> Column:
    return F.array_join(F.transform(components, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 8, "0"), F.lit("--------"))), "")


def following(ids: DataFrame) -> DataFrame:
    """(doc_id, for_id, for_n): of each id (with n, of distinct ids) the id that it follows in descending order.

    Ranges of ids are numbered inside their partitions; only one row a partition is put in one order."""
    ranged = cut(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    down = Window.partitionBy("part").orderBy(F.desc("doc_id"))
    inside = ranged.select("doc_id", F.lag("doc_id").over(down).alias("for_id"), F.lag("n").over(down).alias("for_n"), "part")
    edges = ranged.groupBy("part").agg(F.min(F.struct("doc_id", "n")).alias("low"), F.max("doc_id").alias("doc_id"))
    up = Window.orderBy("part")
    before = F.coalesce(F.lead("low").over(up), F.first("low").over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = edges.select("doc_id", before.alias("b")).select("doc_id", F.col("b.doc_id").alias("for_id"), F.col("b.n").alias("for_n"))
    return inside.where("for_id is not null").select("doc_id", "for_id", "for_n").union(edges)


def order_minhash(docs: DataFrame, k: int = K, bins: int = BINS, tuple_size: int = TUPLE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where("doc_id is not null")  # read by both joins below in one form, so that its shuffle is made once
    ids = named.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    # Of a text only the part that replaces another's end is sent on.
    heads = named.join(following(ids), "doc_id").select(
        F.col("for_id").alias("doc_id"), F.col("doc_id").alias("next_id"), F.xxhash64("text").alias("h"),
        F.expr("substring(text, 1, cast(for_n div 3 as int))").alias("head"))
    heads = heads.groupBy("doc_id", "next_id").agg(F.min(F.struct("h", "head")).alias("x")).select("doc_id", "next_id", F.col("x.head").alias("head"))
    n = F.length("text")
    end = F.expr("cast(length(text) div 3 as int)")
    edited = F.concat(F.substring("text", F.lit(1), n - end), F.substring(F.coalesce("head", F.lit("")), F.lit(1), end))
    nameless = rows.where("doc_id is null").select("*", F.lit(None).cast("long").alias("next_id"), F.lit(None).cast("string").alias("head"))
    both = named.join(heads, "doc_id", "left").select("doc_id", "text", "next_id", "head").union(nameless)
    both = both.select("doc_id", "next_id", "text", edited.alias("edited"))
    made = cut(both.select(
        "doc_id", "next_id", n.cast("long").alias("n_chars"), F.xxhash64("text").alias("h"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), k, bins, tuple_size).alias("a"), fingerprint(F.col("edited"), k, bins, tuple_size).alias("b")), "fingerprints")
    next_one = made.where("doc_id is not null").groupBy(F.col("doc_id").alias("next_id")).agg(F.min(F.struct("h", "a")).alias("x")).select("next_id", F.col("x.a").alias("c"))
    found = made.join(next_one, "next_id", "left")
    nothing = F.array_repeat(F.lit(None).cast("int"), bins)
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.coalesce("c", nothing)).alias("near_next"))
