"""Order MinHash fingerprints of texts, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import keep, numbered

#: Words of a k-mer, sketches of a fingerprint, and k-mers of a sketch.
WORDS, SKETCHES, TUPLE = 3, 64, 2
#: A k-mer's place in the text takes the low bits of its word, the hash the others; the highest six name the sketch.
PLACE_BITS = 28
_PLACE = (1 << PLACE_BITS) - 1
_HASH36 = (1 << (64 - PLACE_BITS)) - 1
_SKETCH_SHIFT = 58
#: Hex digits that a sketch has in the fingerprint; all zero where a text has no k-mer for it.
DIGITS = 4


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _up_to(n: Column) -> Column:
    """0 .. n-1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _element(kmer: Column, occurrence: Column, place: Column) -> Column:
    """One numbered k-mer: its hash above, its place below."""
    hashed = F.xxhash64(kmer.bitwiseAND(F.lit(_HASH36)), occurrence.cast("int"))
    return hashed.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long"))


def _kmers(words: Column) -> Column:
    n = F.size(words)
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    many = F.transform(_up_to(n - (WORDS - 1)), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WORDS))))
    return F.when(n >= WORDS, many).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _repeated(kmers: Column) -> Column:
    """Elements of k-mers of which some repeat: equal ones meet in a sorted array, where each counts those before it."""
    packed = F.sort_array(F.transform(kmers, lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(i.cast("long"))))

    def value(x: Column) -> Column:
        return F.shiftrightunsigned(x, PLACE_BITS)

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(_up_to(n), lambda j: (j == 0) | (value(F.get(s, j)) != value(F.get(s, j - 1))))

        def each(starts: Column) -> Column:
            def run(first: Column, r: Column) -> Column:
                return F.transform(
                    F.sequence(first, F.coalesce(F.get(starts, r + 1), n) - 1),
                    lambda j: _element(value(F.get(s, j)), j - first, F.get(s, j).bitwiseAND(F.lit(_PLACE))),
                )

            return F.flatten(F.transform(starts, run))

        return _let(starts, each)

    return _let(packed, runs)


def _numbered_elements(kmers: Column) -> Column:
    plain = F.transform(kmers, lambda h, i: _element(h, F.lit(0), i))
    return F.when(F.size(F.array_distinct(kmers)) == F.size(kmers), plain).otherwise(_repeated(kmers))


def _tuples(elements: Column) -> Column:
    """Hash of each sketch's least k-mers, taken in text order; null for sketches without any."""

    def sketch(x: Column) -> Column:
        return F.shiftright(x, _SKETCH_SHIFT)

    def of(s: Column) -> Column:
        firsts = F.filter(_up_to(F.size(s)), lambda i: (i == 0) | (sketch(F.get(s, i)) != sketch(F.get(s, i - 1))))

        def entry(i: Column) -> Column:
            own = F.filter(F.slice(s, i + 1, TUPLE), lambda x: sketch(x) == sketch(F.get(s, i)))
            by_place = F.sort_array(F.transform(own, lambda x: F.struct(x.bitwiseAND(F.lit(_PLACE)).alias("place"), F.shiftright(x, PLACE_BITS).alias("hash"))))
            hashes = F.array_join(F.transform(by_place, lambda x: x["hash"].cast("string")), ",")
            return F.struct(sketch(F.get(s, i)).alias("key"), (F.pmod(F.xxhash64(hashes), F.lit((1 << 4 * DIGITS) - 1)) + 1).alias("value"))

        found = F.map_from_entries(F.transform(firsts, entry))
        return _let(found, lambda m: F.transform(F.sequence(F.lit(-SKETCHES // 2), F.lit(SKETCHES // 2 - 1)), lambda b: F.try_element_at(m, b.cast("long"))))

    return _let(F.sort_array(elements), of)


def sketches(text: Column) -> Column:
    """array<bigint> of SKETCHES numbers from 1 on, null where a text has no k-mer for a sketch.

    A k-mer is WORDS successive words (runs of characters other than \\x20 and \\x09-\\x0D; a text with fewer words is one
    k-mer); equal ones are told apart by their occurrence number. Hashes deal k-mers to the sketches; each takes the
    TUPLE least ones, puts them in text order and hashes the tuple: moved text changes it, although the k-mers stay.
    Null counts as empty: no sketch has a value.
    """
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return _let(words, lambda w: _let(_kmers(w), lambda k: _let(_numbered_elements(k), _tuples)))


def written(numbers: Column) -> Column:
    """The fingerprint as text."""
    return F.array_join(F.transform(numbers, lambda x: F.lpad(F.lower(F.hex(F.coalesce(x, F.lit(0)))), DIGITS, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches among those that either has; 1 if neither has any."""
    either = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"].isNotNull() | x["b"].isNotNull()))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when(either > 0, same / either).otherwise(1.0).cast("double")


def edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edit replaces the last floor(n_chars / 3) code points by the first as many, or all, of the next document in
    descending order of doc_id (nulls last; equal ids by text hash; after the last the first). Null texts are empty. A row
    that repeats another exactly is the same document, returned as often; a single document is its own next. An empty
    table gives an empty result. Other columns are not looked at.

    Only ids and lengths are sorted; texts are shuffled once by row key and only the needed heads travel to their readers.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("key"), F.hash("text", "doc_id").alias("check"), "doc_id", "text")
    # both readers of the texts ask for the same columns, so that they share one shuffle
    texts = rows.select("key", "check", "text").dropDuplicates(["key", "check"])
    ids = rows.groupBy("key", "check", "doc_id").agg(F.first(F.length("text")).alias("n_chars"), F.count("*").alias("copies"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("key"), F.col("check")]
    ids = keep(numbered(ids, order, "order"), "numbered")
    total = ids.count()
    following = ids.select((F.when(F.col("place") == 1, total).otherwise(F.col("place") - 1)).alias("place"), F.col("key").alias("next_key"), F.col("check").alias("next_check"))
    readers = ids.join(following, "place")
    heads = texts.withColumnsRenamed({"key": "next_key", "check": "next_check", "text": "next_text"}).join(
        readers.select("key", "check", "doc_id", "place", "copies", "n_chars", "next_key", "next_check"), ["next_key", "next_check"]
    )
    third = F.floor(F.col("n_chars") / 3).cast("int")
    heads = heads.select("key", "check", "doc_id", "place", "copies", "n_chars", F.substring("next_text", F.lit(1), third).alias("head"))
    both = texts.join(heads, ["key", "check"]).withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars") - third), F.col("head")))
    found = both.select(
        "doc_id", "place", "copies", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketches(F.col("text")).alias("own"), sketches(F.col("edited")).alias("other"),
    )
    found = keep(found, "fingerprints")
    after = found.select((F.when(F.col("place") == 1, total).otherwise(F.col("place") - 1)).alias("place"), F.col("own").alias("following"))
    # a row for each of the copies that were one document so far
    found = found.join(after, "place").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"), written(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
