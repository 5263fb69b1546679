"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A text is cut into units: pieces of at most ``PIECE`` characters of its words, and characters one by one in scripts that don't part words; a short
text is cut into single characters. Of all runs of ``RUN`` units those are syncmers whose least inner pair of units, by hash, is the
first or the last one. That depends on nothing outside the run, so an equal passage gives equal syncmers wherever it stands and whatever
surrounds it. A fingerprint holds syncmers with their places: all of a short text, and of longer ones a share by hash that
leaves about ``8 sqrt(n)`` of ``n``, so it grows with the text.

Two fingerprints are matched by place: a common syncmer counts if the common one before or after it lies equally far apart in both texts.
Hashes that are equal by chance, and common words at unrelated places, don't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.stages import NULL_ID, doc_id, parts, stage

RUN, PIECE, GROWTH = 4, 8, 8
# characters up to which a text is cut into characters, and from which on into pieces: a text and one of two thirds of its length share a way
SHORT, LONG = 384, 256
# bits of an entry: how rare it is, its hash, its place
_RARE, _HASH, _PLACE = 4, 15, 13
_HALF = 1 << 31
# Thai and Lao, Burmese, Khmer, Japanese syllables, Chinese characters
_DENSE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\x{20000}-\x{3FFFF}"
PIECES = rf"[{_DENSE}]|[^\s{_DENSE}]{{1,{PIECE}}}"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))


def characters_of(text: Column) -> Column:
    return F.split(text, "")


def syncmers(text: Column, units: Column) -> Column:
    """Array of ``place`` (number of the first unit) and ``hash`` of the syncmers of a text that is cut into ``units``, in order.

    A text without any, such as one of fewer than ``RUN`` units, has one of place 0 that stands for the whole text.
    """
    last = RUN - 2  # of the inner pairs of a run

    def chosen(units: Column) -> Column:
        pairs = F.zip_with(units, F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        return _let(pairs, lambda p: F.transform(F.filter(F.sequence(F.lit(0), F.size(units) - RUN), edge(p)), at(p)))

    def edge(p: Column):
        def test(i: Column) -> Column:
            return F.least(F.get(p, i), F.get(p, i + last)) <= F.least(*(F.get(p, i + j) for j in range(1, last)), F.lit(2**63 - 1))

        return test

    def at(p: Column):
        # the outer pairs hold all units of the run
        return lambda i: F.struct(i.alias("place"), F.xxhash64(F.get(p, i), F.get(p, i + last)).alias("hash"))

    whole = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(text).alias("hash")))
    hashes = F.transform(units, lambda u: F.xxhash64(u))
    found = _let(hashes, lambda u: F.when(F.size(u) >= RUN, chosen(u)).otherwise(whole))
    return _let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(whole))


def _entries(found: Column) -> Column:
    """Syncmers as numbers of 32 bits less ``_HALF``, after the least rarity that was kept; ascending, the first place of each."""

    def rare(h: Column) -> Column:
        # 16 bits of the hash that play no other part: every step of rarity halves what is left
        bits = F.greatest(F.shiftrightunsigned(h, 48), F.lit(1))
        return F.lit(15) - F.floor(F.log2(bits))

    def entry(s: Column) -> Column:
        hash_ = s["hash"].bitwiseAND((1 << _HASH) - 1)
        place = s["place"].cast("long").bitwiseAND((1 << _PLACE) - 1)
        return ((rare(s["hash"]) * (1 << _HASH) + hash_) * (1 << _PLACE) + place).cast("long")

    def kept(least: Column) -> Column:
        # a first test on bits alone, for most are not kept
        some = F.filter(found, lambda s: F.shiftrightunsigned(s["hash"], 48) < F.pow(F.lit(2.0), F.lit(16) - least))
        first = lambda v: F.filter(v, lambda x, i: (i == 0) | (_key(x) != _key(F.get(v, i - 1))))
        entries = _let(F.array_sort(F.transform(some, entry)), first)
        return F.concat(F.array(least.cast("int")), F.transform(entries, lambda x: (x - F.lit(_HALF)).cast("int")))

    wanted = F.ceil(F.log2(F.greatest(F.sqrt(F.size(found)) / GROWTH, F.lit(1.0))))
    return _let(F.least(wanted, F.lit(15)), kept)


def _key(entry: Column) -> Column:
    return F.shiftrightunsigned(entry, _PLACE)


def sketch(text: Column) -> Column:
    """``characters, pieces``: the fingerprints by both ways to cut a text, null where a text is too long or too short for it."""
    n = F.length(text)
    by = lambda units: _let(syncmers(text, units), _entries)
    return F.struct(
        F.when(n <= SHORT, by(characters_of(text))).alias("characters"),
        F.when(n > LONG, by(pieces_of(text))).alias("pieces"),
    )


def written(sketch_: Column) -> Column:
    """A fingerprint as text: for each way of cutting the least rarity, a digit, and 8 hex digits a syncmer."""

    def one(a: Column) -> Column:
        entries = F.transform(F.slice(a, F.lit(2), F.size(a)), lambda h: F.lower(F.lpad(F.hex(h.cast("long") + F.lit(_HALF)), 8, "0")))
        return F.concat(F.lower(F.hex(F.get(a, 0))), F.array_join(entries, ""))

    return F.concat_ws("-", F.concat(F.lit("c"), one(sketch_["characters"])), F.concat(F.lit("p"), one(sketch_["pieces"])))


def _matched(a: Column, b: Column) -> Column:
    """Syncmers common to two fingerprints and matched by place, as a share of all; 0 where there are none."""

    def open_(x: Column, least: Column, side: int) -> Column:
        # entry and side; those as rare as both fingerprints keep
        entries = F.transform(F.slice(x, F.lit(2), F.size(x)), lambda h: (h.cast("long") + F.lit(_HALF)) * 2 + side)
        return F.filter(entries, lambda e: F.shiftrightunsigned(e, 1 + _HASH + _PLACE) >= least)

    def compared(u: Column) -> Column:
        x, y = u["x"], u["y"]
        both = F.array_sort(F.concat(x, y))
        place = lambda e: F.shiftrightunsigned(e, 1).bitwiseAND((1 << _PLACE) - 1)

        def pairs(v: Column) -> Column:
            # a key is there once in each text, so equal neighbours come from both
            i_all = F.filter(
                F.sequence(F.lit(0), F.greatest(F.size(v) - 2, F.lit(0))),
                lambda i: F.shiftrightunsigned(F.get(v, i), 1 + _PLACE) == F.shiftrightunsigned(F.get(v, i + 1), 1 + _PLACE),
            )

            def pair(i: Column) -> Column:
                p, q = F.get(v, i), F.get(v, i + 1)
                first_is_x = p.bitwiseAND(F.lit(1)) == 0
                here, there = F.when(first_is_x, place(p)).otherwise(place(q)), F.when(first_is_x, place(q)).otherwise(place(p))
                # the place in one text above the distance to that in the other
                return here * (1 << _PLACE) + F.pmod(there - here, F.lit(1 << _PLACE))

            return F.array_sort(F.transform(i_all, pair))

        def steady(m: Column) -> Column:
            offset = lambda e: e.bitwiseAND((1 << _PLACE) - 1)
            # outside the array there is no neighbour
            near = lambda e, i: (offset(e) == F.coalesce(offset(F.get(m, i - 1)), F.lit(-1))) | (
                offset(e) == F.coalesce(offset(F.get(m, i + 1)), F.lit(-1))
            )
            few = F.least(F.size(x), F.size(y)) <= 2
            return F.when(few, F.size(m)).otherwise(F.size(F.filter(m, near)))

        count = _let(_let(both, pairs), steady)
        return _let(count, lambda c: F.when(F.size(x) + F.size(y) > c, c / (F.size(x) + F.size(y) - c)).otherwise(F.lit(0.0)))

    least = F.greatest(F.get(a, 0), F.get(b, 0))
    return _let(F.struct(open_(a, least, 0).alias("x"), open_(b, least, 1).alias("y")), compared)


def likeness(a: Column, b: Column) -> Column:
    """Share of syncmers that match by place among those of both texts: 1 for equal texts. Texts of very different length share no way of cutting: 0."""
    both = lambda way: a[way].isNotNull() & b[way].isNotNull()
    return (
        F.when(both("characters"), _matched(a["characters"], b["characters"]))
        .when(both("pieces"), _matched(a["pieces"], b["pieces"]))
        .otherwise(F.lit(0.0))
    )


def _places(docs: DataFrame) -> DataFrame:
    """Every distinct ``did, th`` with the one before it in descending order, ``before_did, before_th, before_chars``.

    Before the first comes the last. Ids are range-sorted into parts; only the ends of parts, a row each, meet in one task.
    """
    ids = docs.groupBy("did", "th").agg(F.first("n_chars").alias("n_chars"))
    ordered = (
        ids.repartitionByRange(parts(docs.sparkSession), F.desc("did"), "th")
        .withColumn("part", F.spark_partition_id())
    )
    ordered = stage(ordered, "id-order")
    me = F.struct("did", "th", "n_chars")
    last = (
        ordered.groupBy("part")
        .agg(F.max_by(me, F.struct(F.bitwise_not("did").alias("d"), "th")).alias("last"))
    )
    ends = last.select(
        "part",
        F.coalesce(
            F.lag("last").over(Window.orderBy("part")),
            F.last("last").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("end"),
    )
    inside = F.lag(me).over(Window.partitionBy("part").orderBy(F.desc("did"), "th"))
    joined = ordered.withColumn("inside", inside).join(ends, "part")
    before = F.coalesce("inside", "end")
    return joined.select(
        "did", "th", before["did"].alias("before_did"), before["th"].alias("before_th"), before["n_chars"].alias("before_chars")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs``, of its edited text, and their likeness.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The edited text is the
    text with its last third (of code points, rounded down) replaced by as many first ones of the next row's, or
    all of them. Rows follow each other by descending id, null ids last, rows of one id by a hash of the
    text; rows equal in id and text share a place. After the last comes the first; a lone row follows itself.
    Null texts are empty. Texts of any length are read whole. Other columns play no part. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("did"), F.xxhash64(text).alias("th"), text.alias("text")
    )
    places = stage(_places(base.select("did", "th", F.length("text").cast("long").alias("n_chars"))), "places")
    sketches = stage(base.select("did", "th", sketch(F.col("text")).alias("sketch")), "sketches")
    own = base.dropDuplicates(["did", "th"]) if _repeats(base, places) else base
    third = F.floor(F.col("before_chars") / 3).cast("int")
    # what each row gives to the one before it
    given = (
        own.join(places, ["did", "th"])
        .select(
            F.col("before_did").alias("did"), F.col("before_th").alias("th"), F.substring("text", F.lit(1), third).alias("head"),
            F.col("did").alias("next_did"), F.col("th").alias("next_th"),
        )
    )
    n = F.length("text")
    joined = base.join(given, ["did", "th"]).select(
        "did", "th", "next_did", "next_th", n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head")).alias("edited"),
    )
    marked = joined.select(
        "did", "th", "next_did", "next_th", "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"), sketch(F.col("edited")).alias("edited_sketch"),
    )
    unique = sketches.dropDuplicates(["did", "th"])
    theirs = unique.select(F.col("did").alias("next_did"), F.col("th").alias("next_th"), F.col("sketch").alias("next_sketch"))
    full = marked.join(unique, ["did", "th"]).join(theirs, ["next_did", "next_th"])
    return full.select(
        doc_id().alias("doc_id"),
        "n_chars",
        "edited_sha256",
        written(F.col("sketch")).alias("fingerprint"),
        written(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).cast("double").alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).cast("double").alias("near_next"),
    )


def _repeats(base: DataFrame, places: DataFrame) -> bool:
    """Whether rows share a place. Only then is a shuffle spent on making them distinct."""
    return base.select("did").count() != places.count()
