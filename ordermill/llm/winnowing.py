"""Document fingerprints by winnowing.

A text's tokens (runs of other characters than blanks, long runs cut every
``TOKEN_CHARS``) are hashed; a rolling hash covers every ``GRAM`` tokens; of
every window of ``WINDOW`` neighbouring grams the one with the least hash is
kept, the rightmost of equal ones, with its position. Two texts that share
``GRAM + WINDOW - 1`` tokens in a row share a kept gram. Windows also slide
over both ends, so a short text keeps several grams as well. Everything is
one expression of built-in functions per text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 5
WINDOW = 4
TOKEN_CHARS = 16
_ORDER_BITS = 31  # leading bits of a gram's hash that are compared in a window
_POSITION = (1 << 32) - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _turn(value: Column, by: int) -> Column:
    by %= 64
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by)) if by else value


def token_hashes(text: Column) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(r"[^\s]{1,%d}" % TOKEN_CHARS), F.lit(0))
    return F.transform(tokens, lambda token: F.xxhash64(token))


def gram_hashes(hashes: Column, gram: int = GRAM) -> Column:
    """Cyclic polynomial of every ``gram`` hashes; of all of them if they are fewer; none for none."""

    def rolled(at: Column) -> Column:
        total = F.get(hashes, at + (gram - 1))
        for back in range(1, gram):
            total = total.bitwiseXOR(_turn(F.get(hashes, at + (gram - 1 - back)), back))
        return total

    whole = F.aggregate(hashes, F.lit(0).cast("long"), lambda total, one: _turn(total, 1).bitwiseXOR(one))
    return (
        F.when(F.size(hashes) >= gram, F.transform(F.sequence(F.lit(0), F.size(hashes) - gram), rolled))
        .when(F.size(hashes) > 0, F.array(whole))
        .otherwise(F.array().cast("array<bigint>"))
    )


def winnow(grams: Column, window: int = WINDOW) -> Column:
    """(position, hash) of the grams that are the least of some window, in order of position.

    A gram's rank holds the first bits of its hash and then its position,
    counted down, so the least rank is the rightmost of the least hashes.
    """
    rank = F.transform(
        grams,
        lambda gram, at: F.shiftleft(F.shiftrightunsigned(gram, 64 - _ORDER_BITS), 32).bitwiseOR(
            F.lit(_POSITION) - at.cast("long")
        ),
    )
    beyond = F.array_repeat(F.lit((1 << 63) - 1), window - 1)

    def least(ranks: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ranks) - window)
        return F.transform(starts, lambda at: F.least(*[F.get(ranks, at + step) for step in range(window)]))

    def marked(rank: Column) -> Column:
        return let(
            (F.lit(_POSITION) - rank.bitwiseAND(F.lit(_POSITION))).cast("int"),
            lambda at: F.struct(at.alias("position"), F.get(grams, at).alias("hash")),
        )

    kept = let(F.concat(beyond, rank, beyond), lambda ranks: F.array_distinct(least(ranks)))
    nothing = F.array().cast("array<struct<position:int,hash:bigint>>")
    return F.when(F.size(grams) > 0, F.transform(kept, marked)).otherwise(nothing)


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """array<struct<position, hash>> of a whole text; empty for a null or blank one."""
    return let(
        token_hashes(F.coalesce(text.cast("string"), F.lit(""))),
        lambda hashes: let(gram_hashes(hashes, gram), lambda grams: winnow(grams, window)),
    )


def likeness(left: Column, right: Column) -> Column:
    """Shared share of the distinct kept hashes of two fingerprints; 1 if both are empty."""

    def shared(a: Column, b: Column) -> Column:
        both = F.size(F.array_intersect(a, b)).cast("double")
        either = F.size(F.array_union(a, b))
        return F.when(either == 0, 1.0).otherwise(both / either)

    return let(left["hash"], lambda a: let(right["hash"], lambda b: shared(a, b)))


def digest(marks: Column) -> Column:
    """A fingerprint as text: MD5 of its positions and hashes."""
    words = F.transform(marks, lambda mark: F.concat_ws(":", mark["position"], mark["hash"]))
    return F.md5(F.array_join(words, " ").cast("binary"))


def with_next_text(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``next_text``: that of the next document by ``doc_id``; after the last, the first.

    Documents are dealt to ranges of ids by approximate quantiles of the id
    column (``buckets`` numbers, the only rows the driver sees) and looked ahead inside each range; the last one of a range gets
    the first text of the next range, of which there is one row per range.
    Rows with the same id follow each other by text; null ids come first. A
    single document is followed by itself. Each text is shuffled once.
    """
    count = buckets or 2 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    shares = F.array(*[F.lit(i / count) for i in range(1, count)])
    found = narrow.agg(F.percentile_approx("doc_id", shares, 100 * count)).first()[0] or []
    bounds = F.array(*[F.lit(bound) for bound in sorted(set(found))]).cast("array<bigint>")
    below = F.size(F.filter(bounds, lambda bound: bound < F.col("doc_id")))
    ranged = narrow.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(below))
    place = F.struct(F.col("doc_id").isNotNull(), "doc_id", "text")
    heads = ranged.groupBy("range").agg(F.min_by("text", place).alias("head"))
    ordered = Window.orderBy("range")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        "range", F.coalesce(F.lead("head").over(ordered), F.first("head").over(whole)).alias("after")
    )
    inside = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    return (
        ranged.withColumn("ahead", F.lead("text").over(inside))
        .join(after, "range")
        .select("doc_id", "text", F.coalesce("ahead", "after").alias("next_text"))
    )


def edited(text: Column, other: Column) -> Column:
    """The last quarter of the code points replaced by as many of another text's first ones."""
    size = F.char_length(text)
    quarter = F.floor(size / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - quarter), F.substring(other, F.lit(1), quarter))


def edit_report(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they and the next document's are.

    An empty table gives no rows; an empty text has an empty fingerprint.
    Only ``doc_id`` and ``text`` are read.
    """
    paired = with_next_text(documents)
    marked = paired.select(
        "doc_id", "text", "next_text",
        edited(F.col("text"), F.col("next_text")).alias("edited"),
        fingerprint(F.col("text")).alias("marks"),
        fingerprint(F.col("next_text")).alias("next_marks"),
    ).withColumn("edited_marks", fingerprint(F.col("edited")))
    return marked.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "marks", "edited_marks",
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
