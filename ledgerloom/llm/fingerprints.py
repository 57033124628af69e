"""Document fingerprints: a sketch of every shingle hash below a fixed threshold.

Each run of five words is hashed, and the hashes in the lowest ``1 / scale`` of their range
are kept, all of them. The kept part of a document is thus a fair sample of its shingles at
one rate for all documents. So the sketch of a union is the union of the sketches, and the
share of a small document in a large one can be told from both sketches, however unequal
they are. A document of at most ``WHOLE`` distinct shingles is too short for a sample: its
sketch is whole, with all of them. Two whole sketches are compared as they are, otherwise
both at the rate of the sample. Everything here is made of built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_names, small, stored

SHINGLE_WORDS = 5
SCALE = 2
WHOLE = 64
_SURE = 8  # a sample of more than 64 shingles has so few hashes in one of 10^9 cases
_RANGE = 1 << 60


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hashes (0 to 2^60 - 1) of all runs of ``words`` words; a shorter text is one shingle.

    Words are runs of characters other than ASCII white space, in lower case.
    A text without words has none.
    """
    trimmed = F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r"))
    split = F.split(trimmed, r"[\x20\x09-\x0D]+")
    # Each word is hashed once; a shingle is hashed from the hashes of its words.
    hashed = F.transform(split, lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        last = F.greatest(F.size(h) - words, F.lit(0))
        # slice() is short at the end of a text with fewer words.
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + k) for k in range(words)]), 4),
        )

    # The word hashes come into a lambda as one value, so that they are computed once.
    all_runs = F.flatten(F.transform(F.array(hashed), runs))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(all_runs)


def _below(hashes: Column, scale: int) -> Column:
    return F.filter(hashes, lambda h: h < _RANGE // scale)


def _cut(hashes: Column, scale: int) -> Column:
    # The hashes come into the lambda as one value, so that they are computed once.
    return F.flatten(F.transform(F.array(hashes), lambda x: F.when(F.size(x) <= WHOLE, x).otherwise(_below(x, scale))))


def sketch(text: Column, scale: int = SCALE, words: int = SHINGLE_WORDS) -> Column:
    """The distinct hashes, in order: all if they are ``WHOLE`` at most, else those below
    ``2^60 / scale``."""
    return F.array_sort(_cut(F.array_distinct(shingle_hashes(text, words)), scale))


def _whole(kept: Column, scale: int) -> Column:
    """Whether a sketch is whole. A whole one whose hashes all lie below the threshold counts
    as a sample if it has more than a few."""
    return (F.size(kept) <= _SURE) | (F.element_at(kept, -1) >= _RANGE // scale)


def _alike(first: Column, second: Column, scale: int) -> tuple[Column, Column]:
    """Both sketches at the same rate."""
    whole = _whole(first, scale) & _whole(second, scale)
    return tuple(F.when(whole, x).otherwise(_below(x, scale)) for x in (first, second))


def merged(first: Column, second: Column, scale: int = SCALE) -> Column:
    """The sketch of two documents together."""
    return F.array_sort(_cut(F.array_union(*_alike(first, second, scale)), scale))


def containment(inner: Column, outer: Column, scale: int = SCALE) -> Column:
    """Estimated share of the first document's shingles that are in the second; null if none
    of them can be looked up."""
    inner, outer = _alike(inner, outer, scale)
    return F.size(F.array_intersect(inner, outer)) / F.nullif(F.size(inner), F.lit(0))


def likeness(first: Column, second: Column, same_text: Column, scale: int = SCALE) -> Column:
    """Jaccard similarity, 0 to 1: exact for two whole sketches, else estimated. Two empty
    sketches are those of texts without words; they are alike (1) if they are equal and not
    (0) otherwise."""
    first, second = _alike(first, second, scale)
    common = F.size(F.array_intersect(first, second))
    both = F.size(first) + F.size(second) - common
    return F.when(both == 0, same_text.cast("double")).otherwise(common / both)


def as_text(kept: Column) -> Column:
    """A sketch as text: the highest 48 bits of each hash, as eight characters of base 64."""
    shift = _RANGE.bit_length() - 1 - 48
    digits = F.transform(kept, lambda h: F.lpad(F.hex(F.shiftright(h, shift)), 12, "0"))
    return F.translate(F.base64(F.unhex(F.array_join(digits, ""))), "\r\n", "")


def fingerprint_documents(
    docs: DataFrame, text_column: str = "text", out: str = "sketch", scale: int = SCALE, words: int = SHINGLE_WORDS
) -> DataFrame:
    """``docs`` with ``out``: the sketch of each whole text. Null and blank texts have an empty
    one, equal texts (words) equal ones. A column called ``out`` is replaced."""
    return docs.withColumn(out, sketch(F.coalesce(F.col(text_column), F.lit("")), scale, words))


def with_next(docs: DataFrame, id_column: str, carried: list[str], range_rows: int = 1024) -> DataFrame:
    """``docs`` with ``_next_<c>`` for the ``carried`` columns c: those of the next row by
    falling id; the last row's next is the first.

    Ids are cut into ranges of about ``range_rows`` rows, and a window sees one range at a
    time. The first row of each range also visits the range before it, as the row that
    follows its last one. Equal ids go by the carried columns. Null ids come last; they share
    one range.
    """
    span, of, head, visits, at = free_names(docs, "_range", "_of", "_head", "_visits", "_at")
    low, high, count = docs.select(F.min(id_column), F.max(id_column), F.count(id_column)).first()
    ranges = max(1, (count or 0) // range_rows)
    width = max(1.0, (float(high or 0) - float(low or 0) + 1) / ranges)
    # Rising ranges have falling ids.
    place = F.floor((F.lit(float(high or 0)) - F.col(id_column).cast("double")) / width)
    placed = docs.withColumn(span, F.coalesce(place, F.lit(ranges + 1).cast("bigint")))
    heads = stored(placed.groupBy(span).agg(F.max(id_column).alias(head)), "ranges")
    before = F.lag(span).over(Window.orderBy(span))
    final = F.max(span).over(Window.partitionBy())
    heads = heads.select(F.col(span).alias(of), head, F.coalesce(before, final).alias(visits))
    first = (F.col(span) == F.col(of)) & F.col(id_column).eqNullSafe(F.col(head))
    stay = F.struct(F.col(span).alias("range"), F.lit(False).alias("guest"))
    visit = F.struct(F.col(visits).alias("range"), F.lit(True).alias("guest"))
    both = F.when(F.col(visits).isNull(), F.array(stay)).otherwise(F.array(stay, visit))
    rows = placed.join(small(heads), first, "left").select(*docs.columns, F.explode(both).alias(at))
    order = Window.partitionBy(f"{at}.range").orderBy(
        f"{at}.guest", F.col(id_column).desc_nulls_last(), *[F.col(c) for c in carried]
    )
    # Column by column: a struct would be a second copy of the text in the exchange.
    following = [F.lead(c).over(order).alias(f"_next_{c}") for c in carried]
    return rows.select("*", *following).where(~F.col(f"{at}.guest")).drop(at)


def edited_text(text: Column, following: Column) -> Column:
    """The last third of the code points replaced by as many of the next text's first ones."""
    cut = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - cut), F.substring(following, F.lit(1), cut))
