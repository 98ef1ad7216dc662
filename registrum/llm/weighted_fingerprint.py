"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A term is a word (lower case, split at white space and punctuation) and its weight the number
of its occurrences. Sample k of a term with weight S draws r and c from a gamma distribution of
shape 2 and b from the unit interval, all from a hash of the term and k:

    t = floor(ln S / r + b),  ln a = ln c - r * (t - b + 1)

and the term with the smallest a, together with its t, is sample k of the document. Two
documents agree in a sample with a probability equal to their generalised Jaccard similarity
(sum of the smaller weights over the sum of the larger ones), so the share of equal samples
estimates it with a standard error of at most 1 / (2 * sqrt(SAMPLES)).

A gamma draw is -ln(u * v) of two uniform numbers. c takes both from a hash of its own, 32 bits
each, since the smallest draws decide which of many rare words wins in a long text; r and b share
another hash. A sample is packed as a long (a first, term and t below), so the fingerprint is a
hash aggregate of longs and stays in generated code; words are counted within their row and never
shuffled.

The logarithms cost most, and few draws can win: the smallest of a text of n words exceeds x with
the probability exp(-n * x). ``with_edits`` takes logarithms only of draws whose a may lie below
``SPARE`` / n by a bound that needs none. Where no draw of a sample lies there, which is to be
expected once in exp(SPARE) samples, the block is drawn again in full, so the result is the same.

Null text counts as empty. A text without words has the fingerprint of zeros, equal to that of
any other such text and unlike all others.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrum.session import write_and_reread

SAMPLES = 64
SHAPE_BITS = 21
# Samples of one row of the aggregate. The code of all of them in one row runs four times as long.
TOGETHER = 16
# ln a lies well within -2**6 .. 2**6; the rest of 31 bits is its fraction.
_SCALE = float(1 << 24)
# Draws up to so many times their expected minimum are worked out at first.
SPARE = 20.0


def _uniform(h: Column, low: int, bits: int) -> Column:
    """A number strictly between 0 and 1 from ``bits`` bits of a hash, ``low`` bits from its end."""
    part = F.shiftrightunsigned(h, low) if low else h
    if low + bits < 64:
        part = part.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    return (part + F.lit(0.5)) * F.lit(2.0**-bits)


def term_weights(text: Column) -> Column:
    """The distinct terms of a text: array of structs of the term's hash, its count and ln of that,
    and the number of words of the text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def counted(sorted_hashes: Column) -> Column:
        n = F.size(sorted_hashes)
        # Where a run of equal hashes ends; its length is the distance to the end before.
        ends = F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == n) | (F.get(sorted_hashes, i) != F.get(sorted_hashes, i - 1)),
        )
        return F.transform(
            F.array(ends),
            lambda e: F.transform(
                e,
                lambda end, j: F.struct(
                    F.get(sorted_hashes, end - 1).alias("term"),
                    (end - F.coalesce(F.get(e, j - 1), F.lit(0))).alias("count"),
                    F.ln(end - F.coalesce(F.get(e, j - 1), F.lit(0))).alias("weight"),
                    n.alias("words"),
                ),
            ),
        )[0]

    none = F.array().cast("array<struct<term:bigint,count:int,weight:double,words:int>>")
    return F.transform(F.array(hashes), lambda h: F.when(F.size(h) > 0, counted(h)).otherwise(none))[0]


def _first(ln_a: Column) -> Column:
    """What comes first in a packed draw: the smaller a, the smaller."""
    return F.floor((F.greatest(F.least(ln_a, F.lit(63.0)), F.lit(-63.0)) + 64.0) * F.lit(_SCALE))


def draws(terms: DataFrame, keys: list[str], spare: float | None) -> DataFrame:
    """``keys``, _k and _s: the packed draws of the terms (_t) for each sample k, or with ``spare``
    those whose a may lie below ``spare`` by the number of words. A text without words has a row
    for each sample, without a draw.

    Every step is a projection of its own, so that what the next ones use more than once is worked
    out once. Of a draw of weight ln w, a is at least c * u * v / w, and c = -ln x is at least
    2 (1 - x) / (1 + x); where t is 0, u * v may be its weighted harmonic mean with 1.
    """
    words, count = F.col("_t.words"), F.col("_t.count")
    highest = F.lit(float("inf")) if spare is None else F.when(words > spare, F.lit(spare) / words * count).otherwise(float("inf"))
    kept = ["_weight", "_once", "_highest", "_k", "_h"]
    df = terms.select(
        *keys, F.col("_t.term").alias("_term"), F.col("_t.weight").alias("_weight"), (count == 1).alias("_once"), highest.alias("_highest")
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1))).alias("_k"))
    h, g = F.col("_h"), F.col("_g")
    df = df.select("*", F.xxhash64("_term", "_k").alias("_h"), F.xxhash64("_term", F.col("_k") + SAMPLES).alias("_g"))
    df = df.select(
        *keys,
        *kept,
        (_uniform(h, 64 - SHAPE_BITS, SHAPE_BITS) * _uniform(h, 64 - 2 * SHAPE_BITS, SHAPE_BITS)).alias("_y"),
        (_uniform(g, 32, 32) * _uniform(g, 0, 32)).alias("_x"),
        _uniform(h, 0, 64 - 2 * SHAPE_BITS).alias("_b"),
    )
    y, x, b = F.col("_y"), F.col("_x"), F.col("_b")
    mean = F.when(F.col("_once"), 1.0 - b + b * y).otherwise(1.0)
    may_win = 2.0 * (1.0 - x) * y < F.col("_highest") * (1.0 + x) * mean
    # A filter would be moved below the projections and work them out again.
    passed = F.explode(F.when(may_win | F.col("_weight").isNull(), F.array(F.lit(True))))
    df = df.select(*keys, *kept, "_x", "_y", "_b", passed.alias("_passed"))
    df = df.select(*keys, "_weight", "_k", "_h", "_x", "_b", (-F.ln(y)).alias("_r"))
    df = df.select("*", F.floor(F.col("_weight") / F.col("_r") + b).alias("_whole"))
    t = F.col("_whole")
    first = _first(F.ln(-F.ln(x)) - F.col("_r") * (t - b + 1))
    if spare is not None:
        # As ``bound`` in fingerprints, which leaves one more for rounding.
        most = F.when(F.col("_words") > spare, _first(F.ln(F.lit(spare) / F.col("_words")))).otherwise(F.lit(1 << 40))
        df = df.select("*", first.alias("_first"))
        lower = F.explode(F.when(F.coalesce(F.col("_first") <= most, F.lit(True)), F.array("_first")))
        df = df.select(*keys, "_k", "_h", "_whole", lower.alias("_low"))
        first = F.col("_low")
    name = h.bitwiseXOR(t * F.lit(2654435761)).bitwiseAND(F.lit((1 << 32) - 1))
    return df.select(*keys, "_k", F.shiftleft(first, 32).bitwiseOR(name).alias("_s"))


def packed(parts: Column) -> Column:
    """The samples of the parts (structs of part and samples) as an array; only term and t count
    from here on."""
    low = F.lit((1 << 32) - 1)
    least = F.flatten(F.sort_array(parts)["samples"])
    return F.transform(least, lambda s: F.coalesce(s.bitwiseAND(low), F.lit(0).cast("long")))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda s: F.lpad(F.hex(s), 8, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    same = F.zip_with(one, other, lambda a, b: (a == b).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / F.lit(float(SAMPLES))


def fingerprints(df: DataFrame, keys: list[str], text: str = "text", spare: float | None = None) -> DataFrame:
    """``keys`` and ``fingerprint``, one row per distinct combination of ``keys``. Where ``df``
    is partitioned by some of the keys, nothing is shuffled. With ``spare`` also ``unsure``: some
    sample has no draw for sure below that many times its expected minimum."""
    by = [*keys, "_words"]
    terms = df.select(*keys, F.explode_outer(term_weights(F.col(text))).alias("_t")).select("*", F.col("_t.words").alias("_words"))
    part, j_of = F.shiftright("_k", TOGETHER.bit_length() - 1).alias("_part"), F.col("_k").bitwiseAND(F.lit(TOGETHER - 1))
    rows = draws(terms, by, spare).select(*by, part, j_of.alias("_j"), "_s")
    drawn = rows.groupBy(*by, "_part").agg(*[F.min(F.when(F.col("_j") == j, F.col("_s"))).alias(f"_s{j}") for j in range(TOGETHER)])
    least = F.struct("_part", F.array(*[F.col(f"_s{j}") for j in range(TOGETHER)]).alias("samples"))
    out = [packed(F.collect_list(least)).alias("fingerprint")]
    if spare is not None:
        # A draw left out may be as small as this, but for rounding.
        bound = F.shiftleft(_first(F.ln(F.lit(spare) / F.col("_words"))) - 1, 32)
        beyond = [F.coalesce(F.col(f"_s{j}") >= bound, F.lit(True)) for j in range(TOGETHER)]
        some = F.max((F.col("_words") > spare) & functools.reduce(Column.__or__, beyond))
        # A part without any draw has no row.
        out.append((F.coalesce(some, F.lit(False)) | (F.count("*") < SAMPLES // TOGETHER)).alias("unsure"))
    return drawn.groupBy(*keys).agg(*out)


def with_next(df: DataFrame, doc_id: str, text: str, blocks: int) -> DataFrame:
    """Rows in blocks of ascending ids (numeric), each with the text of the next document, the
    first one's after the last. Every block also has a copy of what follows it, so that no row
    has to look into another block: columns block, place, copy, doc_id, text, next_text.

    Block bounds are ids that occur, at equal distances, at most ``blocks`` of them. Rows with
    one id follow one another by a hash of the text. Rows without an id have no next document.
    """
    shares = [i / blocks for i in range(blocks)]
    # One row of at most ``blocks`` ids.
    found = df.select(F.percentile_approx(doc_id, shares, 20 * blocks)).first()[0]
    bounds = sorted(set(found or [0]))
    ids, starts = F.col(doc_id), F.lit(bounds)
    block = F.when(ids.isNull(), F.pmod(F.xxhash64(text), F.lit(len(bounds)))).otherwise(
        F.size(F.filter(starts, lambda b: b <= ids)) - 1
    )
    rows = df.select(ids.alias("doc_id"), F.col(text).alias("text"), block.cast("int").alias("block"))
    # The rows at a bound also close the block before it.
    before = F.pmod(F.col("block") + len(bounds) - 1, F.lit(len(bounds)))
    copies = rows.where(F.col("doc_id").isin(bounds)).withColumn("block", before).withColumn("copy", F.lit(True))
    both = rows.withColumn("copy", F.lit(False)).unionByName(copies)
    own = Window.partitionBy("block").orderBy("unplaced", "copy", "doc_id", F.xxhash64("text"))
    both = both.withColumn("unplaced", F.col("doc_id").isNull())
    after = F.when(~F.col("unplaced"), F.lead("text").over(own))
    return both.withColumns({"place": F.row_number().over(own), "next_text": after})


def edited(text: Column, after: Column) -> Column:
    """The text with its last half (rounded down) replaced by as much of the next document."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(after, F.lit(1), half))


def with_edits(df: DataFrame, blocks: int, doc_id: str = "doc_id", text: str = "text", spare: float = SPARE) -> DataFrame:
    """Each document with the fingerprints of its text and of its edited text, and their
    likeness to each other and to the next document's, written.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. Rows without an id have no next document: what depends on it is null.
    """
    placed = with_next(df.select(doc_id, F.coalesce(text, F.lit("")).alias(text)), doc_id, text, blocks)
    changed = edited(F.col("text"), F.col("next_text"))
    keys = ["block", "place", "copy", "unplaced", "doc_id", "n_chars", "edited_sha256", "kind"]
    both = placed.withColumns({"n_chars": F.length("text").cast("long"), "edited_sha256": F.sha2(changed, 256)})
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("kind"), F.when(~F.col("copy"), changed).alias("body")),
    )
    both = both.withColumn("_k", F.explode(kinds)).select(*keys[:-1], "_k.kind", "_k.body")
    # Only rows that are kept need it; the others have shorter keys.
    both = both.withColumn("edited_sha256", F.when((F.col("kind") == 0) & ~F.col("copy"), F.col("edited_sha256")))
    own = Window.partitionBy("block").orderBy("place", "kind")

    def compared(drawn: DataFrame) -> DataFrame:
        # The rows of a block alternate: a text, its edited text, the next text.
        drawn = drawn.withColumns({
            "edited": F.lead("fingerprint", 1).over(own), "following": F.lead("fingerprint", 2).over(own)
        })
        placed = ~F.col("unplaced")
        return drawn.select(
            "doc_id",
            "n_chars",
            F.when(placed, F.col("edited_sha256")).alias("edited_sha256"),
            as_text(F.col("fingerprint")).alias("fingerprint"),
            F.when(placed, as_text(F.col("edited"))).alias("edited_fingerprint"),
            F.when(placed, likeness(F.col("fingerprint"), F.col("edited"))).alias("near_edited"),
            F.when(placed, likeness(F.col("fingerprint"), F.col("following"))).alias("near_next"),
            "block",
            "unsure",
            (F.expr("kind = 0 and not copy")).alias("kept"),
        )

    # Rows of edited texts and copies are kept only where they are unsure.
    found = write_and_reread(compared(fingerprints(both, keys, "body", spare)).where("kept or unsure"), "fingerprints")
    # At most ``blocks`` numbers.
    again = [r.block for r in found.where("unsure").select("block").distinct().collect()]
    if again:
        in_full = fingerprints(both.where(F.col("block").isin(again)), keys, "body").withColumn("unsure", F.lit(False))
        found = found.where(~F.col("block").isin(again)).unionByName(compared(in_full))
    return found.where("kept").drop("block", "unsure", "kept")
