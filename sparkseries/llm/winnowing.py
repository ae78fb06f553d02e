"""Document fingerprints by winnowing, with DataFrame functions only.

K-grams are of words or of code points, as `unit` says. Each window of `window` k-grams gives up its smallest hash, the rightmost of
equal ones, together with its place. A run of window + k - 1 words (code points) that two texts share therefore leaves a common hash in
both fingerprints, and a run of fewer than k leaves none.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KGRAM = 3
WINDOW = 8
#: Code points in a k-gram of these.
CHARACTERS = 8
#: The polynomial over a k-gram: its value at BASE modulo a prime, so that products fit in 63 bits.
PRIME = (1 << 31) - 1
BASE = 0x2545F491
#: A hash, negated, and its place share 64 bits, so that the greatest number has the smallest hash and of equal ones the rightmost. The place is in
#: the 31 lowest bits.
LAST_PLACE = (1 << 31) - 1
SPACES = "[\\x20\\x09-\\x0D]+"


def with_fingerprint(df: DataFrame, text_col: str, out: str, k: int = KGRAM, window: int = WINDOW, unit: str = "words") -> DataFrame:
    """The rows with `out`: the chosen k-grams of a text by place, each as one number; see `hashes` and `places`.

    A text of fewer than k units is one k-gram, a text without any has none; fewer k-grams than a window holds are one window. Each step is a
    column of its own, because a later step reads it more than once.
    """
    grams = f"{out}_grams"
    df = {"words": _word_grams, "characters": _character_grams}[unit](df, text_col, grams, k)
    df = df.withColumn(out, F.col(grams))
    span = 1
    while span < window:
        step = min(span, window - span)
        later = F.slice(out, step + 1, F.greatest(F.size(out) - step, F.lit(0)))
        # Beyond the end one side is missing; the greatest of one number is itself.
        df = df.withColumn(out, F.zip_with(F.col(out), later, lambda a, b: F.greatest(a, b)))
        span += step
    full = F.greatest(F.size(grams) - (window - 1), F.least(F.size(grams), F.lit(1)))
    return df.withColumn(out, F.array_distinct(F.slice(out, F.lit(1), full))).drop(grams)


def _packed(negated: Column, place: Column) -> Column:
    """A negated hash and its place as one number."""
    return F.shiftleft(negated, 31).bitwiseOR(place.cast("long"))


def _hash(entry: Column) -> Column:
    return -F.shiftright(entry, 31)


def _place(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(LAST_PLACE).cast("long"))


def _word_grams(df: DataFrame, text_col: str, grams: str, k: int) -> DataFrame:
    """The rows with the packed k-grams of the words of a text."""
    words = f"{grams}_words"
    df = df.withColumn(words, F.transform(F.filter(F.split(text_col, SPACES), lambda w: w != ""), lambda w: F.xxhash64(w)))
    number = F.greatest(F.size(words) - (k - 1), F.least(F.size(words), F.lit(1)))

    def packed(h: Column, place: Column) -> Column:
        # Words beyond the end are null, which the hash skips.
        gram = F.xxhash64(h, *[F.get(F.col(words), place + step) for step in range(1, k)])
        return _packed(-gram.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), place)

    return df.withColumn(grams, F.slice(F.transform(F.col(words), packed), F.lit(1), number)).drop(words)


def _character_grams(df: DataFrame, text_col: str, grams: str, k: int) -> DataFrame:
    """The rows with the packed k-grams of the code points of a text.

    The polynomials of all places are put together from those of half as many code points, so a place costs log2(k) steps; a
    hash that rolls on from place to place would need an array that grows by copies.
    """
    part, n = f"{grams}_1", F.col(f"{grams}_n")
    # Columns of their own, because each use of a length would count the text again.
    df = df.withColumn(f"{grams}_n", F.length(text_col))
    # The number of a code point is 30 bits of its hash, plus one. All bits turned over give it negated, and so are the polynomials made of these, as
    # a remainder has the sign of its dividend.
    codes = F.transform(F.split(text_col, ""), lambda c: F.bitwise_not(F.xxhash64(c).bitwiseAND(F.lit(0x3FFFFFFF).cast("long"))))
    # A short text is filled up with zeros to one k-gram, so no step has to look for a missing number: a null at the end is of a place without a k-gram.
    codes = F.when(n < k, F.concat(codes, F.array_repeat(F.lit(0).cast("long"), k - F.greatest(n, F.lit(1))))).otherwise(codes)
    df, made, spans = df.withColumn(part, codes), [f"{grams}_n", part], {1: part}

    def joined(b: int) -> Callable[[Column, Column], Column]:
        """The polynomial of two runs of code points from those of the first and of the next b; where these are beyond the end, null."""
        power = F.lit(pow(BASE, b, PRIME)).cast("long")
        return lambda x, y: (x * power + y) % F.lit(PRIME).cast("long")

    span, joins = 1, []
    while span * 2 <= k:
        spans[span * 2] = f"{grams}_{span * 2}"
        joins.append((spans[span], spans[span], span, span, spans[span * 2]))
        span *= 2
    whole, rest = spans[span], span
    for size in sorted((s for s in spans if k & s and s != span), reverse=True):
        name = f"{grams}_{rest + size}"
        joins.append((whole, spans[size], rest, size, name))
        whole, rest = name, rest + size
    for left, right, a, b, name in joins[:-1]:
        later = F.slice(right, a + 1, F.greatest(F.size(right) - a, F.lit(0)))
        df = df.withColumn(name, F.zip_with(F.col(left), later, joined(b)))
        made.append(name)

    def packed(x: Column, place: Column) -> Column:
        """The last join and the packing in one step over the places."""
        for _left, right, a, b, _name in joins[-1:]:
            x = joined(b)(x, F.get(F.col(right), place + a))
        return _packed(x, place)

    number = F.greatest(n - (k - 1), F.least(n, F.lit(1)))
    last = joins[-1][0] if joins else part
    return df.withColumn(grams, F.slice(F.transform(F.col(last), packed), F.lit(1), number)).drop(*made)


def hashes(fingerprint: Column | str) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(fingerprint, _hash))


def places(fingerprint: Column | str) -> Column:
    """The places of a fingerprint's k-grams, counted in words or code points."""
    return F.transform(fingerprint, _place)


def fingerprint_text(fingerprint: Column | str) -> Column:
    """A fingerprint as text: hash in hexadecimal digits, @ and place, joined by spaces."""
    return _entries_text(_entries(fingerprint))


def with_fingerprint_texts(df: DataFrame, out: str, edited_out: str) -> DataFrame:
    """The rows of `compare_with_next` with the two fingerprints as texts.

    The entries that an edited text's fingerprint has from the text's own are written once, in a column of their own because both texts read it.
    """
    entries, shared = f"{out}_entries", F.col("n_shared")
    df = df.withColumn(entries, _entries("fp"))
    more = _entries(F.slice("edited_fp", shared + 1, F.size("edited_fp")))
    edited = F.concat(F.slice(entries, F.lit(1), shared), more)
    return df.withColumn(out, _entries_text(F.col(entries))).withColumn(edited_out, _entries_text(edited)).drop(entries)


def _entries(fingerprint: Column | str) -> Column:
    digits = F.transform(fingerprint, lambda x: F.hex(_hash(x)))
    return F.zip_with(digits, places(fingerprint).cast("array<string>"), lambda h, place: F.concat(h, F.lit("@"), place))


def _entries_text(entries: Column) -> Column:
    # Lower case for the whole at once.
    return F.lower(F.array_join(entries, " "))


def with_likeness(df: DataFrame, left: str, right: str, out: str, left_hashes: str | None = None) -> DataFrame:
    """The rows with `out`: the share of common hashes among all hashes of two fingerprints; 1 if neither has any.

    `left_hashes` is a column that already holds the hashes of the first.
    """
    a, b, common = left_hashes or f"{out}_a", f"{out}_b", f"{out}_common"
    if not left_hashes:
        df = df.withColumn(a, hashes(left))
    df = df.withColumn(b, hashes(right))
    df = df.withColumn(common, F.size(F.array_intersect(a, b)))
    everything = F.size(a) + F.size(b) - F.col(common)
    df = df.withColumn(out, F.when(everything == 0, F.lit(1.0)).otherwise(F.col(common) / everything))
    return df.drop(b, common) if left_hashes else df.drop(a, b, common)


def with_next(df: DataFrame, id_col: str, add, *columns: str) -> DataFrame:
    """`add(rows)` with `next_<column>` for each named column: its value in the next row by ascending id, after the last row that of the first.

    Rows are dealt to ranges of ids, in one shuffle. The first row of each range also goes to the range before it, so that the last row there
    finds what follows; such guests are dropped again. Null ids come first, rows with equal ids are in the order of `columns[0]`.
    """
    ids = df.select(F.col(id_col).alias("id"))
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / wanted for i in range(1, wanted)]
    # At most as many bounds as ranges reach the driver, and as many first ids.
    bounds = sorted(set(ids.agg(F.percentile_approx("id", shares, 20_000)).first()[0] or []))
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)] or [[]]

    def range_of(value: Column) -> Column:
        """How many bounds are at most the value: first whole groups of bounds, then inside one."""
        heads = F.lit([g[0] for g in groups if g]).cast("array<long>")
        group = F.size(F.filter(heads, lambda b: b <= value)) - 1
        inside = F.size(F.filter(F.get(F.lit(groups).cast("array<array<long>>"), group), lambda b: b <= value))
        return F.when(value.isNull() | (group < 0), F.lit(0)).otherwise(group * step + inside)

    first = F.min(F.struct(F.col("id").isNotNull().alias("known"), "id"))["id"]
    firsts = {r["range"]: r["first"] for r in ids.groupBy(range_of(F.col("id")).alias("range")).agg(first.alias("first")).collect()}
    used = sorted(firsts)
    before = [used[used.index(r) - 1] if r in firsts else None for r in range(len(bounds) + 1)]
    first_ids = F.lit([firsts.get(r) for r in range(len(bounds) + 1)]).cast("array<long>")
    own = df.withColumn("range", range_of(F.col(id_col)))
    opens = F.col(id_col).eqNullSafe(F.get(first_ids, F.col("range")))
    home = F.struct(F.lit(False).alias("guest"), F.col("range").alias("range"))
    away = F.struct(F.lit(True).alias("guest"), F.get(F.lit(before).cast("array<int>"), F.col("range")).alias("range"))
    stays = own.withColumn("stay", F.explode(F.when(opens, F.array(home, away)).otherwise(F.array(home)))).drop("range")
    dealt = stays.select("*", "stay.guest", "stay.range").drop("stay").repartition("range")
    order = Window.partitionBy("range").orderBy("guest", F.asc_nulls_first(id_col), F.asc_nulls_first(columns[0]))
    added = add(dealt)
    following = added.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return following.where(~F.col("guest")).drop("guest", "range")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = KGRAM, window: int = WINDOW, unit: str = "words"
) -> DataFrame:
    """(doc_id, text, fp) for every row: the fingerprint of the whole text; a null text counts as empty."""
    return with_fingerprint(_texts(docs, id_col, text_col), "text", "fp", k, window, unit)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def compare_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = KGRAM, window: int = WINDOW, unit: str = "words"
) -> DataFrame:
    """(doc_id, n_chars, edited, fp, edited_fp, n_shared, near_edited, near_next) for every row.

    `edited` is the text with its last half (rounded down, in code points) replaced by as many from the start of the next
    document by id, or all it has. `n_shared` entries at the start of `edited_fp` are known to be those of `fp`. A null text is
    empty, a null id comes first, rows with equal ids are in the order of their texts, a single row follows itself, an empty table gives an empty
    result.
    """
    texts = _texts(docs, id_col, text_col)
    rows = with_next(texts, "doc_id", lambda dealt: with_fingerprint(dealt, "text", "fp", k, window, unit), "text", "fp")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    # Of use for both likenesses.
    rows = rows.withColumn("hashes", hashes("fp"))
    rows = with_likeness(rows, "fp", "next_fp", "near_next", "hashes")
    chosen = ["doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "hashes", "near_next"]
    if unit == "characters":
        rows = _with_edited_fingerprint(rows.select(*chosen, "next_fp", (n - half).cast("long").alias("cut")), k, window)
    else:
        rows = with_fingerprint(rows.select(*chosen), "edited", "edited_fp", k, window, unit).withColumn("n_shared", F.lit(0))
    return with_likeness(rows, "fp", "edited_fp", "near_edited", "hashes").drop("hashes")


def _with_edited_fingerprint(rows: DataFrame, k: int, window: int) -> DataFrame:
    """The rows with `edited_fp` and `n_shared`, where `edited` has the first `cut` code points of the text whose fingerprint is `fp`, then the first of the next's.

    Windows that end before the cut are the text's own: what they chose is the start of its fingerprint. Windows that begin behind it are the
    next text's, the start of `next_fp`. Only the code points of the windows between are hashed, however long the texts are.
    """
    reach = k + window - 2
    # The first window with a code point behind the cut; a long number as the entries are, so that none of these has to be converted.
    rows = rows.withColumn("own", F.greatest(F.col("cut") - reach, F.lit(0).cast("long")))
    # How many windows are the next text's, a column of its own because a length takes as long as its text; less than 1 for none.
    rows = rows.withColumn("theirs", F.length("edited") - F.col("cut") - reach)
    rest = F.substring(F.col("edited"), (F.col("own") + 1).cast("int"), (F.col("cut") - F.col("own") + reach).cast("int"))
    rows = rows.withColumn("rest", rest)
    rows = with_fingerprint(rows, "rest", "rest_fp", k, window, "characters")

    # Places ascend. An entry before a window is chosen before it; of those behind, only the next few can be, so only they are looked at closely.
    sure = {"fp": "fp_sure", "next_fp": "next_fp_sure"}
    rows = rows.withColumn(sure["fp"], F.size(F.filter("fp", lambda x: _place(x) < F.col("own"))))
    rows = rows.withColumn(sure["next_fp"], F.size(F.filter("next_fp", lambda x: _place(x) < F.col("theirs"))))

    def chosen_before(fingerprint: str, end: Column) -> Column:
        """What the windows before one have chosen: an entry's first window is where it comes in, if it is greater than the one before, or when that goes out."""
        known = F.col(sure[fingerprint])

        def first_window(x: Column, at: Column) -> Column:
            before = F.get(F.col(fingerprint), known + at - 1)
            comes_in = F.greatest(_place(x) - (window - 1), F.lit(0).cast("long"))
            return F.when(before.isNull() | (x > before), comes_in).otherwise(_place(before) + 1)

        close = F.slice(F.col(fingerprint), known + 1, F.lit(window - 1))
        return F.concat(F.slice(F.col(fingerprint), F.lit(1), known), F.filter(close, lambda x, at: first_window(x, at) < end))

    rows = rows.withColumn("kept", chosen_before("fp", F.col("own")))
    kept = F.col("kept")
    shifted = F.transform("rest_fp", lambda x: x + F.col("own"))
    following = F.transform(chosen_before("next_fp", F.col("theirs")), lambda x: x + F.col("cut"))
    # Where nothing follows the cut, all windows are the text's own.
    nothing = (F.col("own") > 0) & (F.col("theirs") == -reach)
    found = F.when(nothing, kept).otherwise(F.array_distinct(F.concat(kept, shifted, following)))
    rows = rows.withColumn("edited_fp", found).withColumn("n_shared", F.size(kept))
    return rows.drop("own", "theirs", "rest", "rest_fp", "kept", "next_fp", "cut", *sure.values())
