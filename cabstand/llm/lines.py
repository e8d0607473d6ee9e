"""Line dedup: a line goes if an earlier line equals it or differs from it by one word.

The edit distance counts words: one inserted, left out or exchanged. Blanks are evened out first. Lines are compared over
the whole table, in the order of document id and line number, as they stand in the input (a line that goes still counts
as an earlier one). Lines below ``min_words`` words go only if an earlier line equals them, and only those of
``equal_words`` words or more; without ``equal_words`` they stay.

The join is on deletion neighbourhoods: a line is joined with others through the hashes of all its variants with one word
left out. Two lines of equal length differ in one place at most if their variants without that place are equal; a line is
another one with a word more if leaving that word out gives it. Grouping by (length, hash, place) therefore makes every
member of a group a partner of all others, and by (length, hash) each longer line a partner of the shorter one. The
earliest member of a group is the only one that a group has to tell the others: a minimum over the group, never pairs.
Before that, two cheap keys per length set most lines aside without losing any: of two lines at distance one, either the
first half or the second half is equal word for word. Only lines that share such a half spell out their variants, and
only those with the left-out word in the other half. What variants have joined is verified on the words themselves.

Everything is built from SQL functions. Line contents are not shuffled for this; hashes are, the texts once, and the lines that
variants have joined.

Nulls and ties: NULL and empty texts have no lines to compare and stay as they are; a NULL id comes first; rows that
repeat an id and a text are one document, each is returned with the same lines; if an id has several texts, the
hash of the text decides their order. Other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstand.llm.common import row_keys, written

#: Doublings of the prefix scan: lines of up to 2**27 words.
SCAN_STEPS = 27
OTHER_BLANKS = "\t\x0b\x0c\r"
SUBSTITUTED, LONGER, SHORTER = 0, 1, 2


def uneven(text: Column) -> Column:
    """Whether a text has blanks that are not evened out, apart from those around its lines."""
    return reduce(Column.__or__, [F.contains(text, F.lit(blanks)) for blanks in (*OTHER_BLANKS, "  ")])


def even_lines(text: Column) -> Column:
    """The lines of a text with single blanks between words; numbering as in the text."""
    single = text
    for blank in OTHER_BLANKS:
        single = F.replace(single, F.lit(blank), F.lit(" "))
    # Most texts are even: one look tells, and nothing is replaced in them.
    single = F.when(uneven(text), F.regexp_replace(single, " +", " ")).otherwise(text)
    return F.transform(F.split(single, "\n"), lambda line: F.trim(line))


def halves(line: Column, n: Column) -> list[Column]:
    """Keys of (length, half): as a line of that length and, with one word fewer, as the longer of two.

    Words of an evened line are parted by single blanks, so a half is a stretch of the line itself: no list of words is cut.
    """

    def keys(length: Column, longer: bool) -> list[Column]:
        front = F.floor(length / 2).cast("int")
        back = (length - front).cast("int")
        words = lambda count: F.call_function("substring_index", line, F.lit(" "), count)
        first = F.xxhash64(length, F.lit(0), words(front))
        second = F.xxhash64(length, F.lit(1), words(-back))
        return [
            F.struct(key.alias("key"), F.lit(longer).alias("longer"), F.lit(side).alias("side"))
            for side, key in enumerate((first, second))
        ]

    return keys(n, False) + keys(n - 1, True)


#: Where a line stands; places sort like the lines of the table.
PLACE = ("t_id", "k1", "k2", "no")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The one form in which texts are dealt out: every join on them uses the same exchange."""
    body = F.col(text).cast("string")
    return docs.select(F.col(doc_id).alias("t_id"), body.alias("t_text"), *row_keys(F.col(doc_id), body))


def _lines(texts: DataFrame, least: int, whole: int) -> DataFrame:
    """One row per line: where it is, two hashes that name it, its length and, from ``whole`` words on, the four half keys."""
    rows = texts.select("t_id", "k1", "k2", F.posexplode(even_lines(F.col("t_text"))).alias("no", "line"))
    rows = rows.where(F.col("line") != "")
    rows = rows.withColumn("n", F.size(F.split("line", " ")))
    if least > 1:
        rows = rows.where(F.col("n") >= least)
    keys = [F.when(F.col("n") >= whole, key["key"]).alias(f"half{i}") for i, key in enumerate(halves(F.col("line"), F.col("n")))]
    return rows.select(*PLACE, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), "n", *keys)


def _needed(first: DataFrame) -> DataFrame:
    """Which variants each distinct line has to spell out: (id, needs), only for lines that share a half."""
    kinds = [(False, 0), (False, 1), (True, 0), (True, 1)]
    keyed = first.select(
        "id",
        F.explode(
            F.array(
                *[
                    F.struct(F.col(f"half{i}").alias("key"), F.lit(longer).alias("longer"), F.lit(side).alias("side"))
                    for i, (longer, side) in enumerate(kinds)
                ]
            )
        ).alias("k"),
    ).select("id", "k.*")
    live = (
        keyed.groupBy(F.col("key").alias("live_key"))
        .agg(F.count(F.when(~F.col("longer"), 1)).alias("equals"), F.count(F.when(F.col("longer"), 1)).alias("longers"))
        .where((F.col("equals") >= 2) | ((F.col("equals") >= 1) & (F.col("longers") >= 1)))
    )
    met = keyed.join(live, F.col("key") == F.col("live_key"))
    flag = lambda condition: F.max(F.when(condition, 1).otherwise(0))
    equal, longer = ~F.col("longer") & (F.col("equals") >= 2), F.col("longer") & (F.col("equals") >= 1)
    return met.groupBy("id").agg(
        # The half that is shared stands still; words are left out in the other one.
        flag(equal & (F.col("side") == 1)).alias("swap_front"),
        flag(equal & (F.col("side") == 0)).alias("swap_back"),
        flag(longer & (F.col("side") == 1)).alias("cut_front"),
        flag(longer & (F.col("side") == 0)).alias("cut_back"),
        flag(~F.col("longer") & (F.col("longers") >= 1)).alias("short"),
    )


def _exclusive_or(column: str) -> Column:
    return F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _scanned(df: DataFrame, column: str) -> DataFrame:
    """Running exclusive-or of an array of longs, by doubling steps."""
    for k in range(SCAN_STEPS):
        step = 1 << k
        df = df.withColumn(
            column,
            F.when(
                F.size(column) > step,
                F.transform(column, lambda x, i: x.bitwiseXOR(F.coalesce(F.get(column, i - step), F.lit(0).cast("long")))),
            ).otherwise(F.col(column)),
        )
    return df


def _variants(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """(n, hash, place, role) of every variant that is needed, with the line it comes from."""
    per_text = wanted.groupBy(F.col("k1").alias("w1"), F.col("k2").alias("w2")).agg(
        F.collect_list(
            F.struct("no", "id", "swap_front", "swap_back", "cut_front", "cut_back", "short")
        ).alias("wanted")
    )
    rows = (
        texts.join(per_text, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")))
        .select("t_id", "k1", "k2", even_lines(F.col("t_text")).alias("lines"), "wanted")
        .select("t_id", "k1", "k2", "lines", F.explode("wanted").alias("w"))
        .select("t_id", "k1", "k2", "w.*", F.split(F.get("lines", F.col("w.no")), " ").alias("words"))
        .withColumn("n", F.size("words"))
        .withColumn("at", F.transform("words", lambda word, i: F.xxhash64(word, i)))
        .withColumn("shifted", F.transform("words", lambda word, i: F.xxhash64(word, i - 1)))
        .withColumn("all_at", _exclusive_or("at"))
        .withColumn("all_shifted", _exclusive_or("shifted"))
        # Running values are needed only where a word is left out of a longer line.
        .withColumn("xor_at", F.when((F.col("cut_front") == 1) | (F.col("cut_back") == 1), F.col("at")).otherwise(F.array().cast("array<bigint>")))
        .withColumn("xor_shifted", F.when((F.col("cut_front") == 1) | (F.col("cut_back") == 1), F.col("shifted")).otherwise(F.array().cast("array<bigint>")))
    )
    rows = _scanned(_scanned(rows, "xor_at"), "xor_shifted")
    zero = F.lit(0).cast("long")
    before = lambda column, i: F.coalesce(F.get(column, i), zero)
    all_at, all_shifted = F.col("all_at"), F.col("all_shifted")
    variant = lambda n, hash_, place, role: F.struct(
        n.cast("int").alias("n"), hash_.alias("hash"), place.cast("int").alias("place"), F.lit(role).alias("role")
    )
    half, half_longer = F.floor(F.col("n") / 2), F.floor((F.col("n") - 1) / 2)
    back_longer = F.col("n") - (F.col("n") - 1 - half_longer)
    none = F.array().cast("array<struct<n:int,hash:bigint,place:int,role:int>>")
    places = F.sequence(F.lit(0), F.col("n") - 1)
    swapped = F.transform(
        F.filter(places, lambda p: F.when(p < half, F.col("swap_front")).otherwise(F.col("swap_back")) == 1),
        lambda p: variant(F.col("n"), all_at.bitwiseXOR(F.get("at", p)), p, SUBSTITUTED),
    )
    cut = F.transform(
        F.filter(
            places,
            lambda p: ((p < back_longer) & (F.col("cut_front") == 1)) | ((p >= half_longer) & (F.col("cut_back") == 1)),
        ),
        lambda p: variant(
            F.col("n") - 1,
            before("xor_at", p - 1).bitwiseXOR(all_shifted).bitwiseXOR(F.get("xor_shifted", p)),
            F.lit(-1),
            LONGER,
        ),
    )
    whole = F.when(F.col("short") == 1, F.array(variant(F.col("n"), all_at, F.lit(-1), SHORTER))).otherwise(none)
    return rows.select(
        F.struct(*PLACE).alias("line"), "id", F.explode(F.concat(swapped, F.array_distinct(cut), whole)).alias("v")
    ).select("line", "id", "v.*")


def _witnesses(variants: DataFrame) -> DataFrame:
    """(id, line, other): an earlier line that shares a variant."""
    group = Window.partitionBy("n", "hash", "place")
    origin = F.struct("line", "id")
    met = variants.select(
        "*",
        *[F.min(F.when(F.col("role") == role, origin)).over(group).alias(f"first{role}") for role in (SUBSTITUTED, LONGER, SHORTER)],
    )
    other = (
        F.when(F.col("role") == SUBSTITUTED, F.col(f"first{SUBSTITUTED}"))
        .when(F.col("role") == LONGER, F.col(f"first{SHORTER}"))
        .otherwise(F.col(f"first{LONGER}"))
    )
    met = met.withColumn("origin", other).where(F.col("origin.id") != F.col("id"))
    return met.withColumn("other", F.col("origin.line")).where(F.col("other") < F.col("line")).select("id", "line", "other").distinct()


def _key(place: str) -> list[Column]:
    """What names a line. Never NULL: said here, no filter of one use gets into the steps that all uses share, and their exchange is reused."""
    return [F.coalesce(F.col(f"{place}.{name}"), F.lit(0)).alias(name) for name in ("k1", "k2", "no")]


def _named_lines(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(n1, n2, n_no, text) of the lines that pairs name on either side. A text is opened once, whatever number of pairs names its lines."""
    sides = [pairs.select(F.col(f"{place}.t_id").alias("t_id"), *_key(place)) for place in ("line", "other")]
    places = sides[0].unionByName(sides[1]).distinct()
    asked = places.groupBy(F.col("k1").alias("w1"), F.col("k2").alias("w2")).agg(F.collect_list(F.struct("t_id", "no")).alias("asked"))
    return (
        texts.join(asked, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")))
        .select("t_id", "k1", "k2", even_lines(F.col("t_text")).alias("lines"), F.explode("asked").alias("place"))
        .where(F.col("t_id").eqNullSafe(F.col("place.t_id")))
        .select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("place.no").alias("n_no"), F.get("lines", F.col("place.no")).alias("text"))
        .distinct()
    )


def _with_words(pairs: DataFrame, named: DataFrame, place: str, words: str) -> DataFrame:
    same = [one == F.col(name) for one, name in zip(_key(place), ("n1", "n2", "n_no"))]
    return pairs.join(named, same).select(*pairs.columns, F.split("text", " ").alias(words))


def one_edit(left: Column, right: Column) -> Column:
    """Whether two word lists are at most one word apart: their common start and common end cover all but one word."""
    run = lambda a, b: F.array_position(
        F.concat(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.array(F.lit(False))), F.lit(False)
    ) - 1
    longest = F.greatest(F.size(left), F.size(right))
    return run(left, right) + run(F.reverse(left), F.reverse(right)) >= longest - 1


def removed_lines(docs: DataFrame, min_words: int = 8, doc_id: str = "doc_id", text: str = "text", equal_words: int | None = None) -> DataFrame:
    """(k1, k2, removed): the numbers of the lines that go, for each text that loses any."""
    texts = _texts(docs, doc_id, text)
    lines = _lines(texts, min_words if equal_words is None else equal_words, min_words)
    first = lines.groupBy("h1", "h2").agg(
        F.min(F.struct(*PLACE)).alias("line"),
        F.count("*").alias("times"),
        F.first("n").alias("n"),
        *[F.first(f"half{i}").alias(f"half{i}") for i in range(4)],
    )
    # One number for each distinct line, fixed by writing the table.
    first = written(first.withColumn("id", F.monotonically_increasing_id()), "lines")
    wanted = first.select("id", "line.*").join(_needed(first.where(F.col("n") >= min_words)), "id")
    pairs = _witnesses(_variants(wanted, texts))
    named = _named_lines(pairs, texts)
    pairs = _with_words(_with_words(pairs, named, "line", "words"), named, "other", "other_words")
    near = pairs.where(one_edit(F.col("words"), F.col("other_words"))).select("id").distinct().withColumn("near", F.lit(True))
    judged = (
        first.select("id", "h1", "h2", "line", "times")
        .join(near, "id", "left")
        .where((F.col("times") > 1) | F.col("near"))
        .select(F.col("h1").alias("j1"), F.col("h2").alias("j2"), F.col("line").alias("kept"), F.coalesce("near", F.lit(False)).alias("near"))
    )
    gone = (
        lines.select(*PLACE, "h1", "h2")
        .join(judged, (F.col("h1") == F.col("j1")) & (F.col("h2") == F.col("j2")))
        .where(F.col("near") | ~F.struct(*PLACE).eqNullSafe(F.col("kept")))
    )
    return gone.groupBy("k1", "k2").agg(F.array_distinct(F.collect_list("no")).alias("removed"))


def deduplicated(docs: DataFrame, min_words: int = 8, doc_id: str = "doc_id", text: str = "text", equal_words: int | None = None) -> DataFrame:
    """``docs`` without the lines that go, with ``n_lines``, ``n_compared`` (lines of ``min_words`` words, or of
    ``equal_words`` where given) and ``n_removed``; these three replace older ones."""
    least = min_words if equal_words is None else equal_words
    names = [name for name in docs.columns if name not in ("n_lines", "n_compared", "n_removed")]
    gone = removed_lines(docs, min_words, doc_id, text, equal_words).withColumnsRenamed({"k1": "g1", "k2": "g2"})
    others = [name for name in names if name not in (doc_id, text)]
    texts = _texts(docs, doc_id, text)
    if others:
        texts = docs.select(
            F.col(doc_id).alias("t_id"),
            F.col(text).cast("string").alias("t_text"),
            *row_keys(F.col(doc_id), F.col(text).cast("string")),
            F.struct(*[F.col(f"`{name}`") for name in others]).alias("others"),
        )
    joined = texts.join(gone, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left")
    # A column of its own that is used more than once, so that the lambda below doesn't split the text again for each line.
    joined = joined.withColumn("parts", F.split("t_text", "\n")).withColumn("n_parts", F.size("parts"))
    left = F.transform(
        F.array_except(F.sequence(F.lit(0), F.col("n_parts") - 1), F.col("removed")), lambda i: F.get("parts", i)
    )
    kept = F.when(F.col("removed").isNull(), F.col("t_text")).otherwise(F.array_join(left, "\n"))
    own = {doc_id: F.col("t_id"), text: kept}
    return joined.select(
        *[own.get(name, F.col("others").getField(name) if others else None).alias(name) for name in names],
        F.when(F.col("t_text").isNull(), 0).otherwise(F.col("n_parts")).cast("long").alias("n_lines"),
        F.size(F.filter(even_lines(F.coalesce("t_text", F.lit(""))), lambda line: (line != "") & (F.size(F.split(line, " ")) >= least)))
        .cast("long")
        .alias("n_compared"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )
