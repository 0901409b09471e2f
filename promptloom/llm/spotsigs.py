"""Spot signatures: chains of content words after common words, compared by Jaccard similarity.

Only DataFrame operations: sets of signatures are arrays of 32-bit hashes made by column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptloom.llm.common import written

# Common words of English, French, German and Spanish that open a chain.
COMMON = (
    "a an and are as at be been but by for from had has have he her his in is it not of on or she that the their they "
    "this to was we were which will with you "
    "au aux ce cette dans de des du elle en est et il je la le les leur mais ne nous ou par pas pour que qui sa se ses "
    "son sur un une vous "
    "aber auf aus bei das dem den der die ein eine einem einen einer er es hat ich im ist mit nach nicht sich sie sind "
    "und von war wie wir zu zum zur "
    "al como con del el ella ellos era esta este fue ha las lo los más no para pero por se sin su sus y"
).split()
# Content words of a chain.
CHAIN = 2
# Of the content words themselves one in so many, chosen by hash, opens a chain too: texts in other
# languages have no common word.
ONE_IN = 8
SPLITTER = "[^\\p{L}\\p{N}]+"
_NO_ID = -(1 << 63)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spots(text: Column) -> Column:
    """The distinct spot signatures of a text, in ascending order; null has none.

    Words are runs of letters and digits in lower case. A common word opens a chain with the next
    content words, which are those that are not common; near the end chains are shorter. A text
    without any chain takes every word for one.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLITTER), lambda word: word != "")

    def chained(both: Column) -> Column:
        words, content = both["words"], both["content"]
        after = lambda first: [F.get(content, first + k) for k in range(CHAIN)]
        places = F.filter(
            F.transform(words, lambda word, i: F.when(word.isin(COMMON), i)), lambda place: place.isNotNull()
        )
        # The j-th common word, at place p, has p - j content words before it.
        common = F.transform(places, lambda p, j: F.hash(F.get(words, p), *after(p - j)))
        chosen = F.filter(
            F.transform(content, lambda word, i: F.when(F.pmod(F.hash(word), F.lit(ONE_IN)) == 0, F.hash(word, *after(i + 1)))),
            lambda signature: signature.isNotNull(),
        )
        return F.concat(common, chosen)

    def signatures(words: Column) -> Column:
        content = F.filter(words, lambda word: ~word.isin(COMMON))
        return _with(
            _with(F.struct(words.alias("words"), content.alias("content")), chained),
            lambda found: F.when(F.size(found) > 0, found).otherwise(F.transform(words, lambda word: F.hash(word))),
        )

    return F.array_sort(F.array_distinct(_with(words, signatures)))


def fingerprint(spots: Column) -> Column:
    """A set of signatures as text: eight hexadecimal digits for each, in the order of the set."""
    digits = lambda x: F.lpad(F.lower(F.hex(x.cast("bigint").bitwiseAND(0xFFFFFFFF))), 8, "0")
    return F.array_join(F.transform(spots, digits), "")


def likeness(one: Column, other: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without a comparison where their sizes rule out `least`.

    Two empty sets are alike. The sizes alone bound the similarity by the smaller over the larger.
    """
    a, b = F.size(one), F.size(other)
    shared = _with(F.size(F.array_intersect(one, other)), lambda n: n / (a + b - n))
    bound = F.least(a, b) / F.greatest(a, b)
    return F.when((a == 0) & (b == 0), 1.0).when((F.least(a, b) == 0) | (bound < least), 0.0).otherwise(shared)


def with_next(docs: DataFrame, columns: dict[str, Callable[[Column], Column]], id_column: str, text_column: str) -> DataFrame:
    """(k, text, next_text) and, for each of `columns`, its value for the row and `next_` for the one after.

    Rows are dealt out in ranges of the id that begin at ids of the table; a range's first row also
    goes to the range before, and the table's first to the last, so that each range is complete in
    itself. The text is shuffled once, and no task holds more than its range.
    """
    spark = docs.sparkSession
    k = F.coalesce(F.col(id_column).cast("bigint"), F.lit(_NO_ID))
    rows = docs.select(k.alias("k"), F.col(text_column).alias("text"), k.cast("double").alias("at"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = 4 * partitions
    cuts = rows.approxQuantile("at", [i / count for i in range(count)], 0.25 / count)
    first = rows.agg(F.min("at")).first()[0]
    inner = sorted({cut for cut in cuts if cut > first}) if cuts else []
    if inner:
        splits = [float("-inf"), *inner, float("inf")]
        ranged = Bucketizer(splits=splits, inputCol="at", outputCol="range").transform(rows)
        begins = Bucketizer(splits=splits, inputCol="before", outputCol="range_before")
        # The largest number below `at` lies in another range if and only if `at` begins a range.
        below = F.when(F.col("at") == 0, F.lit(-5e-324)).otherwise(F.col("at") - F.abs(F.col("at")) * 2.0**-53 * 1.5)
        ranged = begins.transform(ranged.withColumn("before", below))
    else:
        ranged = rows.select("*", F.lit(0.0).alias("range"), F.lit(0.0).alias("range_before"))
    own = F.struct(F.col("range").cast("int").alias("range"), F.lit(0).alias("turn"))
    ahead = F.when(F.col("range_before") < F.col("range"), F.struct((F.col("range") - 1).cast("int").alias("range"), F.lit(1).alias("turn")))
    around = F.when(F.col("at") == F.lit(first), F.struct(F.lit(len(inner)).alias("range"), F.lit(2).alias("turn")))
    places = F.explode(F.array_compact(F.array(own, ahead, around)))
    dealt = ranged.select("k", "text", places.alias("place")).select("k", "text", "place.range", "place.turn")
    valued = dealt.repartition(partitions, "range").select("*", *[make(F.col("text")).alias(name) for name, make in columns.items()])
    order = Window.partitionBy("range").orderBy("turn", "k", F.xxhash64("text"), "text")
    names = ["text", *columns]
    return valued.select("k", "turn", *names, *[F.lead(name).over(order).alias(f"next_{name}") for name in names]).filter("turn = 0").drop("turn")


def edited_text(text: Column, next_text: Column) -> Column:
    """A text whose last quarter of characters is as many of the next text's first."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(next_text, F.lit(1), quarter))


def fingerprint_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    Null texts are empty; an empty text has an empty fingerprint, alike to empty ones only; texts of
    any length are read whole. Rows are in the order of their ids, null first, then of a hash of the
    text; the row after the last is the first, also of a table of one row. An empty table gives an
    empty one.
    """
    whole = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = with_next(whole, {"spots": spots}, "id", "text")
    edited = found.select(
        F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"),
        F.char_length("text").cast("bigint").alias("n_chars"),
        "spots",
        "next_spots",
        edited_text(F.col("text"), F.col("next_text")).alias("edited"),
    )
    compared = edited.select("*", spots(F.col("edited")).alias("edited_spots"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def spot_links(docs: DataFrame, least: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Classes and links of all texts with a likeness of `least` or more.

    The first table has (doc_id, class_id): texts with equal sets are one class, known by its
    smallest id. The second has (a, b, likeness) of linked classes, a below b. Sets are put in
    partitions by length, whose bounds grow by 1 / least, so that links lie in one partition or in
    two next to each other. Two sets that are alike enough share one of the rarest signatures of
    each: as many as may be missing from the other, and one. Those are joined, by partition, and
    only pairs whose lengths allow the likeness are compared by their whole sets. Rows without
    signatures or ids are not linked; copies never become pairs.
    """
    sets = written(
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"), spots(F.col(text_column)).alias("spots")).filter(
            F.col("doc_id").isNotNull()
        )
    )
    key = [F.xxhash64("spots"), F.sha2(F.array_join("spots", ","), 256)]
    keyed = sets.select("doc_id", "spots", key[0].alias("key"), key[1].alias("proof"))
    firsts = keyed.groupBy("key", "proof").agg(F.min("doc_id").alias("class_id"))
    classes = written(keyed.join(firsts, ["key", "proof"]).select("doc_id", "class_id", "spots"))
    heads = classes.filter("doc_id = class_id AND size(spots) > 0").dropDuplicates(["class_id"])
    heads = heads.select("class_id", "spots", F.size("spots").alias("n"))
    single = heads.select("class_id", "n", F.explode("spots").alias("spot"))
    counts = single.groupBy("spot").agg(F.count("*").alias("times"))
    rank = F.row_number().over(Window.partitionBy("class_id").orderBy("times", "spot"))
    needed = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1
    rare = single.join(counts.filter("times > 1"), "spot", "left").withColumn("times", F.coalesce("times", F.lit(1)))
    prefix = rare.withColumn("rank", rank).filter((F.col("rank") <= needed) & (F.col("times") > 1))
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.0 / least)) + 1e-9).cast("int")
    left = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("na"), "spot", part.alias("part"))
    both = F.explode(F.array(part, part + 1))
    right = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "spot", both.alias("part"))
    sized = (F.col("nb") <= F.col("na")) & (F.col("nb") >= F.col("na") * least - 1e-9)
    ordered = (F.col("nb") < F.col("na")) | (F.col("a") < F.col("b"))
    pairs = left.join(right, ["part", "spot"]).filter(sized & ordered & (F.col("a") != F.col("b"))).select("a", "b").distinct()
    named = lambda name: heads.select(F.col("class_id").alias(name), F.col("spots").alias(f"spots_{name}"))
    compared = pairs.join(named("a"), "a").join(named("b"), "b").select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        likeness(F.col("spots_a"), F.col("spots_b"), least).alias("likeness"),
    )
    return classes.select("doc_id", "class_id"), compared.filter(F.col("likeness") >= least)
