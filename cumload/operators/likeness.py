"""Names that are alike, found without comparing all with all.

The likeness is ``resolve.indel_ratio``. One insertion or deletion spoils at
most two bigrams, so two names within ``d`` of them share one of the
``2 d + 1`` rarest bigrams of either: only names that meet in such a bigram are
compared. Where only the best is asked for, names a letter apart come first.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumload.operators.resolve import _cut, whole_similarity

#: Below this likeness short names need not share a bigram.
LEAST = 0.9
#: Longer names are compared by bigrams alone.
WHOLE = 256


def bigrams(name: Column) -> Column:
    """Array of struct(gram, k): the bigrams of a name, the k-th of equal ones told apart."""
    grams = F.transform(F.sequence(F.lit(1), F.length(name) - 1), lambda i: F.substring(name, i, F.lit(2)))
    counted = F.transform(grams, lambda g, i: F.struct(g.alias("gram"), F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda x: x == g)).alias("k")))
    return F.when(F.length(name) > 1, counted).otherwise(F.array().cast("array<struct<gram:string,k:int>>"))


def _signatures(names: DataFrame, rarity: DataFrame, least: float) -> DataFrame:
    """name, gram, k of each name's rarest bigrams, as many as a partner within the likeness cannot all lack."""
    partner = F.floor(F.length("name") * ((2 - least) / least) + 1e-9)
    changes = F.floor((1 - least) * (F.length("name") + partner) + 1e-9)
    rows = names.select("name", F.explode(bigrams(F.col("name"))).alias("g")).select("name", "g.gram", "g.k").join(rarity, ["gram", "k"])
    order = Window.partitionBy("name").orderBy("n", "gram", "k")
    return rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= 2 * changes + 1).select("name", "gram", "k")


def similar_names(left: DataFrame, right: DataFrame, least: float = LEAST) -> DataFrame:
    """a, b, score of all pairs of distinct names with a likeness of ``least`` or more. Both: name.

    Null names are alike to none, and empty ones to empty ones; a name is compared whole, however long. The names meet by bigram and band of length, so
    that neither side is broadcast or collected.
    """
    if not LEAST <= least <= 1:
        raise ValueError(f"the likeness must be between {LEAST} and 1")
    a, b = (df.select("name").where("name IS NOT NULL").distinct() for df in (left, right))
    rarity = a.union(b).distinct().select(F.explode(bigrams(F.col("name"))).alias("g")).groupBy("g.gram", "g.k").agg(F.count("*").alias("n"))
    step = log((2 - least) / least) * (1 + 1e-9) if least < 1 else 1.0  # a hair wider than the ratio of lengths
    band = F.floor(F.log(F.length("name").cast("double")) / step)
    x = _signatures(a, rarity, least).select(F.col("name").alias("a"), "gram", "k", band.alias("band"))
    y = _signatures(b, rarity, least).select(F.col("name").alias("b"), "gram", "k", F.explode(F.sequence(band - 1, band + 1)).alias("band"))
    la, lb = F.length("a"), F.length("b")
    fits = 2 * F.least(la, lb) >= least * (la + lb) - 1e-9
    met = x.join(y, ["gram", "k", "band"]).where(fits).select("a", "b").distinct().where("a <> b")
    scored = met.withColumn("score", whole_similarity(F.col("a"), F.col("b"))).where(F.col("score") >= least)
    return scored.unionByName(a.join(b, "name", "left_semi").select(F.col("name").alias("a"), F.col("name").alias("b"), F.lit(1.0).alias("score")))


def deletions(name: Column) -> Column:
    """The distinct strings that a name of one letter or more leaves when one letter goes."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name)))))


def canonical_places(names: DataFrame, places: DataFrame, least: float = LEAST) -> DataFrame:
    """folded, place of each stated name: the place of that name, else the most alike one from ``least`` on.

    Of places alike in the same degree, and of those of one name, the lowest counts. ``names``: folded; ``places``: folded, place.

    The likeness falls with the letters that differ: no name is more alike than an equal one, then one of a letter more,
    then one of a letter less. Those are found by equality, whatever the bigrams; only names without one go to
    ``similar_names``, as do names over ``WHOLE`` letters, whose deletions would be long.
    """
    known = places.where("folded IS NOT NULL").groupBy("folded").agg(F.min(F.col("place").cast("string")).alias("place"))
    n = F.length("folded")
    asked = names.select("folded").where("folded IS NOT NULL").distinct()
    longer = known.where((n > 0) & (n <= WHOLE + 1)).select(F.explode(deletions(F.col("folded"))).alias("_cut"), "place").groupBy("_cut").agg(F.min("place").alias("_longer"))
    near = asked.join(known, "folded", "left").join(longer, (F.col("folded") == F.col("_cut")) & (n <= WHOLE) & (2 * n / (2 * n + 1) >= least), "left")
    first = _cut(near.select("folded", F.coalesce("place", "_longer").alias("place")))
    cut = first.where(F.col("place").isNull() & (n > 0) & (n <= WHOLE) & (2 * (n - 1) / (2 * n - 1) >= least)).select(F.col("folded").alias("_of"), F.explode(deletions(F.col("folded"))).alias("folded"))
    shorter = cut.join(known, "folded").groupBy("_of").agg(F.min("place").alias("_shorter"))
    second = _cut(first.where("place IS NULL").select("folded").join(shorter, F.col("folded") == F.col("_of"), "left").select("folded", F.col("_shorter").alias("place")))
    rest = second.where("place IS NULL").select(F.col("folded").alias("name"))
    settled = first.where("place IS NOT NULL").unionByName(second.where("place IS NOT NULL"))
    if rest.isEmpty():
        return settled
    pairs = similar_names(rest, known.select(F.col("folded").alias("name")), least)
    alike = pairs.join(known, F.col("b") == F.col("folded")).groupBy(F.col("a")).agg(F.min_by("place", F.struct((-F.col("score")).alias("s"), "place")).alias("place"))
    return settled.unionByName(alike.select(F.col("a").alias("folded"), "place"))
