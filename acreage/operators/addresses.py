"""Match of permit addresses to civic addresses, with a score.

An address equal to a civic's after normalisation scores 100. Otherwise the street names of civics with the
same house number and community are compared: ``floor(100 * (1 - edit distance / longer length))``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import filled, house_number
from acreage.operators.spread import fits_broadcast, lookup_join, salted_join
from acreage.session import stored

# Fixed value: a match must score above this.
SCORE_MINIMUM = 60
ADDRESS = ["house", "street", "community"]


def _normal(text: Column) -> Column:
    return filled(F.upper(F.trim(text)))


def address_key(number: str, street: str, community: str) -> list[Column]:
    return [
        _normal(house_number(F.col(number))).alias("house"),
        _normal(F.col(street)).alias("street"),
        _normal(F.col(community)).alias("community"),
    ]


def _grams(street: Column, score_minimum: int) -> Column:
    """What two names with a score above the minimum share at least one of.

    Every edit touches one letter and two pairs of adjacent letters, start and end marks included. Fewer edits than
    half the longer name's letters leave a pair, and fewer edits than its letters leave a letter.
    """
    size = 2 if score_minimum >= 50 else 1
    marked = F.concat(F.lit("^"), street, F.lit("$")) if size == 2 else street
    at = F.sequence(F.lit(1), F.length(marked) - size + 1)
    return F.array_sort(F.array_distinct(F.transform(at, lambda i: F.substring(marked, i, F.lit(size)))))


def _score(one: Column, other: Column) -> Column:
    longer = F.greatest(F.length(one), F.length(other))
    return F.floor((longer - F.levenshtein(one, other)) * 100 / longer).cast("int")


def match_addresses(addresses: DataFrame, civics: DataFrame, score_minimum: int = SCORE_MINIMUM) -> DataFrame:
    """The best civic above the score for each distinct address ``(house, street, community)``.

    ``civics`` has ``CIV_ID, house, street, community, X, Y``. Candidates join on a pair of adjacent letters beside
    house number and community (on a letter where the minimum is below 50), and each candidate is scored at its first
    shared one only. ``score_minimum`` is 0 or more: names with nothing in common score 0 and match nothing.
    """
    if score_minimum < 0:
        raise ValueError("score_minimum must be 0 or more")
    wanted = stored(addresses.select(*ADDRESS).dropna().distinct())
    # one civic per address: copies of an address are one candidate, the lowest id standing for them
    known = civics.dropna(subset=ADDRESS).groupBy(*ADDRESS).agg(F.min(F.struct("CIV_ID", "X", "Y")).alias("civic"))
    exact = wanted.join(known, ADDRESS).select(*ADDRESS, F.lit(100).alias("score"), "civic")
    rest = wanted.join(known, ADDRESS, "left_anti")
    left = rest.withColumn("gram", F.explode(_grams(F.col("street"), score_minimum)))
    right = known.withColumnRenamed("street", "their_street")
    right = stored(right.withColumn("gram", F.explode(_grams(F.col("their_street"), score_minimum))), "civic-grams")
    shared = F.array_intersect(_grams(F.col("street"), score_minimum), _grams(F.col("their_street"), score_minimum))
    candidates = salted_join(
        left, right, on=["house", "community", "gram"], by=["street"], small=fits_broadcast(right)
    ).where(F.col("gram") == F.array_min(shared))
    scored = candidates.withColumn("score", _score(F.col("street"), F.col("their_street")))
    close = scored.where(F.col("score") > score_minimum).groupBy(*ADDRESS).agg(
        F.max_by(F.struct("score", "civic"), F.struct("score", -F.col("civic.CIV_ID"))).alias("best")
    )
    near = close.select(*ADDRESS, F.col("best.score").alias("score"), F.col("best.civic").alias("civic"))
    return exact.unionByName(near).select(
        *ADDRESS,
        F.col("civic.CIV_ID").alias("match_id"),
        "score",
        F.col("civic.X").alias("match_x"),
        F.col("civic.Y").alias("match_y"),
    )


def geocode_addresses(permits: DataFrame, civics: DataFrame, score_minimum: int = SCORE_MINIMUM) -> DataFrame:
    """Permits with their match, null where there is none: no address, or no civic above the score."""
    keys = dict(zip(ADDRESS, address_key("Civic_Number", "Street_Name", "Community"), strict=True))
    keyed = stored(permits.withColumns(keys))
    points = civics.select("CIV_ID", *address_key("FULL_CIVIC", "STR_NAME", "GSA_NAME"), "X", "Y")
    matches = stored(match_addresses(keyed, points, score_minimum))
    return lookup_join(keyed, matches, ADDRESS, probe=True).drop(*ADDRESS)
