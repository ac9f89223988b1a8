"""The full address locator: all eight fields of a civic address, with a weighted score.

A candidate has the address's house number and a street name that scores above ``name_minimum`` by edit distance. Street
names are compared apart from the addresses, each different pair once, and only pairs that share a rare pair of
adjacent letters meet. The type of a street ("ST", "Road") is a field of its own, also where it is written into the
name, so that a common ending does not make names alike. The other fields add to the score where the address has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.text import filled, house_number
from acreage.operators.spread import fits_broadcast, lookup_join, salted_join
from acreage.session import stored

# What the fields weigh, out of 100, and the scores that a match must be above.
WEIGHTS = {"name": 60, "type": 10, "community": 12, "postal": 8, "district": 4, "municipality": 3, "unit": 3}
MINIMUM = 60
NAME_MINIMUM = 60
# Street types and their short forms.
STREET_TYPES = {
    "AVENUE": "AVE", "BOULEVARD": "BLVD", "CIRCLE": "CIR", "CLOSE": "CLOSE", "COURT": "CRT", "CRESCENT": "CRES",
    "DRIVE": "DR", "HEIGHTS": "HTS", "HIGHWAY": "HWY", "HILL": "HILL", "LANE": "LANE", "PARKWAY": "PKY", "PLACE": "PL",
    "ROAD": "RD", "ROW": "ROW", "RUN": "RUN", "SQUARE": "SQ", "STREET": "ST", "TERRACE": "TERR", "TRAIL": "TRAIL",
    "WALK": "WALK", "WAY": "WAY",
}
ADDRESS = ["house", "name", "type", "unit", "district", "community", "municipality", "postal"]


def _normal(text: Column) -> Column:
    return filled(F.upper(F.trim(F.regexp_replace(text, r"\s+", " "))))


def short_type(text: Column) -> Column:
    """A street type's short form; another text stays as it is."""
    pairs = [F.lit(x) for pair in STREET_TYPES.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), text), text)


def address_fields(
    number: Column, street: Column, kind: Column, unit: Column, district: Column, community: Column, municipality: Column, postal: Column
) -> dict[str, Column]:
    """The eight fields in normal form. A type at the end of the street's name is taken off it; ``kind`` goes before it."""
    whole = _normal(street)
    last = F.substring_index(whole, " ", -1)
    known = [*STREET_TYPES, *STREET_TYPES.values()]
    ends = last.isin(*dict.fromkeys(known)) & (F.length(whole) > F.length(last))
    name = F.when(ends, F.rtrim(F.substring(whole, F.lit(1), F.length(whole) - F.length(last)))).otherwise(whole)
    return {
        "house": _normal(house_number(number)),
        "name": name,
        "type": F.coalesce(short_type(_normal(kind)), F.when(ends, short_type(last))),
        "unit": _normal(unit),
        "district": _normal(district),
        "community": _normal(community),
        "municipality": _normal(municipality),
        "postal": filled(F.upper(F.regexp_replace(postal, r"[\s-]+", ""))),
    }


def _grams(name: Column) -> Column:
    """Pairs of adjacent letters, start and end included; a repeated one is told apart by its number."""
    marked = F.concat(F.lit("^"), name, F.lit("$"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substring(marked, i, F.lit(2)))
    nth = lambda g, i: F.size(F.filter(F.slice(pairs, F.lit(1), i + 1), lambda x: x == g))
    return F.transform(pairs, lambda g, i: F.concat(g, nth(g, i).cast("string")))


def _edits(length: Column, minimum: int) -> Column:
    """How many edits a pair of names may differ by, the longer having this length."""
    return F.floor(length * (99 - minimum) / 100).cast("int")


def name_candidates(names: DataFrame, others: DataFrame, minimum: int = NAME_MINIMUM) -> DataFrame:
    """Pairs (``name``, ``their_name``) of different names that may score above ``minimum``, each once.

    An edit changes at most two grams, so names that are close enough share a certain number of them. If each name's
    grams are put in one order, from the rarest on, then two such names share one among the first few; only these are
    joined. Lengths and the number of all shared grams are compared before the edit distance is.
    """
    if minimum < 50:
        raise ValueError("name_minimum must be 50 or more")

    def grams(df: DataFrame, column: str) -> DataFrame:
        return df.select(F.col(column).alias("word"), F.explode(_grams(F.col(column))).alias("gram"))

    # at most as many rows as there are pairs of letters, with their numbers
    counts = stored(grams(others, "their_name").groupBy("gram").count().withColumnRenamed("count", "often"), "gram-counts")

    def first(df: DataFrame, column: str) -> DataFrame:
        held = lookup_join(grams(df, column), counts, ["gram"], probe=True)
        held = held.groupBy("word").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram"))).alias("g"))
        held = held.withColumn("grams", F.transform("g", lambda x: x["gram"]))
        least = 1 + F.ceil(F.length("word") * (2 * minimum - 98) / 100)
        size = F.greatest(F.size("grams") - least + 1, F.lit(1)).cast("int")
        return held.select("word", "grams", F.slice("grams", F.lit(1), size).alias("head"))

    ours = first(names, "name").toDF("name", "grams", "head").withColumn("gram", F.explode("head"))
    theirs = first(others, "their_name").toDF("their_name", "their_grams", "their_head")
    theirs = stored(theirs.withColumn("gram", F.explode("their_head")), "name-grams")
    met = salted_join(ours, theirs, on=["gram"], by=["name"], small=fits_broadcast(theirs))
    longer = F.greatest(F.length("name"), F.length("their_name"))
    edits = _edits(longer, minimum)
    close = F.abs(F.length("name") - F.length("their_name")) <= edits
    shared = F.size(F.array_intersect("grams", "their_grams")) >= longer + 1 - 2 * edits
    # a pair that shares several of the rare grams is taken at the first one
    once = F.col("gram") == F.element_at(F.array_intersect("head", "their_head"), 1)
    return met.where(close & once & shared & (F.col("name") != F.col("their_name"))).select("name", "their_name")


def similar_names(names: DataFrame, others: DataFrame, minimum: int = NAME_MINIMUM) -> DataFrame:
    """``name``, ``their_name`` and ``name_score`` above ``minimum``: 100 for equal names, else by edit distance."""
    longer = F.greatest(F.length("name"), F.length("their_name"))
    score = F.floor((longer - F.levenshtein("name", "their_name")) * 100 / longer).cast("int")
    near = name_candidates(names, others, minimum).withColumn("name_score", score).where(F.col("name_score") > minimum)
    same = names.join(others, F.col("name") == F.col("their_name")).withColumn("name_score", F.lit(100))
    return near.unionByName(same)


def weighted_score() -> Column:
    """The score of a candidate: the mean of the fields that the address has, by weight."""
    def agreement(field: str) -> Column:
        own, theirs = F.col(field), F.col(f"their_{field}")
        if field == "name":
            return F.col("name_score")
        part = F.lit(0)
        if field == "postal":
            # the first half of a postal code names the area
            part = F.when(F.substring(own, 1, 3) == F.substring(theirs, 1, 3), 50).otherwise(0)
        return F.when(own == theirs, 100).otherwise(part)

    given = lambda field, value: F.when(F.col(field).isNotNull(), value).otherwise(0)
    total = sum((given(f, F.lit(w)) for f, w in WEIGHTS.items()), F.lit(0))
    points = sum((given(f, agreement(f) * w) for f, w in WEIGHTS.items()), F.lit(0))
    return F.floor(points / total).cast("int")


def locate(addresses: DataFrame, civics: DataFrame, minimum: int = MINIMUM, name_minimum: int = NAME_MINIMUM) -> DataFrame:
    """The best civic for each different address with a house number and a street name, if it scores above ``minimum``.

    ``civics`` has the columns of ``ADDRESS`` and ``CIV_ID``, ``X``, ``Y``. An address without a field is not judged by it;
    a civic without a field that the address has does not agree in it. Of equal scores the lowest ``CIV_ID`` is taken.
    """
    wanted = stored(addresses.select(*ADDRESS).where("house IS NOT NULL AND name IS NOT NULL").distinct(), "addresses")
    known = civics.where("house IS NOT NULL AND name IS NOT NULL").groupBy(*ADDRESS).agg(F.min(F.struct("CIV_ID", "X", "Y")).alias("civic"))
    known = stored(known.select("house", *(F.col(c).alias(f"their_{c}") for c in ADDRESS[1:]), "civic"), "civics")
    names = stored(similar_names(wanted.select("name").distinct(), known.select("their_name").distinct(), name_minimum), "similar-names")
    rest = [c for c in ADDRESS if c != "name"]
    spelled = salted_join(wanted, names, on=["name"], by=rest, small=fits_broadcast(names))
    met = salted_join(spelled, known, on=["house", "their_name"], by=ADDRESS, small=fits_broadcast(known))
    scored = met.withColumn("score", weighted_score()).where(F.col("score") > minimum)
    best = F.max_by(F.struct("score", "civic"), F.struct("score", -F.col("civic.CIV_ID")))
    found = scored.groupBy(*ADDRESS).agg(best.alias("best"))
    return found.select(
        *ADDRESS, F.col("best.civic.CIV_ID").alias("match_id"), F.col("best.score").alias("score"), F.col("best.civic.X").alias("match_x"), F.col("best.civic.Y").alias("match_y")
    )


def geocode(permits: DataFrame, civics: DataFrame, minimum: int = MINIMUM, name_minimum: int = NAME_MINIMUM) -> DataFrame:
    """Permits with their match by all fields, null where there is none.

    ``permits`` has ``Civic_Number``, ``Street_Name``, ``Street_Type``, ``Unit``, ``District``, ``Community``, ``Municipality``
    and ``Postal``; ``civics`` has the fields of the civic address table.
    """
    own = address_fields(*(F.col(c) for c in ("Civic_Number", "Street_Name", "Street_Type", "Unit", "District", "Community", "Municipality", "Postal")))
    fields = ("FULL_CIVIC", "STR_NAME", "STR_TYPE", "UNIT_NUM", "DISTRICT", "GSA_NAME", "MUN_CODE", "CIV_POSTAL")
    theirs = civics.select("CIV_ID", "X", "Y", *(c.alias(f"_{n}") for n, c in address_fields(*map(F.col, fields)).items()))
    theirs = theirs.select("CIV_ID", "X", "Y", *(F.col(f"_{n}").alias(n) for n in ADDRESS))
    keyed = stored(permits.select(*permits.columns, *(c.alias(f"_{n}") for n, c in own.items())), "keyed-permits")
    found = stored(locate(keyed.select(*(F.col(f"_{n}").alias(n) for n in ADDRESS)), theirs, minimum, name_minimum), "located")
    found = found.select(*(F.col(n).alias(f"_{n}") for n in ADDRESS), "match_id", "score", "match_x", "match_y")
    keys = [f"_{n}" for n in ADDRESS]
    return lookup_join(keyed, found, keys, null_safe=True, probe=True).drop(*keys)
