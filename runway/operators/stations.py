"""Assigning weather stations to airports.

For each airport at the other end of a leg the reference picks stations by one
of three rules, in order of precedence:

1. ``hub``  - the airport is a hub: the station NAME contains the hub's station name;
2. ``city`` - no station has the call sign ``'K' + code``: NAME contains the cleaned city;
3. ``call`` - otherwise: CALL_SIGN contains ``'K' + code``.

The reference runs one filter per airport.  Here the rules become one table
(airport, field, needle) and the ``contains`` tests become one equi-join over
short substrings, verified afterwards.  That is exact ``contains`` semantics
without a nested-loop join, and it runs on distinct stations, never on the reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runway.functions.text import call_sign, city_key

GRAM = 3     # characters of an indexed substring


def hub_table(spark: SparkSession, hubs: dict[str, str]) -> DataFrame:
    """The fixed hub -> station-name table as a DataFrame."""
    return spark.createDataFrame(sorted(hubs.items()), "code string, hub_name string")


def city_lookup(legs: DataFrame) -> DataFrame:
    """Airport code -> city (first comma part of the city name), over both ends.

    A code seen with several cities keeps the smallest, so the result is
    deterministic (the reference's dictionary kept an arbitrary one).
    """
    return (both_ends(legs, ("ORIGIN", "ORIGIN_CITY"), ("DEST", "DEST_CITY"), ("code", "city"))
            .groupBy("code").agg(F.min("city").alias("city")))


def both_ends(legs: DataFrame, first: tuple, second: tuple, names: tuple) -> DataFrame:
    """One row per leg end, read in a single pass (a union would scan the legs twice).

    ``first`` and ``second`` are column-name tuples (or Columns) giving each end's
    values, ``names`` the output column names.
    """
    def end(cols):
        return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(cols, names)])

    return legs.select(F.explode(F.array(end(first), end(second))).alias("_end")).select("_end.*")


def call_sign_set(stations: DataFrame) -> DataFrame:
    """Distinct call signs of the station list, trimmed."""
    return (stations.select(F.trim(F.col("CALL_SIGN")).alias("call_sign"))
                    .where(F.col("call_sign").isNotNull()).distinct())


def missing_call_signs(codes: DataFrame, stations: DataFrame) -> DataFrame:
    """Codes whose ``'K' + code`` is not a call sign of any station (set difference)."""
    wanted = codes.select("code", call_sign("code").alias("call_sign")).distinct()
    return wanted.join(call_sign_set(stations), "call_sign", "left_anti")


def airport_rules(codes: DataFrame, stations: DataFrame, hubs: DataFrame) -> DataFrame:
    """One row per airport: which rule applies, the field it tests, the needle.

    ``codes`` has (code, city).  A NULL needle (e.g. no city known) matches nothing.
    """
    missing = missing_call_signs(codes.select("code"), stations).select(
        "code", F.lit(True).alias("_missing"))
    base = (codes.join(hubs, "code", "left")
                 .join(missing, "code", "left"))
    is_hub = F.col("hub_name").isNotNull()
    is_missing = F.col("_missing").isNotNull()
    rule = F.when(is_hub, "hub").when(is_missing, "city").otherwise("call")
    field = F.when(is_hub | is_missing, "NAME").otherwise("CALL_SIGN")
    needle = (F.when(is_hub, F.col("hub_name"))
               .when(is_missing, city_key("city"))
               .otherwise(call_sign("code")))
    return base.select("code", rule.alias("rule"), field.alias("field"), needle.alias("needle"))


def grams(text: Column, q: int) -> Column:
    """The distinct substrings of ``q`` characters of a text: no more than it has characters (NULL or shorter: none)."""
    starts = F.sequence(F.lit(1), F.length(text) - (q - 1))
    cut = F.array_distinct(F.transform(starts, lambda at: F.substr(text, at, F.lit(q))))
    return F.coalesce(F.when(F.length(text) >= q, cut), F.array().cast("array<string>"))


def match_stations(stations: DataFrame, rules: DataFrame) -> DataFrame:
    """(NAME, CALL_SIGN, code) for every station an airport's rule selects.

    ``stations`` holds distinct (NAME, CALL_SIGN).  A station can serve several
    airports and an airport several stations, as with the reference's filters.
    A NULL needle selects nothing; an empty one every station whose field is not NULL.

    An inverted index of the needles: each stands under one of its ``GRAM``-character
    substrings, the one that the fewest needles have, a shorter needle under all
    of itself.  A station is looked up by the substrings of its NAME and of its CALL_SIGN,
    at most as many per size as the text has characters, and each needle found is
    verified against the text.  ``rules`` is read twice: pass a written table.
    """
    needles = rules.where(F.col("needle").isNotNull()).select("code", "field", "needle")
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("NAME", "CALL_SIGN")])
    texts = stations.select("NAME", "CALL_SIGN", F.inline(fields)).where(F.col("text").isNotNull())
    sizes = [F.when(F.lit(q) <= F.length("text"), grams(F.col("text"), q)).otherwise(F.array().cast("array<string>")) for q in range(1, GRAM + 1)]
    # a size below GRAM is looked up only if a needle is as short
    short = needles.where(F.length("needle") < GRAM).agg(*[F.count_if(F.length("needle") == q).alias(f"n{q}") for q in range(GRAM)]).first()
    used = [sizes[q - 1] for q in range(1, GRAM + 1) if q == GRAM or short[f"n{q}"]]
    probes = texts.select("NAME", "CALL_SIGN", "field", "text", F.explode(F.concat(*used)).alias("gram"))
    keys = needles.select("code", "field", "needle", F.explode(
        F.when(F.length("needle") < GRAM, F.array("needle")).otherwise(grams(F.col("needle"), GRAM))).alias("gram"))
    shared = keys.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("field", "gram")))
    index = shared.groupBy("code", "field", "needle").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    hits = probes.join(index, ["field", "gram"]).where(F.col("text").contains(F.col("needle"))).select("NAME", "CALL_SIGN", "code")
    if short["n0"]:
        anything = needles.where(F.col("needle") == "").select("code", "field")
        hits = hits.unionByName(texts.join(anything, "field").select("NAME", "CALL_SIGN", "code"))
    return hits.distinct()
