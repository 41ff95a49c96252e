"""Places: candidates of a written name, and the one state that the evidence supports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import normal_name


def candidates(names: DataFrame, gazetteer: DataFrame, aliases: DataFrame, generic: list[str], qualifiers: list[str]) -> DataFrame:
    """(name, state, population, kind) for each distinct name of ``names`` (name).

    The normalised name loses trailing qualifiers (but for its last word), goes through the aliases (alias, name) and is
    looked up in the gazetteer (name, state, population, kind); a generic word is no place. A name that is not there is
    cut at - / , & and "and": its halves count if every one that is known has one state, and all the same one.
    """
    ends = "|".join(qualifiers)

    def keyed(c):
        return F.regexp_extract(normal_name(c), rf"^(.+?)(?: (?:{ends}))*$", 1)

    def looked_up(t):  # t: name, part, at
        t = t.withColumn("key", keyed(F.col("part"))).join(aliases.select(F.col("alias").alias("key"), F.col("name").alias("known_as")), "key", "left")
        t = t.withColumn("key", F.coalesce("known_as", "key")).filter(~F.col("key").isin(generic))
        return t.join(gazetteer.withColumnRenamed("name", "key"), "key").select("name", "at", "state", "population", "kind")

    names = names.select("name").filter("name is not null").distinct()
    whole = looked_up(names.select("name", F.col("name").alias("part"), F.lit(-1).alias("at")))
    generic_names = names.filter(keyed(F.col("name")).isin(generic)).select("name")
    left = names.join(whole.select("name").distinct(), "name", "left_anti").join(generic_names, "name", "left_anti")
    halves = looked_up(left.select("name", F.posexplode(F.split("name", r"(?i)\s*(?:-|/|,|&|\band\b)\s*")).alias("at", "part")).filter(F.trim("part") != ""))
    one = halves.groupBy("name").agg(F.countDistinct("state").alias("states"), F.min("at").alias("first")).filter("states = 1")
    agreed = halves.join(one, "name").filter("at = first")
    return whole.unionByName(agreed.select(whole.columns)).select("name", "state", "population", "kind")


def gathered(found: DataFrame) -> DataFrame:
    """(name, c, districts) of candidates (name, state, population, kind): c holds a name's states, the biggest first; a name has few."""
    one = F.struct((-F.col("population")).alias("p"), F.col("state").alias("s"), "kind")
    return found.groupBy("name").agg(F.array_sort(F.collect_list(one)).alias("c"), F.count(F.when(F.col("kind") == "district", 1)).alias("districts"))


def pick(strong: Column, metro: Column, veto: bool = True, factor: float = 3.0) -> Column:
    """The state of a row with the columns of ``gathered``; ``strong`` is the state that the evidence names, if it is strong."""
    first, second = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    one = F.when(strong.isNull() | F.lit(not veto) | (strong == first["s"]), first["s"])
    big = F.when((metro | (F.col("districts") <= 1)) & (-first["p"] >= factor * F.greatest(-second["p"], F.lit(1))), first["s"])
    several = F.when(F.exists("c", lambda x: x["s"] == strong), strong).otherwise(big)
    return F.when(F.size("c") == 1, one).when(F.size("c") > 1, several)


def state_of(names: DataFrame, found: DataFrame, votes: DataFrame, min_votes: int = 5, top_share: float = 0.8, factor: float = 3.0, veto: bool = True, successors: list[tuple[str, int, str]] | None = None) -> DataFrame:
    """One state for each row of ``names`` (name, year, metro).

    ``found``: (name, state, population, kind); ``votes``: (name, state, n). Evidence is strong with ``min_votes`` votes
    of which ``top_share`` agree. One candidate stays unless, with ``veto``, strong evidence names another. Of several
    the strong top wins if it is among them, else the biggest with ``factor`` times the next one's population, but for
    names of two or more districts, whose size says nothing unless the row is of a table of metropolitan places.
    ``successors``: (state, first year, the state it was part of before).
    """
    v = votes.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("state").alias("s"))).alias("t"), F.sum("n").alias("votes"))
    t = names.join(gathered(found), "name", "left").join(v, "name", "left")
    strong = F.when((F.col("votes") >= min_votes) & (-F.col("t.n") >= top_share * F.col("votes")), F.col("t.s"))
    state = pick(strong, F.coalesce("metro", F.lit(False)), veto, factor)
    for new, since, old in successors or []:
        state = F.when((state == new) & (F.col("year") < since), F.lit(old)).otherwise(state)
    return t.select(*names.columns, state.alias("state"))
