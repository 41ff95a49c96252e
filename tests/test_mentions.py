"""Mentions and headline places: against a plain scan, and case by case."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import mentions, places

STATES = [("North Reach", "NR"), ("Eastmark", "EM"), ("Low Isles", "LI"), ("East Low Isles", "EL")]
PLACES = [("port sand", "NR", 900_000, "city"), ("millbrook", "EM", 300_000, "city"), ("millbrook", "LI", 200_000, "city"), ("oakham", "NR", 500_000, "city"), ("oakham", "LI", 90_000, "city"),
          ("ash", "EM", 4_000, "city"), ("rose", "LI", 800_000, "city"), ("sand", "LI", 200_000, "district"), ("reach", "EM", 150_000, "city"), ("twin", "EM", 5, "district"), ("twin", "LI", 500, "district")]
ALIASES = [("old port", "port sand")]


@pytest.fixture(scope="module")
def world(spark):
    states = spark.createDataFrame(STATES, "alias string, code string")
    gazetteer = spark.createDataFrame(PLACES, "name string, state string, population long, kind string")
    aliases = spark.createDataFrame(ALIASES, "alias string, name string")
    return states, gazetteer, aliases, mentions.names_table(states, gazetteer, aliases, ["west"], ["rose"])


def located(spark, world, rows):
    states, gazetteer, aliases, names = world
    t = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, headline string, feed string")
    found = mentions.mentions(t, ["id"], "headline", names, {"NR": "NR", "L&I": "LI"})
    look = lambda n: places.candidates(n, gazetteer, aliases, ["west"], ["city"])
    got = mentions.locate(t, ["id"], "headline", found, states, look, "feed", ["news", "rss", "cities"])
    return [(r["state"], r["place"], r["district"], r["basis"]) for r in got.orderBy("id").collect()]


def test_headlines(spark, world):
    none, http = (None, None, None, None), "https://h.example/rss/"
    cases = [
        ("Port Sand: trader robbed near Millbrook", None, ("NR", "Port Sand", None, "headline")),  # a dateline first
        ("Port Sand man held in Eastmark for fraud", None, ("EM", None, None, "headline")),  # where it happened
        ("Millbrook youth held in Low Isles", None, ("LI", None, None, "headline")),
        ("Fire at Millbrook, Low Isles minister visits", None, ("LI", "Millbrook", None, "headline")),  # a shared name by the state named
        ("Fire at Millbrook", None, none),  # a shared name with nothing to settle it
        ("Fire at Oakham", None, ("NR", "Oakham", None, "headline")),  # by size
        ("Rose Miller murder case", None, none), ("Two die in Rose", None, ("LI", "Rose", None, "headline")),  # a given name
        ("Ash falls on coast", None, none), ("Ash: one held", None, ("EM", "Ash", None, "headline")),  # a tiny town
        ("Raid in Sand", None, ("LI", "Sand", "Sand", "headline")), ("Old Port market shut", None, ("NR", "Old Port", None, "headline")),
        ("Raid in Twin", None, none), ("NR to vote", None, ("NR", None, None, "headline")), ("NR2 to vote, L & I not", None, ("LI", None, None, "headline")),
        ("FIRE AT PORT SAND", None, ("NR", "PORT SAND", None, "headline")), ("fire at port sand", None, ("NR", "port sand", None, "headline")), ("Fire at port sand", None, none),
        ("Senior citizen cheated", http + "cities/oakham-news/x.xml", ("NR", None, None, "feed")), ("Senior citizen cheated", http + "news/low-isles/", ("LI", None, None, "feed")),
        ("Senior citizen cheated", http + "east-low-isles", ("EL", None, None, "feed")), ("Senior citizen cheated", http + "news/millbrook", none), ("", http, none), (None, None, none), ("West wins", None, none)]
    assert located(spark, world, [c[:2] for c in cases]) == [c[2] for c in cases]


def by_scan(text, names, longest=4):
    import re

    toks = [(m.start(), m.end(), m.group()) for m in re.finditer("[A-Za-z]+", text or "")]
    loose = bool(text) and (text == text.lower() or text == text.upper())
    out, i = [], 0
    while i < len(toks):
        for n in range(min(longest, len(toks) - i), 0, -1):
            own = toks[i : i + n]
            name = " ".join(x[2].lower() for x in own)
            if name in names and (loose or all(x[2][0].isupper() for x in own)):
                out.append((own[0][0], own[-1][1], text[own[0][0] : own[-1][1]]))
                i += n
                break
        else:
            i += 1
    return out


def test_mentions_against_a_scan(spark):
    """Overlapping names of one to four words, texts of any case, breaks and letters beyond ASCII, empty and null ones."""
    rnd = random.Random(3)
    words = list("abcdef")
    names = {" ".join(rnd.choices(words, k=rnd.choice([1, 2, 2, 3, 4]))) for _ in range(60)}
    texts = ["".join(rnd.choice([w, w.upper(), w.upper()]) + rnd.choice([" ", " ", ", ", " é\n", "  7 "]) for w in rnd.choices(words, k=rnd.choice([0, 1, 30, 200]))) for _ in range(40)] + ["a b c d e f " * 50, "A B C", None, "", "123"]
    table = spark.createDataFrame([(n, "place", None, False) for n in sorted(names)], "name string, kind string, state string, weak boolean")
    t = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in mentions.mentions(t, ["id"], "text", table).collect():
        got.setdefault(r["id"], []).append((r["start"], r["end"], r["mention"]))
    assert {k: sorted(v) for k, v in got.items()} == {i: m for i, x in enumerate(texts) if (m := by_scan(x, names))}
    assert mentions.mentions(t.filter("id < 0"), ["id"], "text", table).count() == 0
    assert mentions.mentions(t, ["id"], "text", table.filter(F.lit(False))).count() == 0


def test_words_are_not_shuffled(spark, sf):
    """Texts are dealt by their keys once; all windows over words work where these lie."""
    from factloom.plans import catalogue

    plan = catalogue.QUERIES["name_mentions"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(src") == 1 and plan.index("Generate posexplode") < plan.index("Exchange hashpartitioning(src")


def test_few_names_and_many_give_the_same(spark):
    """Names in every task against the join; long runs of letters, letters of several bytes, a key with the name of a helper column."""
    rnd = random.Random(4)
    words = ["a", "ab", "b", "z" * 30]
    names = sorted({" ".join(rnd.choices(words, k=rnd.choice([1, 2, 3, 4]))) for _ in range(40)} | {"st. john", "Ab", "a  b", "é"})
    texts = ["".join(rnd.choice([w, w.upper(), w.title()]) + rnd.choice([" ", "é", "€ ", ", ", "\U0001f600", "_"]) for w in rnd.choices([*words, "z" * 31, "q" * 3000], k=rnd.choice([0, 1, 9, 60]))) for _ in range(60)] + [None, "", "é", "A" * 100_000]
    table = spark.createDataFrame([(n, "state" if len(n) % 2 else "place", n[:1] if len(n) % 2 else None, len(n) < 3) for n in names], "name string, kind string, state string, weak boolean")
    t = spark.createDataFrame([(k, -k, x) for k, x in enumerate(texts)], "found long, id long, text string")
    few, many = (sorted(map(tuple, mentions.mentions(t, ["found", "id"], "text", table, held=held).collect()), key=str) for held in (100, 0))
    assert few == many and len(few) > 100


def test_few_names_need_no_windows(spark, sf):
    """Texts are scanned whole: words never become rows that windows sort."""
    from factloom.plans import catalogue

    plan = catalogue.QUERIES["name_mentions"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "MapInArrow" in plan
