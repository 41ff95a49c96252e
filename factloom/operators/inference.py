"""States of places whose table printed none: by evidence of their sheet, then by the blocks that totals close."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import normal_name
from factloom.operators import mentions, places
from factloom.operators.names import unused
from factloom.operators.order import blocks_closed_by, run_id
from factloom.operators.quality import block_check, null_safe
from factloom.session import written

SHEET, TABLE = ["file", "sheet"], ["file", "sheet", "table_title"]


def infer_states(facts: DataFrame, order: str, states: DataFrame, candidates, successors: list[tuple[str, int, str]], min_votes: int = 5, top_share: float = 0.8) -> DataFrame:
    """``facts`` with parent_state_code, a city's state_code and state_inferred filled in where the evidence suffices.

    Facts have file, sheet, table_title, entity_type, entity, state_code, parent_state_code, is_total and year; ``order`` is
    their place in the source. Votes of a sheet: each distinct place that it has placed (1), each state that the sheet's name
    and its first table title name (3 a mention), each unplaced name that is a state's or exists in one state only (1). An
    unplaced entity is the state that it names, else the state that ``candidates`` (names to name, state, population, kind)
    and the votes give. ``successors`` as in ``places.state_of``. Null files and sheets are keys like others; totals,
    other types and rows without entity stay as they are; the columns of ``facts`` keep their names and order.
    """
    def named(df, col, out):
        (k,) = unused(df.columns, "own_name")
        s = states.groupBy(normal_name(F.col("alias")).alias(k)).agg(F.min("code").alias(out))
        return df.withColumn(k, normal_name(F.col(col))).join(s, k, "left").drop(k)

    place = F.col("entity_type").isin("city", "district") & ~F.coalesce("is_total", F.lit(False)) & F.col("entity").isNotNull()
    need = place & F.col("parent_state_code").isNull()
    asked = facts.filter(need)
    each = named(asked.select(*SHEET, "entity", "entity_type").distinct(), "entity", "own_state")
    found = places.gathered(candidates(each.select(F.col("entity").alias("name")).distinct())).withColumnRenamed("name", "entity")
    each = each.join(found, "entity", "left")

    placed = facts.filter(place & F.col("parent_state_code").isNotNull()).select(*SHEET, "entity", F.col("parent_state_code").alias("vote")).distinct().select(*SHEET, "vote", F.lit(1).alias("n"))
    title = asked.groupBy(*SHEET).agg(F.min_by("table_title", order).alias("t")).select(*SHEET, F.lower(F.concat_ws(" ", "sheet", "t")).alias("t"))
    names = states.groupBy(normal_name(F.col("alias")).alias("name")).agg(F.min("code").alias("state")).select("name", F.lit("state").alias("kind"), "state", F.lit(False).alias("weak"))
    titles = mentions.mentions(title, SHEET, "t", names).select(*SHEET, F.col("state").alias("vote"), F.lit(3).alias("n"))
    single = each.withColumn("vote", F.coalesce("own_state", F.when(F.size("c") == 1, F.get("c", F.lit(0))["s"]))).filter("vote is not null").select(*SHEET, "vote", F.lit(1).alias("n"))
    votes = placed.unionByName(titles).unionByName(single).groupBy(*SHEET, "vote").agg(F.sum("n").alias("n"))
    votes = votes.groupBy(*SHEET).agg(F.min(F.struct((-F.col("n")).alias("n"), "vote")).alias("top"), F.sum("n").alias("votes"))

    each = null_safe(each, votes, SHEET)
    strong = F.when((F.col("votes") >= min_votes) & (-F.col("top.n") >= top_share * F.col("votes")), F.col("top.vote"))
    new, = unused(facts.columns, "new_state")
    each = each.select(*SHEET, "entity", "entity_type", F.coalesce("own_state", places.pick(strong, F.col("entity_type") == "city")).alias(new))
    out = null_safe(facts, each, [*SHEET, "entity", "entity_type"])
    state = F.when(need, F.col(new))
    for code, since, old in successors:
        state = F.when((state == code) & (F.col("year") < since), F.lit(old)).otherwise(state)
    out = out.withColumn(new, state)
    change = {"parent_state_code": F.coalesce("parent_state_code", new), "state_code": F.when((F.col("entity_type") == "city") & F.col("state_code").isNull(), F.col(new)).otherwise(F.col("state_code"))}
    return out.select(*[change.get(c, F.col(c)).alias(c) for c in facts.columns if c != "state_inferred"], F.col(new).isNotNull().alias("state_inferred"))


def district_rows(facts: DataFrame, name: str = "in_blocks") -> DataFrame:
    """``facts`` with a flag: rows of tables that have districts, these and states that are no totals (a state of one district)."""
    has, = unused(facts.columns, "has_districts")
    t = facts.groupBy(*TABLE).agg(F.bool_or(F.col("entity_type") == "district").alias(has))
    own = (F.col("entity_type") == "district") | ((F.col("entity_type") == "state") & ~F.coalesce("is_total", F.lit(False)))
    return null_safe(facts, t, TABLE).withColumn(name, F.coalesce(F.col(has) & own, F.lit(False))).drop(has)


def by_elimination(blocks: DataFrame, keys: list[str], block: str, code: str, sequence: DataFrame, allowed: Column) -> DataFrame:
    """``blocks`` with ``code`` filled where only one reading is left.

    Blocks of a key stand in the order of ``sequence`` (code, place), a closed list. A run of unknown blocks between two known
    ones, or the key's ends, takes the codes between these if exactly as many of them are used by no block of the
    key. Known neighbours that are not in the sequence, and keys whose first block is not ``allowed``, fill nothing.
    """
    known, a, z, gap, n, k, ok = unused([*blocks.columns, "place"], "known", "a", "z", "gap", "gap_size", "gap_place", "ok")
    w = Window.partitionBy(*keys).orderBy(block)
    b = blocks.join(F.broadcast(sequence.select(F.col("code").alias(code), F.col("place").alias(known))), code, "left").withColumn(known, F.when(F.col(code).isNotNull(), F.struct(F.col(known).alias("p"))))
    b = b.withColumn(a, F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn(z, F.first(known, True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    b = b.withColumn(gap, F.count(known).over(w)).withColumn(ok, F.first(F.coalesce(allowed, F.lit(False))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    unknown = F.col(known).isNull() & F.col(ok) & (F.col(a).isNull() | F.col(f"{a}.p").isNotNull()) & (F.col(z).isNull() | F.col(f"{z}.p").isNotNull())
    u = b.filter(unknown).withColumn(k, F.row_number().over(Window.partitionBy(*keys, gap).orderBy(block)))
    gaps = u.groupBy(*keys, gap).agg(F.first(f"{a}.p").alias(a), F.first(f"{z}.p").alias(z), F.count(F.lit(1)).alias(n))
    s = sequence.select(F.col("code").alias(ok), F.col("place").alias(known))
    free = gaps.join(F.broadcast(s), (F.col(a).isNull() | (F.col(known) > F.col(a))) & (F.col(z).isNull() | (F.col(known) < F.col(z))))
    used = blocks.filter(F.col(code).isNotNull()).select(*keys, F.col(code).alias(ok), F.lit(True).alias(k)).distinct()
    free = null_safe(free, used, [*keys, ok]).filter(F.col(k).isNull()).drop(k)
    g = Window.partitionBy(*keys, gap)
    free = free.withColumn(k, F.row_number().over(g.orderBy(known))).withColumn(a, F.count(F.lit(1)).over(g)).filter(F.col(a) == F.col(n)).select(*keys, gap, k, F.col(ok).alias(z))
    filled = null_safe(u.select(*keys, block, gap, k), free, [*keys, gap, k]).select(*keys, block, z)
    return null_safe(blocks, filled, [*keys, block]).withColumn(code, F.coalesce(F.col(code), F.col(z))).select(*blocks.columns)


def settle_blocks(facts: DataFrame, order: str, sequence: DataFrame, since: int, until: int, share: float = 0.8, least: int = 2, majority: int = 4) -> DataFrame:
    """``facts`` (with state_inferred) after their tables' blocks are settled; a block ends with a total and is one state.

    Neighbouring rows of one entity are one source row. A block takes the state of ``share`` of its placed source rows, if
    these are ``least`` or the block has a single row; blocks that no place tells apart are filled by elimination in
    tables of the years from ``since`` to before ``until``. Rows without a state, totals too, take their block's; inferred ones
    give way to ``majority`` rows; printed ones stay. Rows outside of ``district_rows`` stay. Rows, source rows and blocks
    are written to the shared folder once, as each is read several times.
    """
    own, run, block, cols = *unused(facts.columns, "in_blocks", "run", "block"), facts.columns
    d = written(run_id(district_rows(facts, own), [*TABLE, own], [order], "entity", run), "block-rows")
    at = lambda c: F.min_by(c, order).alias(c)
    r = d.filter(own).groupBy(*TABLE, run).agg(F.max("parent_state_code").alias("code"), at("is_total"), at("state_inferred"), at("year"))
    r = written(blocks_closed_by(r.withColumn("is_total", F.coalesce("is_total", F.lit(False))), TABLE, [run], F.col("is_total"), block), "block-runs")
    b = r.groupBy(*TABLE, block).agg(F.count(F.when(~F.col("is_total"), 1)).alias("rows"), F.min_by("year", run).alias("year"))
    n = r.filter("not is_total and code is not null").groupBy(*TABLE, block, "code").agg(F.count(F.lit(1)).alias("n"))
    n = n.groupBy(*TABLE, block).agg(F.min(F.struct((-F.col("n")).alias("n"), "code")).alias("top"), F.sum("n").alias("placed"))
    won = -F.col("top.n")
    b = null_safe(b, n, [*TABLE, block])
    ok = (won >= share * F.col("placed")) & ((won >= least) | (F.col("rows") == 1))
    b = written(b.select(*TABLE, block, "year", F.when(ok, F.col("top.code")).alias("block_code"), F.when(ok, won).otherwise(0).alias("block_rows")), "blocks")
    b = by_elimination(b, TABLE, block, "block_code", sequence, (F.col("year") >= since) & (F.col("year") < until)).drop("year")
    r = null_safe(r, b, [*TABLE, block])
    gives = F.coalesce("state_inferred", F.lit(False)) & (F.col("block_rows") >= majority)
    takes = F.col("block_code").isNotNull() & (F.col("code").isNull() | (gives & (F.col("code") != F.col("block_code"))))
    r = r.select(*TABLE, run, F.lit(True).alias(own), F.when(takes, F.col("block_code")).alias(block))
    change = {"parent_state_code": F.coalesce(block, "parent_state_code"), "state_inferred": F.coalesce("state_inferred", F.lit(False)) | F.col(block).isNotNull()}
    return null_safe(d, r, [*TABLE, own, run]).select(*[change.get(c, F.col(c)).alias(c) for c in cols])


def check_blocks(facts: DataFrame, keys: list[str], value: str, skip: Column, qc: str = "qc") -> DataFrame:
    """The status of rows in blocks replaces that of ``qc``: places of a state against the one total of their block.

    Rows of blocks without a state, and those that ``skip`` (a rate), are unchecked; rows outside of blocks keep ``qc``.
    """
    own, status = unused(facts.columns, "in_blocks", "block_status")
    d = district_rows(facts, own)
    counts = F.col(own) & F.col("parent_state_code").isNotNull() & ~F.coalesce(skip, F.lit(False))
    total = F.coalesce("is_total", F.lit(False))
    d = block_check(d, [*keys, "parent_state_code"], value, counts & total, counts & ~total, name=status)
    return d.withColumn(qc, F.when(~F.col(own), F.col(qc)).when(counts, F.col(status)).otherwise("unchecked")).drop(own, status)
