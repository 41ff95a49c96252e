"""What a table counts: family and head of its figures, from titles and labels; panels of checked figures by these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import text
from factloom.functions.classify import first_match
from factloom.operators.names import unused
from factloom.operators.panels import collapse

# Families, title rules and label words of the published tables, and the measures that panels keep.
FAMILIES = [("women", r"against women"), ("children", r"against children|crimes? by children"), ("scheduled_castes", r"scheduled castes?|against scs|\bscs\b"),
            ("scheduled_tribes", r"scheduled tribes?|against sts|\bsts\b"), ("senior_citizens", r"senior citizen"), ("juveniles", r"juvenile"),
            ("cyber", r"cyber|\bit act|i t act"), ("sll", r"\bsll\b"), ("ipc", r"\bipc\b")]
FAMILY_TOTALS = {"ipc": "Total Cognizable IPC Crimes", "sll": "Total Cognizable SLL Crimes", "women": "Total Crimes against Women", "children": "Total Crimes against Children",
                 "scheduled_castes": "Total Crimes against Scheduled Castes", "scheduled_tribes": "Total Crimes against Scheduled Tribes", "senior_citizens": "Total Crimes against Senior Citizens",
                 "cyber": "Total Cyber Crimes", "juveniles": "Total Crimes by Juveniles"}
HEADWISE = r"head-?wise|various crime|various crimes|cases registered (under|for)|cases reported ?\(cr\)|\(cr\)"
DISTRICTWISE = r"^district-?wise"
FAMILY_TITLE = r"\b(?:ipc|sll|cyber) crimes?\b|crimes? (?:committed )?against|atrocities"
NOT_HEADWISE = r"disposal|trial|custod|duration|by place of occ|property stolen|motive|firing|human rights|police personnel|age.?group|by sex|sex-?wise|gender|profile|metropolitan|city-wise|\bgrp\b|cr\.?p\.?c"
BOTH = r"\bipc\b.*\bsll\b|\bsll\b.*\bipc\b"
ACT = r"(?i)\bacts?\b|\bsll\b"
SUMMARY = r"(?i)state.?/?ut.?wise"
TITLE_HEAD = r"(?i)\bunder (.+?),? *(?:during|in india)\b"
OF_PLACE = r"\b(?:in|of) (?:(?:ut|state) of )?([a-z&. ]+?) (?:during|from)\b"
MEASURES = ["cr", "ccs", "cs", "cv", "con", "par", "part", "pcs", "pcst", "pcv", "pcvt", "pcr", "caq", "cncfr", "chr", "csr", "cvr", "i", "v", "r", "sl", "value"]
PARTS = r"(?i)^(?:fe)?male$|transgender|\d\s*(?:years?|yrs)\b|\byrs?\b|\byears\b|^(?:above|below|between)\b|^total (?:fe)?male|^(?:total|grand total)$|^a60|^b\d\d|^gtot|^tot[fm]$|persons|^cases "
BANNER = r"(?i)head-?wise|ut-wise|city-wise|state/ut|^table\b|\(continued\)|\(concluded\)"
FAMILY_LABEL = r"(?i)^(ipc|sll) crimes( against .*)?$"
SOURCE_LABEL = r"(?i)^(source|states?)\s*:"
KEEP = ["cases_registered", "cases_chargesheeted", "cases_convicted", "persons_arrested", "persons_chargesheeted", "persons_convicted", "victims"]
KEEP_NATIONAL = [*KEEP, "rate", "percentage"]
HEAD_NOISE = r"\(.*?\)|sec\.?\s*[\d\w\- ,&]+(ipc)?|[,.:;]| act$|, ?\d{4}"
SYNONYMS = {
    "thefts": "theft", "other ipc crime": "other ipc crimes", "total ipc crimes": "total cognizable ipc crimes", "total sll crimes": "total cognizable sll crimes",
    "cruelty by husband or relatives": "cruelty by husband or his relatives", "importation of girls": "importation of girls from foreign country",
    "ch not amounting murder": "culpable homicide not amounting to murder", "making preparation and assembly for committing dacoity": "preparation & assembly for dacoity",
    "molestation": "assault on women with intent to outrage her modesty", "sexual harrassment": "insult to the modesty of women", "insult to modesty of women": "insult to the modesty of women",
    "kidnapping and abduction": "kidnapping & abduction", "kidnapping & abduction total": "kidnapping & abduction"}
# End of the fixed values.


def family(title: Column) -> Column:
    """The family that a title names; '' for none."""
    return first_match(title, FAMILIES, "")


def scope(title: Column) -> Column:
    """The family of a table of heads ('' if it names none); null for other tables. Titles are lower-case keys."""
    heads = title.rlike(HEADWISE) | (title.rlike(DISTRICTWISE) & ~title.contains("missing")) | title.rlike(FAMILY_TITLE)
    return F.when(heads & ~title.rlike(NOT_HEADWISE), family(title))


def segments(label: Column) -> Column:
    """The levels of a column's label that say what is counted: years, measures, banners and sources are left out."""
    says = lambda s: (s != "") & ~s.rlike("^(19|20)[0-9]{2}$") & ~F.lower(s).isin(MEASURES) & ~s.rlike(SOURCE_LABEL) & ~s.rlike(BANNER) & ~s.rlike(FAMILY_LABEL)
    return F.filter(F.transform(F.split(label, r" \| "), F.trim), says)


def head(label: Column) -> Column:
    """What a column counts; null where nothing says it or a level splits by sex or age."""
    s = segments(label)
    return F.when((F.size(s) > 0) & ~F.exists(s, lambda x: x.rlike(PARTS)), F.array_join(s, " | "))


def title_head(title: Column) -> Column:
    """What a table counts by its title, '... under X during ...': the last X."""
    h = F.get(F.reverse(F.regexp_extract_all(title, F.lit(TITLE_HEAD), 1)), F.lit(0))
    h = F.regexp_replace(F.btrim(h, F.lit(" *,")), r"(?i) for crimes? (?:against|committed against) \w+$", "")
    h = F.regexp_replace(F.regexp_replace(text.clean(h), r"(?i)\bipc\b", "IPC"), r"(?i)\bsll\b", "SLL")
    return F.when(h != "", F.concat(F.upper(F.substring(h, 1, 1)), h.substr(F.lit(2), F.length(h))))


def head_key(h: Column) -> Column:
    """A head under one name, however editions print it: '(total)' stays, other brackets, sections and stops go."""
    k = F.regexp_replace(F.regexp_replace(F.lower(h), r"\(\s*total\s*\)", " total "), HEAD_NOISE, "")
    k = F.trim(F.regexp_replace(k, r"\s+", " "))
    names = F.create_map(*[F.lit(x) for kv in SYNONYMS.items() for x in kv])
    return F.coalesce(F.try_element_at(names, k), k)


def with_scopes(df: DataFrame) -> DataFrame:
    """``df`` (title_key, table_title, column_label, head) with ``scope``; rows that no family or head is found for go.

    The scope is the title's. Where a title names two families, the head tells which: acts belong to the special laws.
    A label of only a year and a measure says no head: then the title does ('under X during'), with its family or that of
    the head, or, in summaries by state, the family's total. Null titles and labels have neither.
    """
    title, label, h = F.col("title_key"), F.col("column_label"), F.col("head")
    by_head = lambda x: F.when(x.rlike(ACT), "sll").otherwise("ipc")
    bare, said, own = unused([*df.columns, "scope"], "bare", "said", "own_family")
    year = label.rlike("(^|[^0-9])(19|20)[0-9]{2}([^0-9]|$)")
    df = df.withColumn(bare, F.coalesce(h.isNull() & year & (F.size(segments(label)) == 0) & ~title.rlike(NOT_HEADWISE), F.lit(False)))
    df = df.withColumn(said, F.when(F.col(bare), title_head(F.col("table_title")))).withColumn(own, family(title))
    total = F.col(bare) & F.col(said).isNull() & title.rlike(SUMMARY) & ~title.rlike(BOTH) & ~title.rlike("head-?wise")
    by_title = F.when(F.col(own) != "", F.col(own)).otherwise(by_head(F.col(said)))
    first = F.when(scope(title).isin("ipc", "sll") & title.rlike(BOTH), by_head(h)).otherwise(scope(title))
    totals = F.create_map(*[F.lit(x) for kv in FAMILY_TOTALS.items() for x in kv])
    df = df.withColumn("scope", F.when(F.col(said).isNotNull(), by_title).when(total, F.col(own)).when(~F.col(bare), first))
    df = df.withColumn("head", F.when(F.col(said).isNotNull(), F.col(said)).when(total, F.try_element_at(totals, F.col(own))).otherwise(h))
    return df.filter((F.col("scope") != "") & F.col("head").isNotNull()).drop(bare, said, own)


def _settled(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """One row per key, by votes."""
    df = with_scopes(df).withColumn("head_key", head_key(F.col("head")))
    out = collapse(df, [*by, "year", "scope", "head_key", "metric"], "value", "priority", "capture", order, F.col("qc") == "sum_ok")
    return out.withColumn("head", text.clean(F.col("head")))


def state_panel(facts: DataFrame, order: str) -> DataFrame:
    """One row per state, year, family, head and measure of figures that add up.

    Rows of states in tables that add up to the whole (source ``state_table``), and states' own totals over their districts
    (``district_total``, which gives way on a tie). Two rows of one state in a table (a state printed in parts) are added
    up. ``order`` is a column that no two facts share. Facts: file, sheet, table_title, title_key, column_label, entity_type, entity, state_code,
    parent_state_code, is_total, year, metric, qc, value, capture. Null totals count as false; rows without year, state or value go.
    """
    ok = facts.filter(F.col("year").isNotNull() & F.col("metric").isin(KEEP)).withColumn("is_total", F.coalesce("is_total", F.lit(False)))
    a = ok.filter((F.col("qc") == "sum_ok") & (F.col("entity_type") == "state") & F.col("state_code").isNotNull() & ~F.col("is_total"))
    key = ["file", "sheet", "table_title", "column_label", "state_code", "year", "metric"]
    rest = [c for c in a.columns if c not in (*key, "value")]
    a = a.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("row"), F.sum("value").alias("value")).select(*key, "row.*", "value").withColumn("source", F.lit("state_table")).withColumn("priority", F.lit(0))
    whole = ((F.col("entity_type") == "district") & F.col("is_total")) | ((F.col("entity_type") == "state") & ~F.col("is_total"))
    b = ok.filter((F.col("qc") == "block_ok") & F.col("parent_state_code").isNotNull() & whole).withColumn("state_code", F.col("parent_state_code"))
    b = b.withColumn("source", F.lit("district_total")).withColumn("priority", F.lit(1))
    return _settled(a.unionByName(b).withColumn("head", head(F.col("column_label"))), ["state_code"], order)


def national_panel(facts: DataFrame, states: DataFrame, order: str) -> DataFrame:
    """One row per year, family, head and measure of the whole country.

    Rows of national tables (format ``xls``, entities are heads) whose title and column name no state of ``states`` (name),
    and the country's row of tables of states that add up. Facts as for ``state_panel``, and format.
    """
    ok = facts.filter(F.col("year").isNotNull() & F.col("metric").isin(KEEP_NATIONAL)).withColumn("is_total", F.coalesce("is_total", F.lit(False)))
    place, column, name = unused(facts.columns, "of_place", "of_column", "state_name")
    known = states.select(text.normal_name(F.col("name")).alias(name)).distinct()
    nat = ok.filter((F.col("format") == "xls") & (F.col("entity_type") == "crime_head") & ~F.col("column_label").rlike(PARTS))
    nat = nat.withColumn(place, text.normal_name(F.regexp_extract("title_key", OF_PLACE, 1))).withColumn(column, text.normal_name(F.element_at(F.split("column_label", r" \| "), -1)))
    nat = nat.join(known, F.col(place) == F.col(name), "left_anti").join(known, F.col(column) == F.col(name), "left_anti").drop(place, column)
    nat = nat.withColumn("head", F.when(~F.col("entity").rlike(PARTS) | F.col("entity").rlike("(?i)^total"), F.col("entity")))
    tot = ok.filter((F.col("entity_type") == "state") & F.col("is_total") & (F.col("qc") == "sum_ok") & F.col("entity").rlike("(?i)india")).withColumn("head", head(F.col("column_label")))
    return _settled(nat.unionByName(tot).withColumn("priority", F.lit(0)), [], order)
