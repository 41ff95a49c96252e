"""Ordered-rule classifiers compiled into CASE chains, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, str]]


def first_match(c: Column, rules: Rules, default: str | None = None) -> Column:
    """The key of the first rule (key, pattern) that the text contains."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for key, pattern in rules:
        out = out.when(c.rlike(pattern), F.lit(key))
    return out.otherwise(F.lit(default).cast("string"))


def leaf_first(label: Column, rules: Rules, total: str, separator: str = r" \| ", total_key: str = "total", default: str = "other") -> Column:
    """A hierarchical label: its segments from the leaf up, the rules in order within each.

    Without a match the label is ``total_key`` if a segment matches ``total``, else ``default``; null stays null.
    """
    parts = F.split(label, separator)
    found = F.get(F.filter(F.transform(F.reverse(parts), lambda s: first_match(s, rules)), lambda k: k.isNotNull()), F.lit(0))
    return F.when(label.isNull() | (label == ""), None).otherwise(F.coalesce(found, F.when(F.exists(parts, lambda s: s.rlike(total)), F.lit(total_key)), F.lit(default)))


def by_precedence(label: Column, title: Column, codes: dict[str, str], label_rules: Rules, title_rules: Rules, default: str = "unknown") -> Column:
    """A measure: an abbreviation as the label's last word, else the label's rules, else the title's, else the default."""
    last = F.element_at(F.split(F.trim(label), r"[ |]+"), -1)
    code = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in codes.items():
        code = code.when(last == k, F.lit(v))
    return F.coalesce(code, first_match(label, label_rules), first_match(title, title_rules), F.lit(default))


def allowed(c: Column, values: Sequence[str]) -> Column:
    """The value if it is in the closed list, else null."""
    return F.when(c.isin(list(values)), c)
