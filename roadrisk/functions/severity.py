"""Severity label and weight as native expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadrisk import config as C


def mo_code_tokens(mocodes: Column) -> Column:
    """Whitespace-split MO codes; NULL and blank give an array with ''."""
    return F.split(F.trim(F.coalesce(mocodes, F.lit(""))), r"\s+")


def severity_label(mocodes: Column, description: Column, rules=C.SEVERITY_RULES) -> Column:
    """First matching rule wins: fatal > pedestrian > bicycle > severe > other.

    A rule matches when one of its codes is a whole token of the MO codes, or
    one of its words is a substring of the upper-cased description.
    """
    codes = mo_code_tokens(mocodes)
    desc = F.upper(F.coalesce(description, F.lit("")))
    expr = None
    for label, rule_codes, words in rules:
        cond = None
        for code in rule_codes:
            c = F.array_contains(codes, code)
            cond = c if cond is None else cond | c
        for word in words:
            c = desc.contains(word)
            cond = c if cond is None else cond | c
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.SEVERITY_OTHER))


def severity_weight(severity: Column, weights=C.SEVERITY_WEIGHTS) -> Column:
    expr = None
    for label, w in weights.items():
        if label == C.SEVERITY_OTHER:
            continue
        cond = severity == F.lit(label)
        expr = F.when(cond, F.lit(w)) if expr is None else expr.when(cond, F.lit(w))
    return expr.otherwise(F.lit(weights[C.SEVERITY_OTHER]))


def count_of(severity: Column, label: str) -> Column:
    """Aggregate: rows with this severity, as BIGINT."""
    return F.count_if(severity == F.lit(label))
