"""Personal-data rules and sensitivity labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity categories that count as personal data, the four text rules, the two labels.
PII_CATEGORIES = ("Person", "PhoneNumber", "Email")
PHONE_PATTERN = r"\b(\+?1[-\s.]?)?\(?[0-9]{3}\)?[-\s.]?[0-9]{3}[-\s.]?[0-9]{4}\b"
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b"
URL_PATTERN = r"https?://[^\s<>\"']+"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    label: str = "Confidential"


RULES = (
    Rule("NLP_Pipeline_PII_Article", r'"hasPii"\s*:\s*true'),
    Rule("NLP_Pipeline_Person_Entity", r'"category"\s*:\s*"Person"'),
    Rule("NLP_Pipeline_Phone_Pattern", PHONE_PATTERN),
    Rule("NLP_Pipeline_Email_Pattern", EMAIL_PATTERN),
)

SENSITIVITY_ORDER = {"Public": 1, "Confidential": 2}


def has_pii(entities: Column | str) -> Column:
    """True if any entity is of a personal category; NULL and empty arrays give false."""
    column = F.col(entities) if isinstance(entities, str) else entities
    return F.coalesce(
        F.exists(column, lambda entity: F.coalesce(entity.category.isin(*PII_CATEGORIES), F.lit(False))),
        F.lit(False),
    )


def classify(document: Column | str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules a document's text matches, in rule order."""
    text = F.col(document) if isinstance(document, str) else document
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(text.rlike(r.pattern), F.lit(r.name)) for r in rules]))


def sensitivity(matched: Column | str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Strictest label among the matched rules, ``Public`` without a match."""
    names = F.col(matched) if isinstance(matched, str) else matched
    strictest_first = sorted(SENSITIVITY_ORDER, key=SENSITIVITY_ORDER.get, reverse=True)
    label = F.lit("Public")
    for candidate in reversed(strictest_first):
        carriers = [rule.name for rule in rules if rule.label == candidate]
        if carriers:
            hit = F.arrays_overlap(names, F.array(*[F.lit(name) for name in carriers]))
            label = F.when(hit, F.lit(candidate)).otherwise(label)
    return label
