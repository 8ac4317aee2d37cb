"""Role classification: an ordered list of rules, compiled to one CASE over native regular expressions. The first rule that holds decides."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import role_terms as R


def any_signal(text: Column, terms: tuple[str, ...]) -> Column:
    """One alternation for all terms; those of three letters or fewer need word boundaries."""
    short = [re.escape(t) for t in terms if len(t) <= 3 and t.isalpha()]
    parts = [re.escape(t) for t in terms if not (len(t) <= 3 and t.isalpha())]
    if short:
        parts.append(rf"\b(?:{'|'.join(short)})\b")
    return text.rlike("(?U)" + "|".join(parts))


def any_title_term(text: Column, terms: tuple[str, ...]) -> Column:
    """Whole tokens of a title; the words of a term may stand apart by any white space."""
    phrases = "|".join(r"\s+".join(re.escape(w) for w in t.split(" ")) for t in terms)
    return text.rlike(rf"(?U)(?<![a-z0-9])(?:{phrases})(?![a-z0-9])")


def any_pattern(text: Column, patterns: tuple[str, ...]) -> Column:
    return text.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in patterns))


def classify_role(title: Column, context: Column | None = None, seniority: Column | None = None) -> Column:
    """struct(status: strong, possible, weak or exclude; reason)."""
    title = F.lower(F.coalesce(title, F.lit("")))
    both = F.concat(title, F.lit(" "), F.lower(F.coalesce(context, F.lit("")) if context is not None else F.lit("")))
    level = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(seniority, F.lit("")) if seniority is not None else F.lit("")), "[^a-z]+", "_"), "^_+|_+$", "")
    full_stack, full_stack_title = any_signal(both, R.FULL_STACK_TERMS), any_signal(title, R.FULL_STACK_TERMS)
    backend, backend_title = any_signal(both, R.BACKEND_ROLE_TERMS), any_signal(title, R.BACKEND_ROLE_TERMS)
    software, founding = any_signal(title, R.SOFTWARE_ROLE_TERMS), any_signal(title, R.FOUNDING_TERMS)
    says_software = F.contains(title, F.lit("software"))
    backend_role = title.rlike(r"(?U)\bback[ -]?end\b.{0,32}\b(?:developer|engineer)\b|\b(?:developer|engineer)\b.{0,32}\bback[ -]?end\b")
    senior = any_signal(title, R.SENIOR_TERMS) | level.isin("senior", "staff")
    softwarelike = says_software | full_stack_title | backend_role
    cabling = any_pattern(title, R.PHYSICAL_IT_IMPLEMENTATION_TITLE_PATTERNS) & any_pattern(both, R.PHYSICAL_IT_CABLING_CONTEXT_PATTERNS) & any_pattern(both, R.PHYSICAL_IT_EQUIPMENT_CONTEXT_PATTERNS)
    core = founding | senior | title.rlike("backend|back end|back-end|platform|infrastructure")
    rules = [
        (any_pattern(title, R.JUNIOR_TITLE_PATTERNS), "exclude", "Junior or entry-level role is outside senior lane"),
        (any_title_term(title, R.EXCLUDED_ROLE_TERMS), "exclude", "Non-engineering or junior/intern role"),
        (any_pattern(title, R.ENGINEERING_LEADERSHIP_TITLE_PATTERNS), "exclude", "Engineering leadership role is outside IC SWE lane"),
        (any_pattern(title, R.DESIGN_PROCESS_TITLE_PATTERNS), "exclude", "Design-process role is outside the IC SWE lane"),
        (any_pattern(title, R.BUSINESS_DEVELOPMENT_TITLE_PATTERNS), "exclude", "Business-development role is outside the IC SWE lane"),
        (any_title_term(title, R.ENGINEERING_DOMAIN_MODIFIER_TERMS) & ~(software | full_stack_title | backend_title), "exclude", "Business-domain role lacks an explicit software/backend title"),
        (any_title_term(title, R.EXCLUDED_ENGINEERING_TITLE_TERMS), "exclude", "Engineering-adjacent role is outside the IC SWE lane"),
        (any_pattern(title, R.QUALITY_ENGINEERING_TITLE_PATTERNS), "exclude", "QA/test role is outside the IC SWE lane"),
        (any_pattern(title, R.PHYSICAL_ENGINEERING_TITLE_PATTERNS) & ~softwarelike, "exclude", "Physical or industrial engineering role is outside software lane"),
        (cabling & ~softwarelike, "exclude", "Physical IT implementation role is outside software lane"),
        (any_pattern(both, R.NON_OPENING_CONTEXT_PATTERNS), "exclude", "Listing is not a current opening"),
        (any_signal(title, R.DATA_ANALYST_TERMS), "exclude", "Data analyst role is outside the engineering lane"),
        (any_signal(title, R.RESEARCH_ONLY_TERMS) & ~backend, "exclude", "Research-only ML role lacks backend/platform signal"),
        (~any_signal(title, R.ENGINEERING_TITLE_TERMS), "exclude", "Title is not an engineering role"),
        (~full_stack & backend & core, "strong", "Backend/platform role matches primary target lane"),
        (senior & software, "strong", "Senior software engineering role matches target lane"),
        (full_stack & backend, "possible", "Full-stack role has backend/API/data/infra signals"),
        (full_stack, "possible", "Full-stack engineering role matches expanded target lane"),
        (any_signal(title, R.FRONTEND_ONLY_TITLE_TERMS), "possible", "Frontend engineering role matches expanded target lane"),
        (any_pattern(title, R.AI_ENGINEERING_TITLE_PATTERNS), "possible", "Production AI/ML engineering role matches expanded target lane"),
        (founding & backend, "possible", "Founding role has backend-heavy signals"),
        (software & (level == "mid_level"), "possible", "Provider-classified mid-level software engineering role"),
        (founding | software, "weak", "Engineering role exists, but target-lane fit is unclear"),
        (F.lit(True), "weak", "No clear target software engineering role signal"),
    ]
    out = F.lit(None)
    for holds, status, reason in reversed(rules):
        out = F.when(holds, F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))).otherwise(out)
    return out


# Families by title, first match wins.
FAMILIES = (
    ("full_stack", (r"\bfull[ -]?stack\b",)),
    ("frontend", (r"\bfront[ -]?end\b", r"\bfrontend\b", r"\b(?:react|ui|web)\s+(?:developer|engineer)\b")),
    ("ai_engineering", R.AI_ENGINEERING_TITLE_PATTERNS),
    ("backend", (r"\bback[ -]?end\b", r"\bbackend\b", r"\bapi\s+developer\b")),
    ("software_engineering", (r"\bsoftware\b", r"\b(?:sde|swe)\b")),
    ("data_engineering", (r"\bdata\s+(?:developer|engineer)\b",)),
    ("platform_infrastructure", (r"\b(?:platform|infrastructure|cloud|devops)\b", r"\bsite reliability\b", r"\bsre\b")),
)


def role_family(title: Column) -> Column:
    out = F.lit("supporting_engineering")
    for name, patterns in reversed(FAMILIES):
        out = F.when(any_pattern(F.lower(title), patterns), name).otherwise(out)
    return out
