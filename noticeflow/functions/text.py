"""Column -> Column text standardisers. All JVM-side built-ins, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: rules.FIRM_DROP_PATTERN with Java's class of the same 62 letters and digits,
#: which it tests several times faster than three ranges.
_FIRM_DROP = rules.FIRM_DROP_PATTERN.replace("a-zA-Z0-9", r"\p{Alnum}")

_REGEX_META = set("\\^$.|?*+()[]{}")


def literal_alternatives(pattern: str) -> list[str] | None:
    """The alternatives of a pattern made only of literal words joined by
    '|' (an escaped dot counts as a literal dot), else None."""
    words = []
    for alt in pattern.split("|"):
        plain = alt.replace("\\.", "")
        if not alt or any(ch in _REGEX_META for ch in plain):
            return None
        words.append(alt.replace("\\.", "."))
    return words


def pattern_found(lowered: Column, pattern: str) -> Column:
    """``lowered`` contains a match of ``pattern`` (find-anywhere semantics).

    A pure alternation of literals is evaluated as OR-ed substring tests,
    which the JVM runs as byte searches - several times faster than a
    regex alternation over long texts, and the same answer.
    """
    words = literal_alternatives(pattern)
    if words is None:
        return lowered.rlike(pattern)
    cond = None
    for w in words:
        c = F.contains(lowered, F.lit(w))
        cond = c if cond is None else cond | c
    return cond


def first_match_category(
    c: Column | str,
    ordered_rules: list[tuple[str, str]],
    default: Column | str | None = None,
) -> Column:
    """First (pattern, label) whose pattern is found in ``lower(c)``.

    ``default`` is the value when nothing matches (also for NULL input):
    a literal label, a Column (e.g. the input itself), or None for NULL.
    """
    fallback = default if default is None or isinstance(default, Column) else F.lit(default)

    def first(lowered):
        expr = None
        for pattern, label in ordered_rules:
            cond = pattern_found(lowered, pattern)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        return expr if fallback is None else expr.otherwise(fallback)

    # As a lambda over the one lowered text: written out, the rules of a few
    # columns make one generated method too long for the JVM to compile, and all
    # of the stage then runs interpreted.
    return F.get(F.transform(F.array(F.lower(_col(c))), first), F.lit(0))


def clean_firm(c: Column | str) -> Column:
    """Drop everything but letters, digits and whitespace, lower, trim spaces."""
    return F.trim(F.lower(F.regexp_replace(_col(c), _FIRM_DROP, "")))


def standard_classification(c: Column | str) -> Column:
    """Class I/II/III by word-boundary match; anything else passes through."""
    return first_match_category(c, rules.CLASSIFICATION_RULES, _col(c))


def standard_status(c: Column | str) -> Column:
    """Ongoing / Terminated (also 'completed'); unknown statuses pass through."""
    return first_match_category(c, rules.STATUS_RULES, _col(c))


def reason_category(c: Column | str) -> Column:
    return first_match_category(c, rules.REASON_RULES, rules.REASON_DEFAULT)


def product_category(c: Column | str) -> Column:
    return first_match_category(c, rules.PRODUCT_RULES, rules.PRODUCT_DEFAULT)


def distribution_scope(c: Column | str) -> Column:
    return first_match_category(c, rules.DISTRIBUTION_RULES, rules.DISTRIBUTION_DEFAULT)


def region(c: Column | str) -> Column:
    """Census region of a state code (case and padding ignored)."""
    state = F.lower(F.trim(_col(c)))
    expr = None
    for name, states in rules.REGION_STATES.items():
        cond = state.isin(states)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(rules.REGION_DEFAULT))


def is_open(status: Column | str) -> Column:
    """True when the (standardised) status mentions 'ongoing'; NULL stays NULL."""
    return F.lower(_col(status)).rlike("ongoing")


def fill_conflict_keys(c: Column | str) -> Column:
    """NULL or empty key -> 'Unknown' (so the row still has a usable key)."""
    col = _col(c)
    return F.when(col.isNull() | (col == ""), F.lit(rules.CONFLICT_FILL)).otherwise(col)


def region_map_rows() -> list[tuple[str, str]]:
    """(state, region) rows for the lookup-join form of :func:`region`."""
    return [(s, name) for name, states in rules.REGION_STATES.items() for s in states]
