"""Column expressions used by checks and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ordinal text and its order.
SEVERITIES = ("info", "minor", "major", "critical")
STATUSES = ("pass", "warning", "fail", "needs_review")


def first_present(*values: Column) -> Column:
    """The first value that is neither null nor empty text, else empty text."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def finite(value: Column) -> Column:
    """Whether a number is neither null, NaN nor infinite."""
    return F.coalesce(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


def number(text: Column) -> Column:
    """Text as a double; text that is no plain number gives null."""
    plain = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:nan|inf|infinity)\s*$"
    return F.when(text.rlike(plain), text.try_cast("double"))


def json_number(document: Column, key: str) -> Column:
    """A finite number at ``key`` of a JSON text, also where it is written as text."""
    value = F.get_json_object(document, f"$.{key}").try_cast("double")
    return F.when(finite(value), value)


def positive(value: Column) -> Column:
    """A number if it is finite and above zero, else null."""
    return F.when(finite(value) & (value > 0), value)


def error_ratio(actual: Column, expected: Column) -> Column:
    """Deviation relative to what is expected; zero where nothing is expected."""
    return F.when(expected > 0, F.abs(actual - expected) / expected).otherwise(0.0)


def name_tokens(name: Column) -> Column:
    """Lower-case stretches of letters and digits of a name."""
    return F.array_remove(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), "")


def severity_rank(severity: Column, ranks: tuple[str, ...] = SEVERITIES) -> Column:
    """Position of a severity in an order; unknown ones rank -1."""
    out = F.lit(-1)
    for i, name in enumerate(ranks):
        out = F.when(severity == name, i).otherwise(out)
    return out


def decide_status(severity: Column, status: Column) -> Column:
    """Aggregate: the status of a set of findings."""
    any_of = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return (
        F.when(any_of(severity == "critical"), "fail")
        .when(any_of((severity == "major") & (status == "fail")), "fail")
        .when(any_of(status == "needs_review"), "needs_review")
        .when(any_of(severity == "major"), "warning")
        .when(any_of(severity == "minor"), "warning")
        .otherwise("pass")
    )


def final_verdict(phase_status: Column) -> Column:
    """The verdict over all phases of an episode."""
    states = F.map_values(phase_status)
    has = lambda s: F.coalesce(F.array_contains(states, s), F.lit(False))
    return (
        F.when(has("pending"), "umi_pending")
        .when(has("fail"), "fail")
        .when(has("needs_review"), "needs_review")
        .when(has("warning"), "warning")
        .otherwise("pass")
    )


def middle(values: Column) -> Column:
    """Midpoint median of a sorted array; null if it is empty."""
    n = F.size(values)
    at = lambda i: F.get(values, i.cast("int"))
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)


def tukey_iqr(values: Column) -> Column:
    """Spread between the medians of the halves of a sorted array, the middle left out."""
    n = F.size(values)
    half = F.floor(n / 2).cast("int")
    low = F.slice(values, F.lit(1), half)
    high = F.slice(values, (F.ceil(n / 2) + 1).cast("int"), half)
    return F.when(n < 2, F.lit(0.0)).otherwise(middle(high) - middle(low))


def duration_text(seconds: Column) -> Column:
    """h:mm:ss with Python's rounding of halves to even."""
    whole = F.bround(seconds, 0).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60)


def short_number(value: Column, digits: int = 6) -> Column:
    """A number with up to ``digits`` decimals and no trailing zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits}f", value), r"0+$", ""), r"\.$", "")


def redact(document: Column, names: tuple[str, ...] = ("password", "token", "secret", "authorization", "api_key")) -> Column:
    """Masks the values of sensitive keys anywhere in a JSON text."""
    keys = "|".join(names)
    return F.regexp_replace(
        document, rf'(?i)("[^"]*(?:{keys})[^"]*"\s*:\s*)("(?:[^"\\]|\\.)*"|[^,}}\]\s]+)', '$1"***"'
    )


#: Detail keys in the order in which one is shown, the name it is shown under, and its format.
EVIDENCE = (
    ("drop_ratio", "drop_ratio", "%.1f%%"), ("max_consecutive_drops", "max_consecutive", ""), ("violation_ratio", "ratio", "%.1f%%"),
    ("duplicate_ratio", "ratio", "%.1f%%"), ("deviation_ratio", "deviation", "%.1f%%"), ("spread_ms", "spread", "%.0fms"),
    ("iqr_distance", "iqr_distance", "%.1f"), ("threshold", "threshold", ""),
)


def evidence(details: Column) -> Column:
    """The first of the usual detail keys that is present, as ``name=value``; shares as percent."""
    found = []
    for key, name, shape in EVIDENCE:
        text = F.get_json_object(details, f"$.{key}")
        if shape:
            value = text.try_cast("double") * (100 if shape.endswith("%%") else 1)
            text = F.when(value.isNotNull(), F.format_string(shape, value))
        found.append(F.concat(F.lit(f"{name}="), text))
    return F.coalesce(*found, F.lit(""))


#: Device categories by token, in order of priority.
DEVICE_TOKENS = (("umi", "umi"), ("dual", "dual_arm"), ("aloha", "dual_arm"), ("arx5", "dual_arm"), ("single", "single_arm"), ("franka", "single_arm"), ("flexiv", "single_arm"), ("ur", "single_arm"))


def device_category(*names: Column) -> Column:
    """The device category that a robot or task name speaks of, or null."""
    out = F.lit(None).cast("string")
    tokens = F.flatten(F.array(*[name_tokens(F.coalesce(n, F.lit(""))) for n in names]))
    for token, category in reversed(DEVICE_TOKENS):
        out = F.when(F.array_contains(tokens, token), category).otherwise(out)
    return out


def path_context(path: Column) -> dict[str, Column]:
    """Task, date, operator, robot, controller and number an episode path speaks of.

    The first part of eight digits is the date.  If the part two before it
    carries a robot token the path has robot and rig between task and date.
    """
    parts = F.split(path, "/")
    dates = F.filter(parts, lambda p: p.rlike(r"^\d{8}$"))
    at = F.array_position(parts, F.get(dates, F.lit(0))).cast("int")
    part = lambda offset: F.when(at + offset >= 1, F.try_element_at(parts, (at + offset).cast("int")))
    robots = F.array(*[F.lit(t) for t, _ in DEVICE_TOKENS if t not in ("dual", "single")])
    rig = F.coalesce(F.arrays_overlap(name_tokens(part(-2)), robots), F.lit(False)) & part(-1).startswith("rig")
    name = F.element_at(parts, -1)
    tail = F.split(name, "_")
    return {
        "task": F.when(at > 0, F.when(rig, part(-3)).otherwise(part(-1))),
        "date": F.get(dates, F.lit(0)),
        "operator": F.when(at > 0, part(1)),
        "robot": F.when(rig, part(-2)).otherwise(F.when(F.size(tail) >= 5, F.get(tail, F.lit(4)))),
        "controller": F.when(F.size(tail) >= 6, F.array_join(F.slice(tail, 6, 99), "_")),
        "number": F.regexp_extract(name, r"^episode_(\d+)", 1).try_cast("int"),
    }
