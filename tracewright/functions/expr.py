"""Column expressions of the engine; all of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import COUNTER_HINTS, COUNTER_PATTERNS, DEFAULT, PRI_SEVERITY, SERVICE_ALIASES, SEVERITY_PATTERNS, SEVERITY_WORDS, VARIABLE_TOKEN, Config

WORDS = "|".join(SEVERITY_WORDS)


def lookup(table: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def once(x: Column) -> Column:
    """``x``, computed where it stands: the optimizer copies it into no filter or later column that reads it."""
    return F.when(F.spark_partition_id() >= 0, x)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(x, F.lit(lo)), F.lit(hi))


def draw(n: Column, turn: int, seed: int = 42) -> Column:
    """A pseudo-random number in (0, 1) from a number below 2**32: three rounds of multiplying and folding, which SQL says alike."""
    x = (n.cast("long") + 1 + 65_537 * turn + 7919 * seed) % (1 << 32)
    for factor in (1_597_334_677, 1_103_515_245, 1_664_525_013):
        x = (x * factor) % (1 << 32)
        x = x.bitwiseXOR(F.shiftright(x, 15))
    return (x + 0.5) / (1 << 32)


def draw_sql(n: str, turn: int, seed: int = 42) -> str:
    """``draw`` in SQL."""
    x = f"((CAST({n} AS BIGINT) + 1 + {65_537 * turn + 7919 * seed}) % {1 << 32})"
    for factor in (1_597_334_677, 1_103_515_245, 1_664_525_013):
        x = f"(SELECT xor(z, z >> 15) FROM (SELECT ({x} * {factor}) % {1 << 32} AS z))"
    return f"(({x}) + 0.5) / {1 << 32}"


def safe_ratio(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def pri_severity(line: Column) -> Column:
    """Severity of a leading <PRI>, null without one."""
    code = F.regexp_extract(line, r"^<(\d{1,3})>", 1)
    return F.when(code != "", F.element_at(F.array(*[F.lit(s) for s in PRI_SEVERITY]), code.cast("int") % 8 + 1))


def severity_of(message: Column, pri: Column) -> Column:
    """First matching pattern, else the first severity word, else the PRI's, else INFO.

    One alternation of all patterns rules them out together for most messages; the
    patterns themselves stand in a function of their own, which keeps the generated
    code of the whole line small enough to be compiled.
    """
    word = F.upper(F.regexp_extract(message, rf"(?i)\b({WORDS})\b", 1))
    words = F.coalesce(F.when(word != "", lookup(SEVERITY_WORDS, word)), pri, F.lit("INFO"))

    def first(m: Column) -> Column:
        start = None
        for pattern, level in SEVERITY_PATTERNS:
            hit = m.rlike(f"(?i){pattern}")
            start = F.when(hit, level) if start is None else start.when(hit, level)
        return start

    some = message.rlike("(?i)" + "|".join(f"(?:{p})" for p, _ in SEVERITY_PATTERNS))
    return F.when(some, F.element_at(F.transform(F.array(message), first), 1)).otherwise(words)


def service_name(rest: Column) -> Column:
    """Last token before the first colon without its process number; empty without a colon."""
    token = F.element_at(F.split(F.trim(F.substring_index(rest, ":", 1)), r"\s+"), -1)
    return F.when(F.contains(rest, F.lit(":")), F.trim(F.regexp_replace(token, r"\[\d+\]$", ""))).otherwise("")


def service_alias(name: Column) -> Column:
    return F.when(name == "", "UNKNOWN").otherwise(F.coalesce(lookup(SERVICE_ALIASES, F.lower(name)), F.upper(name)))


def service_of(rest: Column) -> Column:
    """Subsystem before the first colon: alias or upper case of its name."""
    return service_alias(service_name(rest))


def message_of(rest: Column) -> Column:
    """Text after the first colon, or all of it without one."""
    return F.when(F.contains(rest, F.lit(":")), F.trim(F.regexp_replace(rest, r"^[^:]*:", ""))).otherwise(rest)


def clean_message(message: Column) -> Column:
    """The message without its first severity word; unchanged if nothing else is in it."""
    rest = F.regexp_replace(message, rf"(?is)^(.*?)\b(?:{WORDS})\b", "$1")
    text = F.trim(F.regexp_replace(F.trim(rest), "^:+", ""))
    return F.coalesce(F.nullif(text, F.lit("")), message)


def event_weight(level: Column, config: Config = DEFAULT) -> Column:
    return F.coalesce(lookup(config.severity_weights, level), F.lit(config.default_weight))


def event_action(service: Column, template: Column) -> Column:
    """The template without its service prefix, else what follows the first underscore, else the template."""
    at = F.instr(template, "_")
    return (
        F.when(F.startswith(template, F.concat(service, F.lit("_"))), F.substr(template, F.length(service) + 2))
        .when(at > 0, F.substr(template, at + 1))
        .otherwise(template)
    )


def tokens(message: Column) -> Column:
    """White-space tokens with variable ones replaced by a wildcard."""
    return F.transform(F.split(F.trim(message), r"\s+"), lambda t: F.when(t.rlike(VARIABLE_TOKEN), "<*>").otherwise(t))


def template_slug(template: Column) -> Column:
    """Name of a template (array of tokens): its first three words, else a digest."""
    words = F.slice(F.filter(template, lambda t: (t != "<*>") & (F.length(t) > 1) & t.rlike(r"^\p{L}+$")), 1, 3)
    digest = F.concat(F.lit("TMPL_"), F.upper(F.substring(F.md5(F.array_join(template, " ")), 1, 8)))
    return F.when(F.size(words) > 0, F.left(F.upper(F.array_join(words, "_")), F.lit(40))).otherwise(digest)


def is_counter(template: Column) -> Column:
    return reduce(lambda a, b: a | b, [template.rlike(f"(?i){p}") for p in COUNTER_PATTERNS])


def is_counter_hint(template: Column) -> Column:
    """Templates that sound like a counter anomaly but match no pattern."""
    return ~is_counter(template) & reduce(lambda a, b: a | b, [F.contains(F.upper(template), F.lit(w)) for w in COUNTER_HINTS])


def label_of(score: Column, config: Config = DEFAULT) -> Column:
    low, mid, high = config.label_maxima
    return F.when(score <= low, "ignore").when(score <= mid, "low").when(score <= high, "medium").otherwise("critical")


def label_rank(label: Column) -> Column:
    return F.coalesce(lookup({"ignore": 0, "low": 1, "medium": 2, "critical": 3}, label), F.lit(1))


def zscore_norm(z: Column) -> Column:
    return (clip(z, -5.0, 5.0) + 5) / 10


def blend(isolation: Column, zscore: Column, rows: Column, config: Config = DEFAULT) -> Column:
    """Anomaly score: the forest counts as far as the number of rows lends confidence."""
    c = F.least(F.lit(1.0), rows / config.full_confidence_rows)
    return clip(c * (config.isolation_weight * isolation + config.zscore_weight * zscore) + (1 - c) * zscore, 0.0, 1.0)


def duration_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    return (
        F.when(s < 60, F.format_string("%ds", s))
        .when(s < 3600, F.format_string("%dm %ds", F.floor(s / 60), s % 60))
        .otherwise(F.format_string("%dh %dm", F.floor(s / 3600), F.floor(s % 3600 / 60)))
    )


def preview(text: Column, width: int = 130) -> Column:
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width)), F.lit("..."))).otherwise(text)


def rate_colour(rate: Column) -> Column:
    return F.when(rate > 0.3, "red").when(rate > 0.1, "amber").otherwise("green")


def confidence_band(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "high").when(confidence >= 0.5, "medium").otherwise("low")
