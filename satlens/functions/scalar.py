"""Row-level column expressions (no UDFs; all JVM-side and codegen'd)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from satlens import config as C


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL so comparisons behave like pandas (missing never compares true)."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def replace_values(c, mapping: Mapping) -> Column:
    """Value replace, e.g. medium haul -> short haul; other values pass."""
    c = col_(c)
    out = c
    for old, new in mapping.items():
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def haul_merge(c=C.HAUL) -> Column:
    return replace_values(c, C.HAUL_REPLACE)


def parse_timestamp_strict(c) -> Column:
    """Strict parse: malformed text raises under ANSI mode."""
    return F.to_timestamp(col_(c))


_FIELDS = {"yyyy": r"(\d{4})", "MM": r"(\d{2})", "dd": r"(\d{2})", "HH": r"(\d{2})", "mm": r"(\d{2})",
           "ss": r"(\d{2})"}


def parse_timestamp(c, fmt: str = "yyyyMMdd HH:mm:ss") -> Column:
    """Coercing parse with an explicit format (fields yyyy MM dd HH mm ss):
    malformed text or impossible values -> NULL.

    The result is local wall-clock time (timestamp without time zone), built
    from the fields directly, so no session time zone or DST gap shifts it."""
    import re
    tokens = re.findall(r"yyyy|MM|dd|HH|mm|ss|.", fmt)
    pattern = "^" + "".join(_FIELDS.get(t, re.escape(t)) for t in tokens) + "$"
    fields = [t for t in tokens if t in _FIELDS]
    x = col_(c)
    part = {t: F.regexp_extract(x, pattern, i + 1) for i, t in enumerate(fields)}

    def get(t, default):
        return part[t].try_cast("int") if t in part else F.lit(default)

    secs = part["ss"].try_cast("decimal(16,6)") if "ss" in part else F.lit(0).cast("decimal(16,6)")
    ts = F.try_make_timestamp_ntz(get("yyyy", 1970), get("MM", 1), get("dd", 1), get("HH", 0), get("mm", 0), secs)
    return F.when(x.rlike(pattern), ts)


def parse_ok(c, fmt: str = "yyyyMMdd HH:mm:ss") -> Column:
    """Parse status for the 'ignore errors' mode: input kept, flag says if it parsed."""
    return parse_timestamp(c, fmt).isNotNull() | col_(c).isNull()


def delay_minutes(real, scheduled) -> Column:
    """(real - scheduled) in minutes of local wall-clock time, NULL when either
    side is NULL.  Computed from date and time-of-day fields, so neither the
    session time zone nor a DST change alters the difference."""
    def secs(t):
        t = col_(t)
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    days = F.datediff(col_(real).cast("date"), col_(scheduled).cast("date"))
    return (days.cast("long") * 86400 + secs(real) - secs(scheduled)) / F.lit(60.0)


def duration_seconds(c) -> Column:
    """'HH:MM:SS' (or 'D days HH:MM:SS') duration text -> seconds (double)."""
    c = F.trim(col_(c))
    days = F.coalesce(F.regexp_extract(c, r"^(\d+) days? ", 1).try_cast("int"), F.lit(0))
    hms = F.regexp_extract(c, r"(\d+):(\d+):(\d+(?:\.\d+)?)$", 0)
    parts = F.split(hms, ":")
    secs = (parts.getItem(0).try_cast("double") * 3600 + parts.getItem(1).try_cast("double") * 60
            + parts.getItem(2).try_cast("double"))
    return F.when(hms == "", F.lit(None).cast("double")).otherwise(days * 86400 + secs)


def weekday(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(c))


def weekend_flag(c) -> Column:
    """1 on Saturday/Sunday."""
    return (F.weekday(col_(c)) >= 5).cast("int")


def month_start(c) -> Column:
    return F.trunc(col_(c).cast("date"), "MM")


def month_end(c) -> Column:
    return F.last_day(col_(c).cast("date"))


def late_flag(delay="delay", minutes: float = C.LATE_MINUTES) -> Column:
    """1 when delay > threshold; NULL / NaN -> 0."""
    return F.coalesce(nan_to_null(delay) > F.lit(minutes), F.lit(False)).cast("int")


def is_category(c, value: str) -> Column:
    return F.coalesce(col_(c) == F.lit(value), F.lit(False)).cast("int")


def nps_class(score) -> Column:
    """Promoter 1, passive 0, detractor -1 (NULL stays NULL)."""
    s = col_(score)
    return (F.when(s > C.PROMOTER_ABOVE, 1).when(s <= C.DETRACTOR_AT_MOST, -1)
            .when(s.isNotNull(), 0))


def nps_category(score) -> Column:
    s = col_(score)
    return (F.when(s > C.PROMOTER_ABOVE, "Promoter").when(s <= C.DETRACTOR_AT_MOST, "Detractor")
            .when(s.isNotNull(), "Passive"))


def in_set(c, values: Sequence) -> Column:
    """Set membership as 0/1, NULL -> 0."""
    return F.coalesce(col_(c).isin(list(values)), F.lit(False)).cast("int")


def date_indicator(c, cut: str = C.DATE_CUT) -> Column:
    """0 on or before the cut, 1 after, NULL stays NULL."""
    d = col_(c)
    return F.when(d <= F.lit(cut).cast("date"), 0).when(d > F.lit(cut).cast("date"), 1)


def map_lookup(c, mapping: Mapping, default=None) -> Column:
    """Literal map lookup (code -> label); small, fixed maps only."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    out = F.element_at(m, col_(c)) if mapping else F.lit(None)
    return out if default is None else F.coalesce(out, F.lit(default))


def group_by_lists(c, groups: Mapping[str, Sequence[str]], other: str = C.COUNTRY_OTHER) -> Column:
    """Assign a group by list membership; later groups win on overlap."""
    resolved: dict = {}
    for g, members in groups.items():
        for m in members:
            resolved[m] = g  # later assignment wins, as sequential overwrites do
    return map_lookup(c, resolved, default=other)


def cut_right_closed(c, edges: Sequence[float]) -> Column:
    """Bin index for right-closed bins (e0, e1], (e1, e2], ...; outside -> NULL."""
    x = col_(c)
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        out = F.when((x > F.lit(edges[i - 1])) & (x <= F.lit(edges[i])), F.lit(i - 1)).otherwise(out)
    return out


def cut_label(c, edges: Sequence[float]) -> Column:
    idx = cut_right_closed(c, edges)
    labels = {i: f"({_fmt(edges[i])}, {_fmt(edges[i + 1])}]" for i in range(len(edges) - 1)}
    return map_lookup(idx, labels)


def _fmt(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else str(v)


def uniform_bin(c, width: float) -> Column:
    """Right-closed bins of fixed width starting at 0: (0,w] -> 0, (w,2w] -> 1; x <= 0 -> NULL."""
    x = col_(c)
    return F.when(x > 0, (F.ceil(x / F.lit(width)) - 1).cast("int"))


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def token_count(c, sep: str = " ") -> Column:
    """Number of tokens of split; NULL text -> 0."""
    c = col_(c)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(F.split(c, sep)))


def inv_logit(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(c)))
