"""The date format of a text column, taken from its first value, as a data frame library's date parser does.

The first value that is there settles the format; values of any other shape become
null. Month comes before day unless the first value can't be read so. If the
first value has none of the known shapes, every value is tried with all of them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shapes of dates and times, and the pattern each is read with.
MONTHS = "january february march april may june july august september october november december".split()
NUMERIC = {"/": r"/", "-": r"-", ".": r"\."}
TIMES = (
    (r"", ""),
    (r"\d{1,2}:\d{2}", "H:mm"),
    (r"\d{1,2}:\d{2}:\d{2}", "H:mm:ss"),
    (r"\d{1,2}:\d{2}:\d{2}\.\d{1,9}", "H:mm:ss.SSSSSSSSS"),
    (r"\d{1,2}:\d{2} ?[AaPp][Mm]", "h:mm a"),
    (r"\d{1,2}:\d{2}:\d{2} ?[AaPp][Mm]", "h:mm:ss a"),
)
OFFSETS = ((r"", ""), (r"Z", "'Z'"), (r"[+-]\d{2}:\d{2}", "xxx"), (r"[+-]\d{4}", "xx"))


def _date_pattern(text: str) -> str | None:
    """Pattern of a date without time."""
    if re.fullmatch(r"\d{4}-\d{1,2}-\d{1,2}", text):
        return "yyyy-M-d"
    if re.fullmatch(r"\d{4}/\d{1,2}/\d{1,2}", text):
        return "yyyy/M/d"
    if re.fullmatch(r"\d{8}", text):
        return "yyyyMMdd"
    for sign, escaped in NUMERIC.items():
        if found := re.fullmatch(rf"(\d{{1,2}}){escaped}(\d{{1,2}}){escaped}\d{{4}}", text):
            return sign.join(("M", "d", "yyyy") if int(found[1]) <= 12 else ("d", "M", "yyyy"))
    if found := re.fullmatch(r"(\d{1,2})([- ])([A-Za-z]+)[- ](\d{4})", text):
        return found[2].join(("d", month, "yyyy")) if (month := _month_pattern(found[3])) else None
    if found := re.fullmatch(r"([A-Za-z]+) \d{1,2}, \d{4}", text):
        return f"{month} d, yyyy" if (month := _month_pattern(found[1])) else None
    return None


def _month_pattern(name: str) -> str | None:
    """Whole names first: "May" is both."""
    if name.lower() in MONTHS:
        return "MMMM"
    return "MMM" if name.lower() in {m[:3] for m in MONTHS} else None


def infer_format(value: str | None) -> str | None:
    """The pattern that reads a date text, or none."""
    if value is None:
        return None
    for time, time_pattern in TIMES:
        for offset, offset_pattern in OFFSETS:
            if offset and not time:
                continue
            tail = f"{time}{offset}"
            found = re.fullmatch(rf"(.+?){'([ T])' if time else '()'}({tail})", value)
            date = _date_pattern(found[1]) if found else None
            if date is None:
                continue
            between = "'T'" if found[2] == "T" else found[2]
            if time_pattern.endswith("a") and " " not in found[3]:
                time_pattern = time_pattern.replace(" a", "a")
            return f"{date}{between}{time_pattern}{offset_pattern}"
    return None


def in_utc(parsed: Column, text: Column, pattern: str) -> Column:
    """A naive time that was read with an offset, as UTC (naive parsing leaves the offset out)."""
    if not pattern.endswith("xx"):
        return parsed
    part = lambda k: F.regexp_extract(text, r"([+-])(\d{2}):?(\d{2})$", k)
    sign = F.when(part(1) == "-", 1).otherwise(-1)
    return parsed + F.make_dt_interval(F.lit(0), sign * part(2).try_cast("int"), sign * part(3).try_cast("int"))


def first_values(df: DataFrame, columns: list[str], order: str) -> dict[str, str | None]:
    """Each text column's first value that isn't null, in the order of ``order`` (one aggregate)."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return {}
    found = df.agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"v{k}") for k, c in enumerate(texts)]).first()
    return {c: found[f"v{k}"] for k, c in enumerate(texts)}


def first_kept_values(rows: DataFrame, kept: DataFrame, keys: list[str], columns: list[str], order: str) -> dict[str, str | None]:
    """``first_values`` of ``kept``, the first row of each key of ``rows``; the de-duplication isn't run for it.

    A column's first value among all rows is the one asked for unless an earlier row has its
    key, which one more scan tells. Only then are the kept rows asked.
    """
    texts = [c for c in columns if isinstance(rows.schema[c].dataType, T.StringType)]
    if not texts:
        return {}
    found = [F.struct(F.col(c).alias("v"), F.col(order).alias("at"), F.struct(*[F.col(k) for k in keys]).alias("key")) for c in texts]
    first = rows.agg(*[F.min_by(x, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_first{i}") for i, (c, x) in enumerate(zip(texts, found, strict=True))])
    told = first.first()
    places = [F.col(f"_first{i}.at") for i in range(len(texts))]
    # of the rows before the last of these places only
    before = rows.crossJoin(F.broadcast(rows.sparkSession.createDataFrame([told], first.schema))).where(F.col(order) < (F.greatest(*places) if len(places) > 1 else places[0]))
    own = F.struct(*[F.col(k) for k in keys])
    earlier = before.agg(*[F.bool_or((F.col(order) < at) & own.eqNullSafe(F.col(f"_first{i}.key"))).alias(f"e{i}") for i, at in enumerate(places)]).first()
    again = [c for i, c in enumerate(texts) if earlier[f"e{i}"]]
    values = {c: told[f"_first{i}"].v if told[f"_first{i}"] else None for i, c in enumerate(texts)}
    return values | (first_values(kept, again, order) if again else {})


#: Written instants are read in every shape's pattern with these, if the first value has no known shape.
ALL_FORMATS = tuple(
    f"{date}{sep}{time}"
    for date in ("yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "M/d/yyyy", "d/M/yyyy", "d-MMM-yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")
    for sep, time in (("", ""), (" ", "H:mm[:ss]"), (" ", "h:mm[:ss] a"))
)
