"""Row-level functions (P1-P23).  All are Column expressions, so they stay
inside whole-stage codegen; none needs Python at run time."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.schema import CLASSIFIER_NAMES, LANDED, LISTING, SHIPPING


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag(col: str | Column, yes: int = 1, no: int = 0) -> Column:
    """Text "true"/"True" -> ``yes``; any other text -> ``no``.

    A null (absent tag) stays null so the caller can quarantine it.
    """
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("int")) \
            .when(c.isin("true", "True"), F.lit(yes)).otherwise(F.lit(no))


def present_flag(col: str | Column) -> Column:
    """1 when the tag is present (even if empty), else 0."""
    return _c(col).isNotNull().cast("int")


def default_missing(df: DataFrame, numeric_default: float = -1,
                    text_default: str = "",
                    columns: Iterable[str] | None = None) -> DataFrame:
    """Absent numbers become -1 and absent text "" (type kept)."""
    cols = set(columns) if columns is not None else set(df.columns)
    out = []
    for f in df.schema.fields:
        if f.name not in cols:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(F.col(f.name), F.lit(text_default)).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            out.append(F.coalesce(F.col(f.name),
                                  F.lit(numeric_default).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def is_customer(offer_seller: str | Column, header_seller: str | Column) -> Column:
    """1 when the offer's seller is the notification's seller."""
    return F.coalesce(_c(offer_seller) == _c(header_seller), F.lit(False)).cast("int")


def file_stem(path: str | Column) -> Column:
    """P5: base name without its last extension (a leading dot is kept)."""
    base = F.regexp_extract(_c(path), r"([^/\\]*)$", 1)
    return F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")


def seconds_since_2016(ts_text: str | Column) -> Column:
    """ISO text ``YYYY-mm-ddTHH:MM:SS.fffZ`` -> seconds since 2016-01-01 UTC."""
    ts = F.to_timestamp_ntz(F.regexp_replace(_c(ts_text), "Z$", ""))
    return seconds_since_2016_ts(ts)


def seconds_since_2016_ts(ts: str | Column) -> Column:
    """P6 for a timestamp(_ntz) column, exact to the microsecond."""
    micros = F.timestamp_diff("MICROSECOND",
                              F.lit("2016-01-01 00:00:00").cast("timestamp_ntz"),
                              _c(ts).cast("timestamp_ntz"))
    return micros / F.lit(1e6)


def log_time(col: str | Column) -> Column:
    """Natural log of Time (monotone, ordering unchanged)."""
    return F.log(_c(col))


def landed_price(df: DataFrame) -> DataFrame:
    """LandedPrice = Listing + Shipping, kept when already present."""
    if LANDED in df.columns:
        return df
    return df.withColumn(LANDED, F.col(LISTING) + F.col(SHIPPING))


def ship_hours_floor(col: str | Column) -> Column:
    """Zero hours count as one."""
    c = _c(col)
    return F.when(c == 0, F.lit(1)).otherwise(c)


def text_code(col: str | Column) -> Column:
    """P10: ln(float(concatenated code points)); "" and null -> -1.

    'A1X' -> '654988' -> ln(654988).  Long texts lose precision past 17
    digits, as in the original definition.
    """
    c = _c(col).cast("string")
    digits = F.array_join(F.transform(F.split(c, ""), lambda ch: F.ascii(ch).cast("string")), "")
    return F.when(c.isNull() | (c == ""), F.lit(-1.0)).otherwise(F.log(digits.cast("double")))


def round2(col: str | Column, decimals: int = 2) -> Column:
    """NumPy-style half-even rounding (scale, rint, unscale)."""
    scale = float(10 ** decimals)
    return F.rint(_c(col) * scale) / scale


def clip(col: str | Column, lo, hi) -> Column:
    """Clamp into [lo, hi]."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.least(F.greatest(_c(col), lo_c), hi_c)


def normal_weight(col: str | Column, mu: str | Column | float) -> Column:
    """N(mu, 1) density at x."""
    m = mu if isinstance(mu, Column) else (F.col(mu) if isinstance(mu, str) else F.lit(float(mu)))
    d = _c(col) - m
    return F.exp(-(d * d) / 2.0) / F.sqrt(F.lit(2.0) * F.pi())


def price_direction(price: str | Column, current: str | Column) -> Column:
    """UP / DOWN / KEEP, comparing both prices at 3 decimals."""
    p = round2(price, 3)
    c = round2(current, 3)
    return F.when(p > c, "UP").when(p < c, "DOWN").otherwise("KEEP")


def status_name(col: str | Column) -> Column:
    """1 -> Win, else Lose."""
    return F.when(_c(col) == 1, "Win").otherwise("Lose")


def to_01(col: str | Column) -> Column:
    """+1/-1 label -> 1/0 (Spark ML labels)."""
    return F.when(_c(col) == 1, 1.0).otherwise(0.0)


def to_pm1(col: str | Column) -> Column:
    """1/0 prediction -> +1/-1."""
    return F.when(_c(col) == 1, 1).otherwise(-1)


def round_prediction(col: str | Column) -> Column:
    """P20: round the predicted class (half-even)."""
    return F.rint(_c(col))


def classifier_name(col: str | Column, names: Mapping[int, str] = CLASSIFIER_NAMES) -> Column:
    """Classifier id -> name, else 'Wrong'."""
    pairs = []
    for k, v in names.items():
        pairs += [F.lit(int(k)), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[_c(col).cast("int")], F.lit("Wrong"))


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def cut_features(df: DataFrame, ranked: Sequence[str], n: int,
                 label: str = "IsBuyBoxWinner", keep: Sequence[str] = ()) -> DataFrame:
    """Label + the first ``n`` ranked features (+ ``keep`` columns)."""
    return df.select(label, *list(ranked)[:n], *[k for k in keep if k not in ranked[:n]])


def columns_of_type(df: DataFrame, dtype=T.StringType) -> list[str]:
    """Names of the columns of one type (schema only, no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, dtype)]
