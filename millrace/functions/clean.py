"""Column cleaning written as single projections over built-in functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def cast_and_suffix(df: DataFrame, keys: Sequence[str], suffix: str, to: str = "double") -> DataFrame:
    """Cast every non-key column and append ``suffix`` to its name, in one projection."""
    return df.select(
        *keys, *[F.col(c).try_cast(to).alias(c + suffix) for c in df.columns if c not in keys]
    )


def token_to_null(df: DataFrame, token: str = "NA") -> DataFrame:
    """Replace ``token`` by NULL in every text column."""
    return df.select(
        *[F.nullif(F.col(c), F.lit(token)).alias(c) if kind == "string" else F.col(c)
          for c, kind in df.dtypes]
    )


def day_numbers_to_dates(df: DataFrame, first_day: str) -> DataFrame:
    """Turn 1-based day numbers into dates for every column whose name ends in ``day``."""
    start = F.lit(first_day).cast("date")
    return df.select(
        *[F.date_add(start, F.col(c).cast("int") - 1).alias(c) if c.endswith("day") else F.col(c)
          for c in df.columns]
    )


def anonymise_users(users: DataFrame, time_format: str = "MM-dd-yyyy HH:mm:ss") -> DataFrame:
    """Hash the e-mail, normalise names and parse activity times; keep all other columns."""
    made = {
        "email": F.sha1(F.col("email")),
        "firstname": F.initcap("firstname"),
        "lastname": F.initcap("lastname"),
        "creation_date": F.try_to_timestamp("creation_date", F.lit(time_format)),
        "last_activity_date": F.try_to_timestamp("last_activity_date", F.lit(time_format)),
    }
    return users.select(*[made[c].alias(c) if c in made else F.col(c) for c in users.columns])


def strip_braces(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(c, F.lit(2), F.length(c) - 2)


def normalise_transactions(raw: DataFrame) -> DataFrame:
    """Discounts as positive amounts plus list and paid price (columns of a retailer's till export)."""
    zero = F.lit(0)
    coupon, match = F.col("coupon_disc"), F.col("coupon_match_disc")
    retail, sales = F.col("retail_disc"), F.col("sales_value")
    # whose coupon it was is decided with absent amounts as 0; a sum with an absent part is 0, as published
    own, matched = F.coalesce(coupon, zero), F.coalesce(match, zero)
    made = {
        "campaign_coupon_discount": F.when(matched == 0, -own).otherwise(zero),
        "manuf_coupon_discount": F.when(matched != 0, -own).otherwise(zero),
        "manuf_coupon_match_discount": -match,
        "total_coupon_discount": -(coupon - match),
        "instore_discount": -retail,
        "amount_paid": sales,
        "amount_list": sales - retail - coupon - match,
    }
    used = {"coupon_disc", "coupon_match_disc", "retail_disc", "sales_value"}
    return raw.select(
        *[c for c in raw.columns if c not in used],
        *[F.coalesce(v, zero).alias(k) for k, v in made.items()],
    )


def keep_complete(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    wanted = set(columns)
    return df.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def hash_sample(df: DataFrame, key: str, fraction: float, seed: str) -> DataFrame:
    """Bernoulli sample that depends on the key only, so re-runs and re-computed tasks agree.

    A fraction of 1 keeps all rows and 0 none; a NULL key counts as an empty one.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction {fraction} is not between 0 and 1")
    text = F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.conv(F.substring(F.sha1(text.cast("binary")), 1, 7), 16, 10).cast("bigint")
    return df.filter(digest < F.lit(int(round(fraction * 16 ** 7))))


def shuffle_rows(df: DataFrame, seed: int) -> DataFrame:
    """All rows in random order (a distributed sort on a seeded random number)."""
    return df.orderBy(F.rand(seed))


def relabel(c: str | Column, names: Mapping[int, str], default: str | None = None) -> Column:
    """Map small integer codes to names without a UDF."""
    c = F.col(c) if isinstance(c, str) else c
    pairs = [x for k, v in names.items() for x in (F.lit(k), F.lit(v))]
    mapped = F.create_map(*pairs)[c]
    return mapped if default is None else F.coalesce(mapped, F.lit(default))
