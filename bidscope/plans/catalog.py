"""Registry of named queries: a Spark callable (spark, sf_dir) -> DataFrame
and, where the semantics are SQL-expressible, the equivalent DuckDB SQL
over the same parquet tables.

Every query reads the given tables through the auction view, so its work
grows with them.  Doubles are rounded to 6 places on both sides for the
value comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.plans.auction_view import VIEW_SQL, auction_offers

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6

# Row key of the auction view (unique together with l_shipdate).
KEY = ["l_orderkey", "l_linenumber", "ProductId", "SellerId", "CompetitionName"]
KEY_SQL = ", ".join(KEY)
LANDED_SQL = "lp as (select *, ListingPrice+ShippingPrice as LandedPrice from offers)"

# Per-auction context (winner price G3, customer, bounds G4) in DuckDB SQL.
CONTEXT_SQL = LANDED_SQL + """,
ctx as (select CompetitionName,
   cast(sum(case when IsBuyBoxWinner=1 then 1 else 0 end) as bigint) as n_winners,
   min(LandedPrice) as MinPrice, max(LandedPrice) as MaxPrice,
   coalesce(min(case when IsBuyBoxWinner=1 then LandedPrice end), min(LandedPrice)) as WinnerPrice,
   max(case when IsCustomer=1 then LandedPrice end) as CustomerPrice,
   max(case when IsCustomer=1 then IsBuyBoxWinner end) as CustomerStatus
  from lp group by CompetitionName),
bnd as (select *,
   case when CustomerStatus=1 then greatest(WinnerPrice, MinPrice)
        when CustomerPrice > WinnerPrice then greatest(WinnerPrice, MinPrice)
        else greatest(CustomerPrice - CustomerPrice*0.1::double, MinPrice) end as lo,
   case when CustomerStatus=1 then WinnerPrice + WinnerPrice*0.1::double
        when CustomerPrice > WinnerPrice then least(CustomerPrice, WinnerPrice + WinnerPrice*0.1::double)
        else WinnerPrice end as hi,
   WinnerPrice as mid from ctx)"""


def sql_linspace(a: str, b: str, n: int) -> str:
    if n == 1:
        return f"[{a}]"
    return (f"list_transform(range(0,{n}), lambda i: case when i={n - 1} then ({b})::double "
            f"else i*((({b})-({a}))/{n - 1}) + ({a}) end)")


def sql_logspace(a: str, b: str, n: int) -> str:
    return (f"list_transform({sql_linspace(f'log10({a})', f'log10({b})', n)}, "
            f"lambda e: pow(10.0::double, e))")


def sql_grid_cents(lst: str) -> str:
    # cents half to even, after a snap to six places of a cent
    return (f"list_transform({lst}, lambda x: "
            f"round_even(round_even(x*1e8::double, 0)/1e6::double, 0)/100.0::double)")


def sql_unique(lst: str) -> str:
    return f"list_sort(list_distinct({lst}))"


def sql_grid(lo: str, mid: str, hi: str) -> str:
    up80 = sql_unique(sql_grid_cents(sql_logspace(mid, hi, 80)))
    full50 = sql_unique(sql_grid_cents(sql_logspace(lo, hi, 50)))
    up50 = sql_unique(sql_grid_cents(sql_logspace(mid, hi, 50)))
    pv = f"list_min({up50})"
    mirror = (f"list_transform(list_filter({up50}, lambda e: ({pv} - (e - {pv})) >= {lo} "
              f"and e <> {lo}), lambda e: {pv} - (e - {pv}))")
    both = sql_unique(f"list_concat({mirror}, {up50})")
    return f"(case when {lo} = {mid} then {up80} when {mid} = {hi} then {full50} else {both} end)"


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round double/float columns (the comparison precision)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def positive_zero(sql: str, digits: int = DIGITS) -> str:
    """Wrap every ``round(x, digits)`` as ``(round(x, digits) + 0.0)`` so a
    tiny negative rounds to +0.0 as Spark's decimal rounding does."""
    out, i, tail = [], 0, f", {digits})"
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = sql[j:k + 1]
        out.append(sql[i:j])
        fixed = "round(" + positive_zero(inner[6:], digits)
        out.append("(" + fixed + " + 0.0::double)" if inner.endswith(tail) else fixed)
        i = k + 1


def with_view(body: str) -> str:
    """Prefix SQL with the auction view CTEs (``k``, ``offers``)."""
    body = positive_zero(body.strip())
    if body.lower().startswith("with "):
        return "with " + VIEW_SQL.strip() + ",\n" + body[5:]
    return "with " + VIEW_SQL.strip() + "\n" + body


def query(name: str, sql: str | None = None, view: bool = True):
    """Register a query; ``sql`` is the oracle (auction view prepended)."""
    def deco(fn: Callable[[DataFrame], DataFrame] | QueryFn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            src = auction_offers(spark, sf_dir) if view else None
            res = fn(src) if view else fn(spark, sf_dir)
            return finish(res)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_view(sql) if view else positive_zero(sql)
        return fn
    return deco


# Query definitions live in catalog_*.py modules; importing them registers.
def load_all() -> None:
    from bidscope.plans import (catalog_core, catalog_models, catalog_reprice,  # noqa: F401
                                catalog_scalar, catalog_streams, catalog_tables)
