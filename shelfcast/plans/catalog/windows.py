"""Window features, decomposition, distribution distance and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import decompose, distribution, explain, model
from shelfcast.operators import features as B
from shelfcast.operators import windows as V
from shelfcast.plans.catalog.base import query, rd, rds, rounded
from shelfcast.plans.catalog.joins import OIL_FILLED_SQL
from shelfcast.sources.retail import Retail
from shelfcast.spec import SALES, PanelSpec

GRAIN = "store_nbr, family, date"
SERIES_SQL = "PARTITION BY store_nbr, family ORDER BY date"
FN = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}


def _rolling_sql(column: str, sizes, series: str, shift: int = 0) -> str:
    return ", ".join(
        rd(f"{FN[s]}({column}) OVER ({series} ROWS BETWEEN {n - 1 + shift} PRECEDING AND "
           f"{'CURRENT ROW' if not shift else f'{shift} PRECEDING'})")
        + f" AS {column}_roll_{n}_{s}"
        for n in sizes
        for s in V.STATS
    )


@query(
    "win_lag",
    f"SELECT {GRAIN}, sales, "
    + ", ".join(f"lag(sales, {k}) OVER ({SERIES_SQL}) AS sales_lag_{k}" for k in V.LAGS)
    + " FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    return r.sales().drop("onpromotion").withColumns(V.lags("sales"))


@query(
    "win_lag_transactions",
    "SELECT store_nbr, date, "
    + ", ".join(
        f"lag(transactions, {k}) OVER (PARTITION BY store_nbr ORDER BY date) AS transactions_lag_{k}"
        for k in V.LAGS
    )
    + " FROM t_trans",
)
def _(r: Retail) -> DataFrame:
    return B.transaction_lags(r.transactions())


@query("win_rolling_stats", f"SELECT {GRAIN}, {_rolling_sql('sales', V.WINDOWS, SERIES_SQL)} FROM t_sales")
def _(r: Retail) -> DataFrame:
    made = V.rolling("sales")
    return rounded(r.sales().withColumns(made).select("store_nbr", "family", "date", *made))


@query(
    "win_rolling_past_only",
    f"SELECT {GRAIN}, {_rolling_sql('sales', V.WINDOWS, SERIES_SQL, 1)} FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    """Rolling statistics without the current row, the form used for training."""
    made = V.rolling("sales", exclude_current=True)
    return rounded(r.sales().withColumns(made).select("store_nbr", "family", "date", *made))


EVENT_SERIES = "PARTITION BY event_type ORDER BY ts, event_id"


@query(
    "win_rolling_long_groups",
    "SELECT event_id, "
    + ", ".join(f"lag(value, {k}) OVER ({EVENT_SERIES}) AS value_lag_{k}" for k in V.LAGS)
    + f", {_rolling_sql('value', V.WINDOWS, EVENT_SERIES)} FROM events",
)
def _(r: Retail) -> DataFrame:
    """The same features on raw events by type: few, very long groups, cut into slices."""
    rows = r.raw("events").select("event_id", "event_type", "ts", "value")
    made = V.rolling_on_long_groups(rows, ["event_type"], ["ts", "event_id"], "value", slice_rows=500)
    return rounded(made.drop("event_type", "ts", "value"))


@query(
    "win_expanding_stats",
    f"SELECT {GRAIN}, "
    + ", ".join(
        rd(f"{FN[s]}(sales) OVER ({SERIES_SQL} ROWS UNBOUNDED PRECEDING)") + f" AS sales_expanding_{s}"
        for s in V.STATS
    )
    + " FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    made = V.expanding("sales")
    return rounded(r.sales().withColumns(made).select("store_nbr", "family", "date", *made))


@query(
    "win_promo_rolling_count",
    f"SELECT {GRAIN}, "
    + ", ".join(
        f"CAST(sum(onpromotion) OVER ({SERIES_SQL} ROWS {n - 1} PRECEDING) AS BIGINT) AS onpromotion_roll_{n}_count"
        for n in V.WINDOWS
    )
    + " FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    return r.sales().withColumns(V.promo_counts()).drop("sales", "onpromotion")


@query(
    "win_promo_lag",
    f"SELECT {GRAIN}, "
    + ", ".join(f"lag(onpromotion, {k}, 0) OVER ({SERIES_SQL}) AS onpromotion_lag_{k}" for k in V.LAGS)
    + " FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    return r.sales().withColumns(V.promo_lags()).drop("sales", "onpromotion")


INDEXED_SQL = f"SELECT *, row_number() OVER ({SERIES_SQL}) AS i FROM t_sales"


@query(
    "win_days_since_promo",
    f"""SELECT {GRAIN},
  CAST(i - max(CASE WHEN onpromotion > 0 THEN i END) OVER ({SERIES_SQL}) AS INTEGER) AS days_since_promo,
  CAST(sum(1 - onpromotion) OVER ({SERIES_SQL}) AS BIGINT) AS non_promo_rows_so_far
FROM ({INDEXED_SQL})""",
)
def _(r: Retail) -> DataFrame:
    made = V.with_promo_distances(r.sales())
    return made.select("store_nbr", "family", "date", "days_since_promo", "non_promo_rows_so_far")


@query(
    "win_days_to_promo",
    f"""SELECT {GRAIN}, CAST(min(CASE WHEN onpromotion > 0 THEN i END) OVER w - i AS INTEGER) AS days_to_promo,
  CAST(sum(onpromotion) OVER w AS BIGINT) AS promo_rows_ahead
FROM ({INDEXED_SQL})
WINDOW w AS ({SERIES_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def _(r: Retail) -> DataFrame:
    made = V.with_promo_distances(r.sales())
    return made.select("store_nbr", "family", "date", "days_to_promo", "promo_rows_ahead")


@query(
    "win_promo_density",
    f"""SELECT {GRAIN}, {rd('avg(onpromotion) OVER (PARTITION BY store_nbr, date)')} AS store_promo_density,
  {rd('avg(onpromotion) OVER (PARTITION BY family, date)')} AS family_promo_density FROM t_sales""",
)
def _(r: Retail) -> DataFrame:
    dense = V.promo_density(r.panel()).drop("sales", "onpromotion")
    return rounded(dense)


@query(
    "win_oil_rolling",
    f"SELECT date, {rds('dcoilwtico')}, {rd('a7', 9)} AS oil_price_7d_avg, {rd('a30', 9)} AS oil_price_30d_avg "
    f"FROM ({OIL_FILLED_SQL})",
)
def _(r: Retail) -> DataFrame:
    made = B.oil_features(r.oil())
    return rounded(rounded(made, "oil_price_7d_avg", "oil_price_30d_avg", digits=9), "dcoilwtico")


@query(
    "win_ffill_bfill",
    f"""SELECT {GRAIN}, coalesce(last_value(x IGNORE NULLS) OVER ({SERIES_SQL} ROWS UNBOUNDED PRECEDING),
  first_value(x IGNORE NULLS) OVER ({SERIES_SQL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS sales
FROM (SELECT *, CASE WHEN onpromotion = 0 THEN sales END AS x FROM t_sales)""",
)
def _(r: Retail) -> DataFrame:
    """Promoted sales blanked out and filled from their neighbours."""
    holed = r.sales().withColumn("sales", F.when(F.col("onpromotion") == 0, F.col("sales")))
    return holed.withColumn("sales", V.fill_gaps("sales", SALES.series())).drop("onpromotion")


@query(
    "win_holiday_distance",
    """WITH h AS (SELECT DISTINCT date AS mark FROM t_active WHERE locale = 'National'
              AND date BETWEEN (SELECT min(date) FROM t_sales) AND (SELECT max(date) FROM t_sales))
SELECT s.*, CAST((SELECT min(mark) FROM h WHERE mark >= s.date) - s.date AS INTEGER) AS days_to_next_holiday,
       CAST(s.date - (SELECT max(mark) FROM h WHERE mark <= s.date) AS INTEGER) AS days_since_last_holiday
FROM t_sales s""",
)
def _(r: Retail) -> DataFrame:
    return B.join_holiday_distances(r.panel(), r.holidays())


@query(
    "win_naive_baseline",
    f"SELECT {GRAIN}, {rd(f'avg(sales) OVER ({SERIES_SQL} ROWS 6 PRECEDING)')} AS baseline FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    made = r.sales().withColumn("baseline", V.naive_baseline("sales"))
    return rounded(made.select("store_nbr", "family", "date", "baseline"))


def _decompose_sql(table: str, p: int, name: str) -> str:
    """The same split written with self-contained steps: trend, straight ends, seasonal, rest."""
    h = p // 2
    trend = (
        f"avg(sales) OVER (s ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
        if p % 2
        else f"(avg(sales) OVER (s ROWS BETWEEN {h} PRECEDING AND {h - 1} FOLLOWING) + "
        f"avg(sales) OVER (s ROWS BETWEEN {h - 1} PRECEDING AND {h} FOLLOWING)) / 2"
    )
    keys = "store_nbr, family"
    return f"""
SELECT {GRAIN}, {rd('trend', 9)} AS sales_{name}_trend, {rd('seasonal', 9)} AS sales_{name}_seasonal,
       {rd('sales - trend - seasonal', 9)} AS sales_{name}_resid
FROM (SELECT *, m - avg(CASE WHEN i <= {p} THEN m END) OVER (PARTITION BY {keys}) AS seasonal
 FROM (SELECT *, avg(sales - trend) OVER (PARTITION BY {keys}, (i - 1) % {p}) AS m
  FROM (SELECT i.*, CASE WHEN n < {2 * p} THEN NULL WHEN t IS NOT NULL THEN t
           WHEN i <= {h} THEN f0 + (f1 - f0) * (i - {h + 1})
           ELSE b0 + (b1 - b0) * (i - (n - {h} - 2)) END AS trend
   FROM (SELECT *, max(CASE WHEN i = {h + 1} THEN t END) OVER g AS f0, max(CASE WHEN i = {h + 2} THEN t END) OVER g AS f1,
            max(CASE WHEN i = n - {h} - 2 THEN t END) OVER g AS b0, max(CASE WHEN i = n - {h} - 1 THEN t END) OVER g AS b1
    FROM (SELECT *, CASE WHEN n >= {2 * p} AND i > {h} AND i <= n - {h} THEN raw END AS t
     FROM (SELECT *, {trend} AS raw FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY date) AS i,
              count(*) OVER (PARTITION BY {keys}) AS n FROM {table})
           WINDOW s AS (PARTITION BY {keys} ORDER BY date)))
    WINDOW g AS (PARTITION BY {keys})) i)))"""


@query(
    "win_seasonal_decompose",
    f"SELECT * FROM ({_decompose_sql('t_epanel', 7, 'weekly')}) "
    f"JOIN ({_decompose_sql('t_epanel', 30, 'monthly')}) USING ({GRAIN})",
)
def _(r: Retail) -> DataFrame:
    """Weekly and monthly split of the event panel, whose series are too short for the latter."""
    spec = PanelSpec()
    panel = r.event_panel()
    made = decompose.seasonal_decompose(panel, spec, {"weekly": 7, "monthly": 30})
    return rounded(made.drop("sales"), digits=9)


@query(
    "win_seasonal_sales",
    f"SELECT * FROM ({_decompose_sql('t_sales', 30, 'monthly')}) "
    f"JOIN ({_decompose_sql('t_sales', 365, 'yearly')}) USING ({GRAIN})",
)
def _(r: Retail) -> DataFrame:
    """Monthly and yearly split of the sales panel."""
    made = decompose.seasonal_decompose(r.sales(), periods={"monthly": 30, "yearly": 365})
    return rounded(made.drop("sales", "onpromotion"), digits=9)


KS_SQL = """
SELECT max(abs(o / no - n / nn)) AS ks_statistic, CAST(max(no) AS BIGINT) AS n_baseline,
       CAST(max(nn) AS BIGINT) AS n_new
FROM (SELECT CAST(sum(old) OVER w AS DOUBLE) AS o, CAST(sum(new) OVER w AS DOUBLE) AS n,
             CAST(sum(old) OVER () AS DOUBLE) AS no, CAST(sum(new) OVER () AS DOUBLE) AS nn
      FROM (SELECT {0} AS v, sum(CASE WHEN {1} THEN 1 ELSE 0 END) AS old,
                   sum(CASE WHEN {1} THEN 0 ELSE 1 END) AS new FROM {2} GROUP BY 1)
      WINDOW w AS (ORDER BY v))"""


def _ks_with_p(feature: str, value: str, old: str, table: str) -> str:
    """The distance with the Kolmogorov series beside it."""
    series = (
        "(SELECT greatest(0, least(1, sum((CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END) * exp(-2 * j * j * x * x)))) "
        "FROM (SELECT unnest(generate_series(1, 100)) AS j))"
    )
    return f"""SELECT '{feature}' AS feature, {rd('ks_statistic', 9)} AS ks_statistic, n_baseline, n_new,
  {rd(f'CASE WHEN x < 0.2 THEN 1 ELSE {series} END')} AS p_value
FROM (SELECT *, ks_statistic * sqrt(n_baseline * n_new / (n_baseline + n_new)) AS x
      FROM ({KS_SQL.format(value, old, table)}))"""


@query(
    "win_ks",
    _ks_with_p("value", "value", "ts < TIMESTAMP '2024-01-16'", "events")
    + " UNION ALL "
    + _ks_with_p("user_id", "user_id", "ts < TIMESTAMP '2024-01-16'", "events"),
)
def _(r: Retail) -> DataFrame:
    old = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    events = r.raw("events").withColumn("old", old)
    long = distribution.to_long(events, ["value", "user_id"], keep=["old"])
    return rounded(rounded(distribution.ks_statistic(long, "old"), "ks_statistic", digits=9), "p_value")


@query(
    "win_ts_folds",
    f"""WITH n AS (SELECT *, row_number() OVER (ORDER BY date, store_nbr, family) - 1 AS row_index,
                   count(*) OVER () AS total FROM t_sales)
SELECT {GRAIN}, row_index,
  CASE WHEN row_index < total - 5 * (total // 6) THEN 0
       ELSE CAST((row_index - (total - 5 * (total // 6))) // (total // 6) + 1 AS INTEGER) END AS fold
FROM n""",
)
def _(r: Retail) -> DataFrame:
    folded = model.time_folds(r.panel(), ["date", "store_nbr", "family"])
    return folded.select("store_nbr", "family", "date", "row_index", "fold")


@query(
    "win_contrib_rank",
    f"""SELECT {GRAIN}, feature, contribution, position FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY {GRAIN} ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS position
  FROM (SELECT {GRAIN}, unnest(['sales', 'promo', 'store', 'flat']) AS feature,
               unnest([sales / 100, onpromotion * -0.5::DOUBLE, store_nbr / 50.0::DOUBLE, 0.01::DOUBLE]) AS contribution
        FROM t_sales) WHERE abs(contribution) > 0.05) WHERE position <= 2""",
)
def _(r: Retail) -> DataFrame:
    """Made-up contributions of every row: small ones dropped, the two largest kept."""
    pieces = {
        "sales": F.col("sales") / 100,
        "promo": F.col("onpromotion") * F.lit(-0.5),
        "store": F.col("store_nbr") / F.lit(50.0),
        "flat": F.lit(0.01),
    }
    items = F.array(*[F.struct(F.lit(k).alias("feature"), v.alias("contribution")) for k, v in pieces.items()])
    kept = explain.rank_contributions(items, top=2)
    rows = r.sales().select("store_nbr", "family", "date", F.posexplode(kept).alias("pos", "c"))
    return rows.select(
        "store_nbr", "family", "date", "c.feature", "c.contribution", (F.col("pos") + 1).alias("position")
    )


LINES_SQL = """SELECT s_nationkey AS store_nbr, p_type AS family, CAST(l_shipdate AS DATE) AS date
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""


@query(
    "win_repeated_days",
    f"""SELECT store_nbr, family, date, count(*) AS n_rows FROM ({LINES_SQL}) GROUP BY 1, 2, 3 HAVING count(*) > 1
UNION ALL SELECT store_nbr, family, date, count(*) FROM t_sales GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def _(r: Retail) -> DataFrame:
    """Where the order lines are no panel yet; the panel itself adds no row."""
    return V.repeated_days(r.lines()).unionByName(V.repeated_days(r.panel()))
