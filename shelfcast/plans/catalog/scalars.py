"""Filters, calendar parts, numeric, categorical and text expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import calendar as C
from shelfcast.functions import numeric as N
from shelfcast.functions import text as X
from shelfcast.operators import features as B
from shelfcast.operators import report
from shelfcast.plans.catalog.base import query, rd, rounded
from shelfcast.sources.retail import Retail

DAY = "date"
GRAIN = "store_nbr, family, date"


def _int(expr: str, name: str) -> str:
    return f"CAST({expr} AS INTEGER) AS {name}"


# --- filters --------------------------------------------------------------------------------------


@query(
    "flt_dropna_subset",
    "SELECT store_nbr, family, date, sales, onpromotion FROM t_sales WHERE day(date) <> 13",
)
def _(r: Retail) -> DataFrame:
    holed = r.sales().withColumn("date", F.when(F.dayofmonth("date") != 13, F.col("date")))
    return holed.dropna(subset=["date", "store_nbr", "family", "sales", "onpromotion"])


@query("flt_min_date", "SELECT * FROM t_sales WHERE date >= DATE '1995-01-30'")
def _(r: Retail) -> DataFrame:
    return r.sales().where(F.col("date") >= F.lit(dt.date(1995, 1, 30)))


@query(
    "flt_optional_keys",
    "SELECT * FROM t_facts WHERE store_id = 4 AND date >= (SELECT max(date) FROM t_facts) - 365",
)
def _(r: Retail) -> DataFrame:
    """One store, any family, the last year."""
    facts = r.historical_sales()
    chosen = report.where_keys(facts, store_id=4, family_id=None)
    return report.lookback(chosen, "date", 365, r.newest_day())


@query(
    "flt_contains",
    f"SELECT id, model_version, {rd('predicted_sales')} AS predicted_sales FROM t_pred "
    "WHERE contains(model_version, '99')",
)
def _(r: Retail) -> DataFrame:
    kept = r.predictions().where(F.col("model_version").contains("99"))
    return rounded(kept.select("id", "model_version", "predicted_sales"))


@query(
    "flt_active_holidays",
    "SELECT s.* FROM t_sales s SEMI JOIN (SELECT date FROM t_active WHERE locale = 'National') h USING (date)",
)
def _(r: Retail) -> DataFrame:
    """Sales on active national holidays."""
    dates = B.active_holidays(r.holidays(), "National").select("date").distinct()
    return r.sales().join(F.broadcast(dates), "date", "left_semi")


@query(
    "flt_valid_records",
    """SELECT date, CAST(sales AS DOUBLE) AS sales, onpromotion AS is_promotion FROM t_sales
       WHERE day(date) NOT IN (7, 21)""",
)
def _(r: Retail) -> DataFrame:
    """Text records; those with a missing date or an unreadable number are dropped."""
    day = F.dayofmonth("date")
    text = r.sales().select(
        F.when(day != 7, F.date_format("date", "yyyy-MM-dd")).alias("date"),
        F.when(day != 21, F.col("sales").cast("string")).otherwise("n/a").alias("sales"),
        "onpromotion",
    )
    parsed = text.select(
        C.parse_date(F.col("date")).alias("date"),
        F.col("sales").try_cast("double").alias("sales"),
        F.coalesce("onpromotion", F.lit(0)).alias("is_promotion"),
    )
    return parsed.where("date is not null and sales is not null")


@query(
    "prj_fill_prefix",
    f"SELECT {GRAIN}, sales, coalesce(lag(sales, 1) OVER w, 0) AS sales_lag_1, "
    "coalesce(lag(sales, 7) OVER w, 0) AS sales_lag_7 FROM t_sales "
    "WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)",
)
def _(r: Retail) -> DataFrame:
    from shelfcast.operators.windows import lags

    lagged = r.sales().withColumns(lags("sales", (1, 7)))
    return N.fill_prefixed(lagged, ["sales_lag"]).drop("onpromotion")


# --- dates ----------------------------------------------------------------------------------------


@query(
    "dt_parse",
    "SELECT store_nbr, family, CASE WHEN onpromotion = 0 THEN date END AS parsed FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    text = F.when(F.col("onpromotion") == 0, F.date_format("date", "yyyy-MM-dd")).otherwise("invalid-date")
    return r.sales().select("store_nbr", "family", C.parse_date(text).alias("parsed"))


PARTS_SQL = ", ".join(
    [
        _int("isodow(date) - 1", "day_of_week"),
        _int("day(date)", "day_of_month"),
        _int("month(date)", "month"),
        _int("year(date)", "year"),
        _int("quarter(date)", "quarter"),
        _int("isodow(date) >= 6", "is_weekend"),
        _int("day(date) = 1", "is_month_start"),
        _int("date = last_day(date)", "is_month_end"),
    ]
)


@query("dt_parts", f"SELECT {GRAIN}, {PARTS_SQL} FROM t_sales")
def _(r: Retail) -> DataFrame:
    return r.sales().select("store_nbr", "family", "date").withColumns(C.date_parts(F.col(DAY)))


@query(
    "dt_boundary_flags",
    f"SELECT {GRAIN}, "
    + ", ".join(
        [
            _int("date = CAST(date_trunc('quarter', date) AS DATE)", "is_quarter_start"),
            _int("quarter(date + 1) <> quarter(date)", "is_quarter_end"),
            _int("dayofyear(date) = 1", "is_year_start"),
            _int("month(date) = 12 AND day(date) = 31", "is_year_end"),
        ]
    )
    + " FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    return r.sales().select("store_nbr", "family", "date").withColumns(C.boundary_flags(F.col(DAY)))


def _wave(turn: str, name: str) -> str:
    return ", ".join(f"{rd(f'{f}({turn} * 2 * pi())')} AS {name}_{f}" for f in ("sin", "cos"))


@query(
    "dt_cyclical",
    f"SELECT {GRAIN}, "
    + ", ".join(
        [
            _wave("(isodow(date) - 1) / 7.0::DOUBLE", "day_of_week"),
            _wave("day(date) / 31.0::DOUBLE", "day_of_month"),
            _wave("month(date) / 12.0::DOUBLE", "month"),
        ]
    )
    + " FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    return rounded(r.sales().select("store_nbr", "family", "date").withColumns(C.cyclical(F.col(DAY))))


@query("dt_day_of_year", f"SELECT {GRAIN}, {_int('dayofyear(date)', 'day_of_year')} FROM t_sales")
def _(r: Retail) -> DataFrame:
    return r.sales().select("store_nbr", "family", "date", C.day_of_year(F.col(DAY)).alias("day_of_year"))


@query("dt_name", f"SELECT {GRAIN}, dayname(date) AS day_name FROM t_sales")
def _(r: Retail) -> DataFrame:
    return r.sales().select("store_nbr", "family", "date", C.weekday_name(F.col(DAY)).alias("day_name"))


@query(
    "dt_decompose_cols",
    "SELECT store_id, family_id, "
    + ", ".join(
        f"{_int(f'year({c})', f'{c}_year')}, {_int(f'month({c})', f'{c}_month')}, "
        f"{_int(f'day({c})', f'{c}_day')}, {_int(f'isodow({c}) - 1', f'{c}_dayofweek')}"
        for c in ("prediction_date", "target_date")
    )
    + " FROM t_pred",
)
def _(r: Retail) -> DataFrame:
    dated = r.predictions().select("store_id", "family_id", "prediction_date", "target_date")
    return C.expand_datetimes(dated)


# --- numbers --------------------------------------------------------------------------------------


@query(
    "num_interactions",
    f"SELECT {GRAIN}, sales * onpromotion AS sales_x_onpromotion, sales * store_nbr AS sales_x_store_nbr, "
    "onpromotion * store_nbr AS onpromotion_x_store_nbr FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    products = N.interactions(["sales", "onpromotion", "store_nbr"])
    return r.sales().select("store_nbr", "family", "date", *[c.alias(n) for n, c in products.items()])


@query("num_log1p", f"SELECT {GRAIN}, {rd('ln(1 + sales)')} AS log_sales FROM t_sales")
def _(r: Retail) -> DataFrame:
    return rounded(r.sales().select("store_nbr", "family", "date", F.log1p("sales").alias("log_sales")))


@query(
    "num_clip",
    f"SELECT id, {rd('greatest(prediction_interval_lower, 0)')} AS lower_bound, "
    f"{rd('least(greatest(predicted_sales, 5), 40)')} AS clamped FROM t_pred",
)
def _(r: Retail) -> DataFrame:
    low = N.clip(F.col("prediction_interval_lower"), lower=0)
    clamped = N.clip(F.col("predicted_sales"), 5, 40)
    return rounded(r.predictions().select("id", low.alias("lower_bound"), clamped.alias("clamped")))


@query("num_bool_to_int", "SELECT l_orderkey, l_linenumber, CAST(l_discount >= 0.08 AS INTEGER) AS promo FROM lineitem")
def _(r: Retail) -> DataFrame:
    flag = (F.col("l_discount") >= 0.08).cast("int")
    return r.raw("lineitem").select("l_orderkey", "l_linenumber", flag.alias("promo"))


@query(
    "num_inventory_advice",
    f"""SELECT id, {rd('low_threshold')} AS low_threshold,
  CASE WHEN p < low_threshold THEN 'reducing' ELSE 'optimizing' END AS inventory_action,
  CASE WHEN p < low_threshold THEN 'minimize holding costs'
       ELSE 'balance availability with carrying costs' END AS inventory_reason,
  greatest(1, round(sqrt(p * 10) / 0.2::DOUBLE, 1)) AS order_quantity,
  CASE WHEN p < low_threshold THEN 3 ELSE 2 END AS orders_per_week,
  round(p * 0.15::DOUBLE, 2) AS potential_savings,
  CASE WHEN p < low_threshold THEN '1-2 days' ELSE '3-5 days' END AS lead_time
FROM (SELECT t.id, predicted_sales AS p,
        CAST(CASE WHEN contains(name, 'PRODUCE') THEN 15 WHEN contains(name, 'GROCERY') THEN 12
             WHEN contains(name, 'BREAD') OR contains(name, 'BAKERY') THEN 8 ELSE 10 END AS DOUBLE) AS low_threshold
      FROM t_pred t JOIN (SELECT id AS family_id,
        CASE name WHEN 'PROMO' THEN 'PRODUCE' WHEN 'SMALL' THEN 'GROCERY I' WHEN 'LARGE' THEN 'BREAD/BAKERY'
             ELSE name END AS name FROM t_families) USING (family_id))""",
)
def _(r: Retail) -> DataFrame:
    named = r.predictions().join(_food_families(r), "family_id")
    advice = N.inventory_advice(F.col("predicted_sales"), F.col("name"))
    return named.select("id", *[c.alias(n) for n, c in advice.items()])


# part types renamed to families the keyword rules know
FOOD = {"PROMO": "PRODUCE", "SMALL": "GROCERY I", "LARGE": "BREAD/BAKERY"}


def _food_families(r: Retail) -> DataFrame:
    return r.families().select(F.col("id").alias("family_id"), "name").replace(FOOD, subset=["name"])


@query(
    "num_metric_grade",
    f"""SELECT model_version, timestamp, metric_name, {rd('metric_value')} AS metric_value,
  CASE WHEN metric_name = 'r2' THEN CASE WHEN metric_value >= 0.8 THEN 'good'
            WHEN metric_value >= 0.6 THEN 'warning' ELSE 'bad' END
       WHEN metric_name IN ('rmse', 'mae') THEN CASE WHEN metric_value <= 10 THEN 'good'
            WHEN metric_value <= 25 THEN 'warning' ELSE 'bad' END
       ELSE 'default' END AS grade FROM t_metrics""",
)
def _(r: Retail) -> DataFrame:
    grade = N.metric_grade(F.col("metric_name"), F.col("metric_value"))
    graded = r.model_metrics().withColumn("grade", grade)
    return rounded(graded.select("model_version", "timestamp", "metric_name", "metric_value", "grade"))


# --- categories -----------------------------------------------------------------------------------

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
STORE_TYPES = ["A", "B", "C", "D", "E"]


@query(
    "cat_one_hot",
    f"SELECT {GRAIN}, "
    + ", ".join(_int(f"coalesce(type = '{t}', false)", f"type_{t}") for t in STORE_TYPES[1:])
    + " FROM t_sales LEFT JOIN t_stores USING (store_nbr)",
)
def _(r: Retail) -> DataFrame:
    stores = r.stores().select("store_nbr", "type")
    joined = B.join_stores(r.sales().select("store_nbr", "family", "date"), stores)
    return B.one_hot(joined, B.fit_categories(stores, ["type"], most=26), drop_first=True)


@query(
    "cat_one_hot_fit_apply",
    "SELECT store_nbr, date, "
    + ", ".join(_int(f"family = '{t}'", f"family_{t}") for t in PART_TYPES[:-1])
    + " FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    """Categories fitted without the last family, which then gets all zeros."""
    sales = r.sales().select("store_nbr", "date", "family")
    known = r.raw("part").select(F.col("p_type").alias("family")).where("family <> 'STANDARD'")
    return B.one_hot(sales, B.fit_categories(known, ["family"], most=1000))


@query(
    "cat_codes",
    f"""SELECT {GRAIN}, coalesce(c.code, -1) AS family_code
FROM (SELECT store_nbr, CASE WHEN day(date) <> 13 THEN family END AS family, date FROM t_sales)
LEFT JOIN (SELECT name AS family, id - 1 AS code FROM t_families) c USING (family)""",
)
def _(r: Retail) -> DataFrame:
    family = F.when(F.dayofmonth("date") != 13, F.col("family"))
    return B.category_codes(r.panel().select("store_nbr", "date", family.alias("family")), ["family"])


def _vector_sql() -> str:
    head = (
        "onpromotion, year(date), month(date), day(date), isodow(date) - 1, dayofyear(date), "
        "quarter(date), CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END"
    )
    slots = [f"CASE WHEN store_nbr = {i} THEN 1 ELSE 0 END" for i in range(1, B.VECTOR_STORES + 1)]
    slots += [f"CASE WHEN name = '{f}' THEN 1 ELSE 0 END" for f in B.VECTOR_FAMILIES]
    slots += ["0"] * (B.VECTOR_SIZE - 8 - len(slots))
    return f"[{head}, {', '.join(slots)}]"


FOOD_SQL = (
    "CASE family " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in FOOD.items()) + " ELSE family END"
)


@query(
    "vec_fixed",
    f"""SELECT {GRAIN}, array_to_string({_vector_sql()}, ',') AS slots
FROM (SELECT *, {FOOD_SQL} AS name FROM t_sales)""",
)
def _(r: Retail) -> DataFrame:
    named = r.sales().withColumn("name", F.col("family")).replace(FOOD, subset=["name"])
    vector = B.feature_vector(F.col("store_nbr"), F.col("name"), F.col("onpromotion"), F.col(DAY))
    text = F.array_join(F.transform(vector, lambda v: v.cast("int").cast("string")), ",")
    return named.select("store_nbr", "family", "date", text.alias("slots"))


# --- text -----------------------------------------------------------------------------------------


@query(
    "str_entity_parse",
    f"SELECT {GRAIN}, CASE WHEN onpromotion = 1 THEN store_nbr ELSE 1 END AS parsed FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    label = F.when(F.col("onpromotion") == 1, F.concat(F.lit("Store "), "store_nbr")).otherwise("Main")
    return r.sales().select("store_nbr", "family", "date", X.store_number(label).alias("parsed"))


@query(
    "str_family_normalise",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'HOME AND GARDEN' WHEN 'SMALL' THEN 'BREAD/BAKERY'
              WHEN 'LARGE' THEN 'DAIRY' ELSE 'PRODUCE' END AS family FROM part""",
)
def _(r: Retail) -> DataFrame:
    """Untidy spellings of four families, everything else unknown."""
    spelled = (
        F.when(F.col("p_type") == "PROMO", "  home and kitchen ")
        .when(F.col("p_type") == "SMALL", "BreadOrBakery")
        .when(F.col("p_type") == "LARGE", " Dairy")
        .otherwise(F.col("p_name"))
    )
    known = ["BREAD/BAKERY", "DAIRY", "HOME AND GARDEN", "PRODUCE"]
    return r.raw("part").select("p_partkey", X.normalise_family(spelled, known).alias("family"))


@query(
    "str_keyword_score",
    f"""SELECT {GRAIN}, CAST(CASE WHEN name LIKE '%PRODUCE%' THEN 0.18 WHEN name LIKE '%GROCERY%' THEN 0.15
  WHEN name LIKE '%BREAD%' OR name LIKE '%BAKERY%' THEN 0.12 ELSE 0.10 END AS DOUBLE) AS share
FROM (SELECT *, {FOOD_SQL} AS name FROM t_sales)""",
)
def _(r: Retail) -> DataFrame:
    named = r.sales().withColumn("name", F.col("family")).replace(FOOD, subset=["name"])
    return named.select("store_nbr", "family", "date", X.family_share(F.col("name")).alias("share"))


# RE2 knows ASCII word boundaries only, so the tokens put in are followed by an ASCII letter
SANITISE_SQL = (
    r"substring(regexp_replace({0}, '(?i)\b(system:|user:|assistant:|</?(system|user|assistant)>|\\n\\n)\b', "
    r"' ', 'g'), 1, {1})"
)
MARKED_SQL = "role || ':x' || replace(text, '. ', '.user:x') || '<' || role || '>x'"


@query(
    "str_sanitise",
    f"SELECT conv_id, turn, {SANITISE_SQL.format(MARKED_SQL, 256)} AS clean, "
    f"{SANITISE_SQL.format('text', 1000000000)} AS whole FROM conversations",
)
def _(r: Retail) -> DataFrame:
    """Turns with role tokens put in, cleaned and cut; the untouched text cleaned at full length."""
    marked = F.concat(
        "role", F.lit(":x"), F.replace("text", F.lit(". "), F.lit(".user:x")), F.lit("<"), "role", F.lit(">x")
    )
    return r.raw("conversations").select(
        "conv_id", "turn", X.sanitise(marked).alias("clean"),
        X.sanitise(F.col("text"), 1_000_000_000).alias("whole"),
    )


LOOSE_SQL = (
    r"substring(regexp_replace({0}, '(?i)(\b(system|user|assistant):|</?(system|user|assistant)>|\\n\\n)', "
    r"' ', 'g'), 1, {1})"
)


@query(
    "str_sanitise_loose",
    f"SELECT conv_id, turn, {LOOSE_SQL.format(MARKED_SQL, 1000000000)} AS clean FROM conversations",
)
def _(r: Retail) -> DataFrame:
    """The variant that needs no word boundary after a token."""
    marked = F.concat(
        "role", F.lit(":x"), F.replace("text", F.lit(". "), F.lit(".user:x")), F.lit("<"), "role", F.lit(">x")
    )
    clean = X.sanitise(marked, 1_000_000_000, X.ROLE_TOKENS_LOOSE)
    return r.raw("conversations").select("conv_id", "turn", clean.alias("clean"))


@query(
    "str_validate_limits",
    f"SELECT doc_id, {SANITISE_SQL.format('text', 64)} AS text, "
    "least(greatest(CAST(n_chars AS DOUBLE), 100), 5000) AS n_chars, lang FROM documents",
)
def _(r: Retail) -> DataFrame:
    limits = {"text": {"max_len": 64}, "n_chars": {"min": 100, "max": 5000}, "absent": {"min": 0}}
    return X.apply_limits(r.raw("documents").select("doc_id", "text", "n_chars", "lang"), limits)


@query(
    "str_prediction_id",
    f"SELECT {GRAIN}, store_nbr || '-' || family || '-' || strftime(date, '%Y-%m-%d') AS id FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    key = X.prediction_id(F.col("store_nbr"), F.col("family"), F.col(DAY))
    return r.sales().select("store_nbr", "family", "date", key.alias("id"))


@query(
    "str_char_hash",
    "SELECT p_partkey, CAST(list_sum(list_transform(string_split(p_name, ''), lambda c: ascii(c))) % 100 AS INTEGER) "
    "AS score FROM part",
)
def _(r: Retail) -> DataFrame:
    return r.raw("part").select("p_partkey", X.code_point_score(F.col("p_name")).alias("score"))


@query("sch_select_by_type", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
       "l_extendedprice, l_discount, l_tax FROM lineitem")
def _(r: Retail) -> DataFrame:
    lines = r.raw("lineitem")
    return lines.select(*N.numeric_columns(lines))


@query(
    "wx_defaults",
    f"""SELECT {GRAIN}, coalesce(w.temperature, 25) AS temperature, coalesce(w.precipitation, 0) AS precipitation,
       CAST(70 AS DOUBLE) AS humidity
FROM t_sales LEFT JOIN (SELECT store_nbr, date, CAST(transactions AS DOUBLE) AS temperature,
       CASE WHEN transactions > 1 THEN 1.5::DOUBLE END AS precipitation FROM t_trans) w USING (store_nbr, date)""",
)
def _(r: Retail) -> DataFrame:
    """A weather table that knows some store days only; here it is made from transactions."""
    n = F.col("transactions")
    weather = r.transactions().select(
        "store_nbr", "date", n.cast("double").alias("temperature"),
        F.when(n > 1, 1.5).alias("precipitation"), F.lit(None).cast("double").alias("humidity"),
    )
    return B.join_weather(r.sales().select("store_nbr", "family", "date"), weather)


