"""Queries on dates, contracts, windows and the baseline."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import EVENT_DATE, TableContract
from tidemark.functions import dates as d
from tidemark.functions.values import to_number
from tidemark.operators.quality import date_coverage, join_report, key_uniqueness, validate_table
from tidemark.operators.scoring import Scorer, predict_input, score
from tidemark.operators.windows import fixed_bounds, test_window, window_rows, with_event_date
from tidemark.plans.baseline import build_baseline
from tidemark.queries import views as v
from tidemark.queries.catalog import query
from tidemark.session import scratch_path
from tidemark.sources.tables import feature_list, load_table, sample_input, write_replacing


@query("date_parts", "SELECT po, event_date FROM f_dated", "f_dated")
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = [F.col(c) for c in v.CONTRACT.date_parts]
    return v.features(spark, sf).select("po", d.date_from_parts(*parts).alias("event_date"))


@query(
    "date_packed",
    "SELECT po, CAST(try_strptime(CAST(packed AS VARCHAR), '%Y%m%d') AS DATE) AS event_date FROM f_dates",
    "f_dates",
)
def date_packed(spark: SparkSession, sf: str) -> DataFrame:
    return v.dates(spark, sf).select("po", d.date_from_packed(F.col("packed")).alias("event_date"))


@query("date_epoch_days", "SELECT po, DATE '1970-01-01' + epoch_days AS event_date FROM f_dates", "f_dates")
def date_epoch_days(spark: SparkSession, sf: str) -> DataFrame:
    return v.dates(spark, sf).select("po", d.date_from_epoch_days(F.col("epoch_days")).alias("event_date"))


@query(
    "date_epoch_seconds",
    "SELECT po, CAST(make_timestamp(CAST(epoch_seconds * 1000000 AS BIGINT)) AS DATE) AS event_date FROM f_dates",
    "f_dates",
)
def date_epoch_seconds(spark: SparkSession, sf: str) -> DataFrame:
    return v.dates(spark, sf).select("po", d.date_from_epoch_seconds(F.col("epoch_seconds")).alias("event_date"))


@query("date_string", "SELECT po, CAST(try_strptime(text_date, '%d/%m/%Y') AS DATE) AS event_date FROM f_dates", "f_dates")
def date_string(spark: SparkSession, sf: str) -> DataFrame:
    return v.dates(spark, sf).select("po", d.date_from_text(F.col("text_date"), "dd/MM/yyyy").alias("event_date"))


@query("date_cast", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date FROM orders")
def date_cast(spark: SparkSession, sf: str) -> DataFrame:
    contract = TableContract("orders", "baseline", date_col="o_orderdate")
    return v.table(spark, sf, "orders").select("o_orderkey", d.event_date(contract).alias("event_date"))


@query("event_date", "SELECT po, event_date FROM f_valid", "f_valid")
def event_date(spark: SparkSession, sf: str) -> DataFrame:
    return with_event_date(v.features(spark, sf), v.CONTRACT).select("po", F.col(EVENT_DATE).alias("event_date"))


@query(
    "date_coverage",
    "SELECT count(*) AS total, count(event_date) AS dated, count(*) FILTER (event_date >= DATE '1990-01-01') AS kept, "
    "count(*) - count(*) FILTER (event_date >= DATE '1990-01-01') AS dropped FROM f_dated",
    "f_dated",
)
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return date_coverage(v.features(spark, sf), v.CONTRACT)


@query(
    "validation_report",
    "SELECT 'feature_columns' AS \"check\", 'ok' AS level, '' AS detail UNION ALL SELECT 'actual_columns', 'ok', '' "
    "UNION ALL SELECT 'excluded_column', 'warning', 'supplier_code' "
    "UNION ALL SELECT 'date_resolves', CASE WHEN count(event_date) > 0 THEN 'ok' ELSE 'error' END, count(event_date) || '/' || count(*) FROM f_dated "
    "UNION ALL SELECT 'date_coverage', CASE WHEN count(*) FILTER (event_date >= DATE '1990-01-01') > 0 THEN 'ok' ELSE 'error' END, "
    "count(*) FILTER (event_date >= DATE '1990-01-01') || '/' || count(*) FROM f_dated",
    "f_dated",
)
def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    contract = TableContract(**{**vars(v.CONTRACT), "exclude_from_features": ("po", "supplier_code")})
    return validate_table(v.features(spark, sf), v.actuals(spark, sf), contract)


@query(
    "key_uniqueness",
    "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, max(n) AS max_per_key, sum(n) = count(*) AS is_unique "
    "FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)",
)
def uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return key_uniqueness(v.table(spark, sf, "lineitem"), ["l_orderkey"])


@query("test_window", "SELECT start_date, end_date FROM f_window", "f_window")
def window(spark: SparkSession, sf: str) -> DataFrame:
    return test_window(v.features(spark, sf), v.CONTRACT)


def _window_rows(spark: SparkSession, sf: str) -> DataFrame:
    features = v.features(spark, sf)
    return window_rows(features, v.CONTRACT, fixed_bounds(test_window(features, v.CONTRACT), "orders"))


@query("test_window_rows", "SELECT po, event_date FROM f_window_rows", "f_window_rows")
def test_window_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _window_rows(spark, sf).select("po", F.col(EVENT_DATE).alias("event_date"))


@query("predict_input", "SELECT * EXCLUDE (po, event_date) FROM f_window_rows", "f_window_rows")
def model_columns(spark: SparkSession, sf: str) -> DataFrame:
    return predict_input(_window_rows(spark, sf), v.CONTRACT)


@query("sample_input", "SELECT * EXCLUDE (po, event_date) FROM f_valid ORDER BY po LIMIT 5", "f_valid")
def sample(spark: SparkSession, sf: str) -> DataFrame:
    return sample_input(v.features(spark, sf), v.CONTRACT)


_FEATURE_NAMES = ["req_year", "req_month", "req_day", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


@query(
    "feature_list",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS feature, count({c}) AS n_present FROM f_training" for i, c in enumerate(_FEATURE_NAMES)
    ),
    "f_training",
)
def features_present(spark: SparkSession, sf: str) -> DataFrame:
    return feature_list(v.training(spark, sf), ["po", "total_cost"])


@query("coerce_numeric", "SELECT po, TRY_CAST(trim(min_order_text) AS DOUBLE) AS min_order FROM f_dates", "f_dates")
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return v.dates(spark, sf).select("po", to_number(F.col("min_order_text")).alias("min_order"))


def _line_scorer(spark: SparkSession, sf: str) -> Scorer:
    """The line as a column: its two coefficients enter as scalar subqueries."""
    line = v.line(spark, sf)
    return Scorer(expression=line.select("slope").scalar() * F.col("o_totalprice") + line.select("intercept").scalar())


_SCORED_SQL = "SELECT po, slope * o_totalprice + intercept AS prediction FROM f_window_rows CROSS JOIN f_line"


@query("score_window", _SCORED_SQL, "f_window_rows f_line")
def score_window(spark: SparkSession, sf: str) -> DataFrame:
    scored = score(_window_rows(spark, sf), _line_scorer(spark, sf), v.CONTRACT)
    return scored.select("po", "prediction")


@query("score_window_udf", _SCORED_SQL, "f_window_rows f_line")
def score_window_udf(spark: SparkSession, sf: str) -> DataFrame:
    line = v.line(spark, sf).first()
    slope, intercept = line.slope, line.intercept
    model = Scorer(predict=lambda batch: slope * batch["o_totalprice"] + intercept)
    scored = score(_window_rows(spark, sf), model, v.CONTRACT)
    return scored.select("po", "prediction")


def _baseline(spark: SparkSession, sf: str, with_actuals: bool = True) -> DataFrame:
    actuals = v.actuals(spark, sf) if with_actuals else None
    return build_baseline(
        v.features(spark, sf), actuals, _line_scorer(spark, sf), v.CONTRACT, "main.ops.cost", 3,
        scored_at=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc),
    )


def _comparable(baseline: DataFrame) -> DataFrame:
    """The baseline without its clock column; dates and floats in the oracle's types."""
    return baseline.drop("prediction_timestamp").withColumns(
        {
            "event_date": F.col("event_date").cast("date"),
            "prediction_final": F.col("prediction_final").cast("double"),
            "label": F.col("label").cast("double"),
        }
    )


_BASELINE_SQL = "SELECT * REPLACE (CAST(prediction_final AS DOUBLE) AS prediction_final, CAST(label AS DOUBLE) AS label) FROM f_baseline"


@query("baseline", _BASELINE_SQL, "f_baseline")
def baseline(spark: SparkSession, sf: str) -> DataFrame:
    return _comparable(_baseline(spark, sf))


@query(
    "baseline_without_actuals",
    "SELECT w.*, CAST(CAST(slope * o_totalprice + intercept AS FLOAT) AS DOUBLE) AS prediction_final, '3' AS model_version, "
    "'main.ops.cost' AS model_name, CAST(NULL AS DOUBLE) AS label FROM f_window_rows w CROSS JOIN f_line",
    "f_window_rows f_line",
)
def baseline_without_actuals(spark: SparkSession, sf: str) -> DataFrame:
    return _comparable(_baseline(spark, sf, with_actuals=False))


@query("baseline_roundtrip", _BASELINE_SQL, "f_baseline")
def baseline_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_path(spark, "baseline")
    write_replacing(_baseline(spark, sf), target)
    return _comparable(load_table(spark, target))


@query(
    "join_report",
    "SELECT *, CASE WHEN n_after <> n_before OR n_matched = 0 THEN 'warning' ELSE 'ok' END AS level FROM "
    "(SELECT (SELECT count(*) FROM f_window_rows) AS n_before, count(*) AS n_after, count(label) AS n_matched FROM f_baseline)",
    "f_baseline",
)
def report_join(spark: SparkSession, sf: str) -> DataFrame:
    return join_report(_baseline(spark, sf), _window_rows(spark, sf), "label")


_STAGES_SQL = """
SELECT pipeline, stage, status, detail FROM (
  SELECT '{name}' AS pipeline, 'validation' AS stage, 'ok' AS status, kept || '/' || total AS detail FROM
    (SELECT count(*) AS total, count(*) FILTER (event_date >= DATE '{first}') AS kept FROM f_dated)
  UNION ALL SELECT '{name}', 'window', 'ok', CAST(s AS VARCHAR) || '..' || CAST(e AS VARCHAR) FROM
    (SELECT CAST(max(event_date) - INTERVAL {months} MONTH AS DATE) AS s, max(event_date) AS e FROM f_dated)
  UNION ALL SELECT '{name}', 'baseline', 'ok', count(*) || ' rows, ' || count(a.po) || ' with actuals' FROM f_dated d
    LEFT JOIN f_actuals a ON a.po = d.po
    WHERE event_date BETWEEN (SELECT CAST(max(event_date) - INTERVAL {months} MONTH AS DATE) FROM f_dated) AND (SELECT max(event_date) FROM f_dated)
)"""


@query(
    "stage_results",
    _STAGES_SQL.format(name="cost", first="1990-01-01", months=2) + " UNION ALL "
    + _STAGES_SQL.format(name="delay", first="2000-01-01", months=3),
    "f_dated f_actuals",
)
def stage_results(spark: SparkSession, sf: str) -> DataFrame:
    """What the table stages of two use cases come to, without writing anything."""
    features, actuals, scorer = v.features(spark, sf), v.actuals(spark, sf), _line_scorer(spark, sf)
    out = None
    for name, contract in (("cost", v.CONTRACT), ("delay", TableContract(**{**vars(v.TRAINING), "test_months": 3}))):
        checked = validate_table(features, actuals, contract).filter("check = 'date_coverage'")
        bounds = test_window(features, contract)
        built = build_baseline(features, actuals, scorer, contract, name, 1, bounds)
        counted = built.agg(F.format_string("%d rows, %d with actuals", F.count(F.lit(1)), F.count("label")).alias("detail"))
        ends = F.concat_ws("..", F.col("start_date").cast("string"), F.col("end_date").cast("string"))
        for stage, level, frame in (
            ("validation", F.col("level"), checked),
            ("window", F.lit("ok"), bounds.select(ends.alias("detail"))),
            ("baseline", F.lit("ok"), counted),
        ):
            row = frame.select(F.lit(name).alias("pipeline"), F.lit(stage).alias("stage"), level.alias("status"), "detail")
            out = row if out is None else out.unionByName(row)
    return out
