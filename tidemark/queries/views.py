"""Stand-in inputs derived from the given tables: once as DataFrames, once as SQL views.

Orders play the feature table, lineitem the actuals, events the tracked runs, parts the model files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.contract import TableContract
from tidemark.operators.scan import newest
from tidemark.operators.training import fit_lines, training_set

CONTRACT = TableContract(
    feature_table="features",
    actual_table="actuals",
    baseline_table="baseline",
    date_kind="parts",
    date_parts=("req_year", "req_month", "req_day"),
    min_valid_date="1990-01-01",
    join_keys=("po",),
    label_col="label",
    test_months=2,
    exclude_from_features=("po",),
)
TRAINING = TableContract(**{**vars(CONTRACT), "min_valid_date": "2000-01-01"})
REGISTERED_AT = "2024-02-01 00:00:00"
STAMPED = "^rmse_val_"

# Select lists that mean the same in Spark SQL and in the oracle's dialect.
FEATURES = [
    "o_orderkey AS po",
    "CAST(CASE WHEN o_orderkey % 50 = 0 THEN 1900 ELSE year(o_orderdate) END AS INT) AS req_year",
    "CAST(CASE WHEN o_orderkey % 50 = 0 THEN 1 WHEN o_orderkey % 97 = 0 THEN 2 ELSE month(o_orderdate) END AS INT) AS req_month",
    "CAST(CASE WHEN o_orderkey % 50 = 0 THEN 1 WHEN o_orderkey % 97 = 0 THEN 30 WHEN o_orderkey % 101 = 0 THEN NULL "
    "ELSE day(o_orderdate) END AS INT) AS req_day",
    "o_custkey",
    "o_totalprice",
    "o_orderstatus",
    "o_orderpriority",
]
DATES = [
    "o_orderkey AS po",
    "CAST(CASE WHEN o_orderkey % 97 = 0 THEN 20240230 WHEN o_orderkey % 89 = 0 THEN 0 "
    "ELSE year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) END AS INT) AS packed",
    "CASE WHEN o_orderkey % 7 = 0 THEN 'x' WHEN o_orderkey % 11 = 0 THEN NULL "
    "WHEN o_orderkey % 13 = 0 THEN concat(' ', CAST(o_totalprice AS STRING)) ELSE CAST(o_totalprice AS STRING) END AS min_order_text",
]
SCORED = [
    "l_returnflag",
    "l_linestatus",
    "CASE WHEN l_orderkey % 40 = 0 THEN 0e0 ELSE l_extendedprice END AS y",
    "CASE WHEN l_orderkey % 80 = 0 THEN 0e0 ELSE l_quantity * 1500 END AS p",
]
RUNS = [
    "CAST(event_id AS STRING) AS run_id",
    "concat('/exp/', event_type) AS experiment",
    "CASE WHEN event_id % 4 <> 0 THEN CAST(event_id - event_id % 4 AS STRING) END AS parent_run_id",
    "ts AS start_time",
]
CANDIDATES = ["concat('m', CAST(user_id AS STRING)) AS model_name", "user_id", "CAST(event_id AS STRING) AS run_id",
              "ts AS arrived", "event_id", "value"]
COMPARISONS = [
    "event_id",
    "value AS new_value",
    "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 0e0 WHEN 2 THEN -1.01e0 * value WHEN 3 THEN value ELSE 1.1e0 * value END AS champion_value",
    "CASE WHEN event_id % 2 = 0 THEN 'minimize' ELSE 'maximize' END AS direction",
    "CASE event_id % 3 WHEN 0 THEN 0e0 WHEN 1 THEN 2e-2 ELSE 5e-1 END AS threshold",
]
ARTIFACTS = [
    "p_partkey",
    "concat('/models/m', CAST(p_partkey AS STRING), CASE p_partkey % 13 WHEN 0 THEN '.pkl' WHEN 1 THEN '.pickle' "
    "WHEN 2 THEN '.joblib' WHEN 3 THEN '.ubj' WHEN 4 THEN '.json' WHEN 5 THEN '.bst' WHEN 6 THEN '.model' WHEN 7 THEN '.cb' "
    "WHEN 8 THEN '.cbm' WHEN 9 THEN '.txt' WHEN 10 THEN '.CBM' WHEN 11 THEN '.onnx' ELSE '' END) AS path",
    "CASE WHEN p_partkey % 29 = 0 THEN 'joblib' WHEN p_partkey % 31 = 0 THEN 'coreml' END AS format",
    "p_retailprice",
    "p_brand",
]
EXPERIMENTS = ["concat('/exp/', event_type, '/u', CAST(user_id AS STRING), CASE WHEN user_id % 2 = 0 THEN '/' ELSE '' END) AS experiment"]
WANTED = [
    "concat('/exp/', CASE WHEN user_id % 11 = 0 THEN 'none' ELSE event_type END, '/u', CAST(user_id AS STRING), "
    "CASE WHEN user_id % 3 = 0 THEN '/' ELSE '' END) AS wanted"
]
SPECS = [
    "concat('spec', CAST(user_id AS STRING)) AS spec",
    "concat('m', CAST(user_id AS STRING)) AS model_name",
    "CASE user_id % 3 WHEN 0 THEN 'experiment' WHEN 1 THEN 'run' ELSE 'file' END AS source",
    "CASE WHEN user_id % 3 <> 0 THEN NULL WHEN user_id % 30 = 3 THEN '/exp/none' "
    "WHEN user_id % 2 = 0 THEN concat('/exp/', max(event_type), '/') ELSE concat('/exp/', min(event_type)) END AS experiment",
    "CASE WHEN user_id % 3 <> 1 THEN NULL WHEN user_id % 30 = 1 THEN 'missing' ELSE CAST(max(event_id) AS STRING) END AS run_id",
    "CASE WHEN user_id % 3 = 2 THEN concat('/models/m', CAST(user_id AS STRING), CASE user_id % 4 WHEN 0 THEN '.cbm' "
    "WHEN 1 THEN '.onnx' WHEN 2 THEN '.txt' ELSE '.ubj' END) END AS model_path",
    "CAST(NULL AS STRING) AS model_format",
    "CASE WHEN user_id % 3 = 2 THEN 'claimed_rmse' WHEN user_id % 6 = 3 THEN 'test_rmse' WHEN user_id % 12 = 1 THEN 'test_rmse' END AS metric",
    "CASE WHEN user_id % 6 = 0 OR user_id % 3 = 1 THEN '^rmse_val_' END AS metric_pattern",
    "CASE WHEN user_id % 4 = 0 THEN 'first' ELSE 'latest' END AS metric_select",
    "CASE WHEN user_id % 5 = 0 THEN 'maximize' ELSE 'minimize' END AS metric_direction",
    "CASE WHEN user_id % 4 = 0 THEN 2e-2 ELSE 0e0 END AS improvement_threshold",
    "CAST(20 + user_id % 7 * 40 AS INT) AS search_max_results",
    "min(value) AS claimed",
]
TRIAL_SCORES = [
    "concat('c', CAST(o_custkey AS STRING)) AS model_name",
    "o_orderkey AS trial_no",
]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once per process, not once per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def instant(utc: Column) -> Column:
    """The point in time a zoneless UTC clock value means."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")


def registered_at() -> Column:
    return F.lit(f"{REGISTERED_AT} UTC").cast("timestamp")


def features(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*FEATURES)


def actuals(spark: SparkSession, sf: str) -> DataFrame:
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("po")).agg(revenue.alias("label"))


def dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    text = F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy")
    return orders.selectExpr("*", *DATES).select(
        "po", "packed", "min_order_text",
        day.alias("epoch_days"),
        (day.cast("long") * 86400 + F.col("po") % 86400).alias("epoch_seconds"),
        F.when(F.col("po") % 83 == 0, "n/a").otherwise(text).alias("text_date"),
    )


def training(spark: SparkSession, sf: str) -> DataFrame:
    """Joined training rows with the renamed target."""
    return training_set(features(spark, sf), actuals(spark, sf), CONTRACT, "total_cost")


def line(spark: SparkSession, sf: str) -> DataFrame:
    """The stand-in champion: one line from total price to cost, as a one-row frame."""
    return line_of(features(spark, sf), actuals(spark, sf))


def line_of(features: DataFrame, actuals: DataFrame) -> DataFrame:
    """The same from the two tables as they are stored elsewhere."""
    return rounded_line(fit_lines(training_set(features, actuals, CONTRACT, "total_cost"), "o_totalprice", "total_cost"))


def rounded_line(lines: DataFrame) -> DataFrame:
    """Coefficients as the SQL twins round them."""
    return lines.withColumns({"slope": F.round("slope", 6), "intercept": F.round("intercept", 2)})


def runs(spark: SparkSession, sf: str) -> DataFrame:
    tags = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("model_type"), F.col("event_type"))).otherwise(
        F.create_map(F.lit("model_name"), F.col("event_type"))
    )
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    events = table(spark, sf, "events").selectExpr(*RUNS, "event_id", "event_type")
    return events.select(
        "run_id", "experiment", "parent_run_id", instant(F.col("start_time")).alias("start_time"),
        none.alias("params"), tags.alias("tags"),
    )


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Up to five metric rows per event, from one pass."""
    day = F.col("ts").cast("date")
    ends = {n: F.date_add(day, n).cast("string").alias(f"d{n}") for n in (-28, 0, 28, 56)}
    events = table(spark, sf, "events").select("event_id", "value", *ends.values())
    event, value = F.col("event_id"), F.col("value")

    def stamped(prefix: str, start: int) -> Column:
        return F.concat(F.lit(prefix), F.col(f"`d{start}`"), F.lit("_"), F.col(f"`d{start + 56}`"))

    def entry(key: Column, amount: Column) -> Column:
        return F.struct(key.alias("key"), amount.alias("value"))

    entries = F.array(
        F.when(event % 5 != 0, entry(stamped("rmse_val_", 0), value)),
        F.when(event % 3 == 0, entry(stamped("rmse_val_", -28), value * 1.1)),
        entry(stamped("wmape_val_", 0), value / 10),
        F.when(event % 4 == 0, entry(stamped("best_rmse_val_", 0), value)),
        F.when(event % 2 == 0, entry(F.lit("test_rmse"), value)),
    )
    listed = events.select(event.cast("string").alias("run_id"), F.explode(entries).alias("m")).filter("m IS NOT NULL")
    return listed.select("run_id", "m.key", F.lit(0).alias("step"), "m.value")


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(*CANDIDATES)


def versions(spark: SparkSession, sf: str) -> DataFrame:
    some = candidates(spark, sf).filter("user_id % 3 <> 0")
    ranked = newest(some, ["model_name"], [F.col("arrived"), F.col("event_id")], 2, "version")
    return ranked.select(
        "model_name", "version", "run_id", F.lit(None).cast("string").alias("description"),
        instant(F.col("arrived")).alias("created_at"),
    )


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    users = candidates(spark, sf).filter("user_id % 3 = 1").select("model_name", "user_id").distinct()
    held = F.array(
        F.struct(F.lit("champion").alias("alias"), F.lit(1).alias("version")),
        F.when(F.col("user_id") % 2 == 0, F.struct(F.lit("challenger").alias("alias"), F.lit(2).alias("version"))),
    )
    return users.select("model_name", F.inline(F.filter(held, lambda h: h.isNotNull())))


def latest_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """One candidate per model: its newest run, or for every seventh model its oldest."""
    place = F.struct("arrived", "event_id", "run_id")
    picked = candidates(spark, sf).groupBy("model_name", "user_id").agg(F.max(place).alias("new"), F.min(place).alias("old"))
    return picked.select(
        "model_name",
        F.when(F.col("user_id") % 7 == 0, F.col("old.run_id")).otherwise(F.col("new.run_id")).alias("run_id"),
        F.lit(None).cast("string").alias("metric"),
        F.lit(STAMPED).alias("metric_pattern"),
        F.lit("latest").alias("metric_select"),
        F.lit("minimize").alias("metric_direction"),
        F.lit(0.02).alias("improvement_threshold"),
    )


def specs(spark: SparkSession, sf: str) -> DataFrame:
    """One registration spec per user."""
    events = table(spark, sf, "events")
    listed = spark.sql(f"SELECT {', '.join(SPECS)} FROM {{events}} GROUP BY user_id", events=events)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    claimed = F.when(F.col("source") == "file", F.create_map(F.lit("claimed_rmse"), F.col("claimed")))
    return listed.select("*", claimed.alias("metrics"), none.alias("params"), none.alias("tags")).drop("claimed")


def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*ARTIFACTS)


def space(spark: SparkSession, sf: str) -> DataFrame:
    """A parameter space per supplier, with ranges taken from its lines."""
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_quantity").alias("q0"), F.max("l_quantity").alias("q1"),
        F.min("l_discount").alias("d0"), F.max("l_discount").alias("d1"),
        F.min("l_extendedprice").alias("e0"), F.max("l_extendedprice").alias("e1"),
    )

    def entry(param: str, kind: str, low: Column, high: Column, log: bool, fixed: str | None, choices: list[str]) -> Column:
        return F.struct(
            F.lit(param).alias("param"), F.lit(kind).alias("kind"), low.cast("double").alias("low"),
            high.cast("double").alias("high"), F.lit(log).alias("log"), F.lit(fixed).cast("string").alias("fixed"),
            F.array(*[F.lit(c) for c in choices]).cast("array<string>").alias("choices"),
        )

    no = F.lit(None)
    entries = F.array(
        entry("depth", "int", F.col("q0"), F.col("q1"), False, None, []),
        entry("subsample", "float", F.col("d0"), F.col("d1"), False, None, []),
        entry("rate", "float", F.col("e0") / 1e6, F.col("e1") / 1e6, True, None, []),
        entry("loss", "categorical", no, no, False, None, ["squared", "absolute", "huber"]),
        entry("seed", "fixed", no, no, False, "42", []),
    )
    return lines.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("model_name"), F.inline(entries))


def trial_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Two steps per trial: every order is a trial of its customer's model."""
    orders = table(spark, sf, "orders")
    steps = F.array(
        F.struct(F.lit(0).alias("step"), F.col("o_totalprice").alias("value")),
        F.struct(F.lit(1).alias("step"), (F.col("o_totalprice") * (1 + (F.col("o_orderkey") % 7 - 3) / 10.0)).alias("value")),
    )
    return orders.selectExpr("*", *TRIAL_SCORES).select("model_name", "trial_no", F.inline(steps))


def _select(columns: list[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


_DATED = (
    "CASE WHEN req_year BETWEEN 1000 AND 9999 AND req_month IS NOT NULL AND req_day IS NOT NULL "
    "THEN TRY_CAST(printf('%04d-%02d-%02d', req_year, req_month, req_day) AS DATE) END"
)
_STAMP = "'{0}' || CAST(CAST(ts AS DATE) + {1} AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) + {2} AS VARCHAR)"

# View name -> (views it reads, SQL).
SQL: dict[str, tuple[str, str]] = {
    "f_features": ("", _select(FEATURES, "orders")),
    "f_actuals": ("", "SELECT l_orderkey AS po, sum(l_extendedprice * (1 - l_discount)) AS label FROM lineitem GROUP BY l_orderkey"),
    "f_dates": (
        "",
        f"SELECT {', '.join(DATES)}, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) AS epoch_days, "
        "date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 + o_orderkey % 86400 AS epoch_seconds, "
        "CASE WHEN o_orderkey % 83 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS text_date FROM orders",
    ),
    "f_scored": ("", _select(SCORED, "lineitem")),
    "f_dated": ("f_features", f"SELECT *, {_DATED} AS event_date FROM f_features"),
    "f_valid": ("f_dated", "SELECT * FROM f_dated WHERE event_date >= DATE '1990-01-01'"),
    "f_window": ("f_valid", "SELECT CAST(max(event_date) - INTERVAL 2 MONTH AS DATE) AS start_date, max(event_date) AS end_date FROM f_valid"),
    "f_window_rows": ("f_valid f_window", "SELECT v.* FROM f_valid v, f_window w WHERE event_date BETWEEN start_date AND end_date"),
    "f_training": ("f_dated f_actuals", "SELECT d.*, label AS total_cost FROM f_dated d JOIN f_actuals a ON d.po = a.po"),
    "f_line": (
        "f_training",
        "SELECT round(regr_slope(total_cost, o_totalprice), 6) AS slope, round(regr_intercept(total_cost, o_totalprice), 2) AS intercept FROM f_training",
    ),
    "f_train_dates": ("f_training", "SELECT *, event_date AS d FROM f_training WHERE event_date >= DATE '2000-01-01'"),
    "f_daily": ("f_train_dates", "SELECT d, count(*) AS n FROM f_train_dates GROUP BY d"),
    "f_anchors": (
        "f_daily",
        "SELECT a.d AS anchor, "
        "coalesce(sum(b.n) FILTER (b.d > a.d - 28 - 56 AND b.d <= a.d - 28), 0) AS n0, "
        "coalesce(sum(b.n) FILTER (b.d > a.d - 56 AND b.d <= a.d), 0) AS n1 "
        "FROM f_daily a JOIN f_daily b ON b.d > a.d - 84 AND b.d <= a.d GROUP BY a.d",
    ),
    "f_anchor": ("f_anchors", "SELECT * FROM f_anchors WHERE least(n0, n1) >= 50 ORDER BY anchor DESC LIMIT 1"),
    "f_span": (
        "f_train_dates f_anchor",
        "SELECT min(d) AS train_start, max(d) AS newest FROM f_train_dates WHERE d <= (SELECT anchor FROM f_anchor)",
    ),
    "f_splits": (
        "f_span",
        "SELECT split_no, 'val_' || CAST(test_start AS VARCHAR) || '_' || CAST(test_end AS VARCHAR) AS split_name, train_start, "
        "test_start AS train_end, test_start, test_end, CASE split_no WHEN 0 THEN 0.3e0 / 1.3e0 ELSE 1e0 / 1.3e0 END AS weight FROM ("
        "SELECT CAST(i AS INT) AS split_no, train_start, newest - CAST((1 - i) * 28 AS INT) + 1 AS test_end, "
        "newest - CAST((1 - i) * 28 AS INT) + 1 - 56 AS test_start FROM f_span, range(2) t(i) WHERE newest IS NOT NULL)",
    ),
    "f_split_rows": (
        "f_train_dates f_splits",
        "SELECT r.*, split_no, split_name, weight, CASE WHEN d < train_end THEN 'train' ELSE 'test' END AS role "
        "FROM f_train_dates r JOIN f_splits s ON d >= train_start AND d < test_end",
    ),
    "f_lines": (
        "f_split_rows",
        "SELECT split_no, round(regr_slope(total_cost, o_totalprice), 6) AS slope, round(regr_intercept(total_cost, o_totalprice), 2) AS intercept "
        "FROM f_split_rows WHERE role = 'train' GROUP BY split_no",
    ),
    "f_tested": (
        "f_split_rows f_lines",
        "SELECT r.*, total_cost AS y, slope * o_totalprice + intercept AS p FROM f_split_rows r JOIN f_lines l USING (split_no) WHERE role = 'test'",
    ),
    "f_split_metrics": ("f_tested", "SELECT split_no, split_name, weight, {metrics} FROM f_tested GROUP BY split_no, split_name, weight"),
    "f_baseline": (
        "f_window_rows f_line f_actuals",
        "SELECT w.* EXCLUDE (event_date), event_date, CAST(slope * o_totalprice + intercept AS FLOAT) AS prediction_final, '3' AS model_version, "
        "'main.ops.cost' AS model_name, CAST(label AS FLOAT) AS label FROM f_window_rows w CROSS JOIN f_line "
        "LEFT JOIN f_actuals a ON w.po IS NOT DISTINCT FROM a.po",
    ),
    "f_runs": ("", f"SELECT {', '.join(RUNS)}, event_id, event_type FROM events"),
    "f_run_metrics": (
        "",
        " UNION ALL ".join([
            f"SELECT CAST(event_id AS VARCHAR) AS run_id, {_STAMP.format('rmse_val_', 0, 56)} AS key, value FROM events WHERE event_id % 5 <> 0",
            f"SELECT CAST(event_id AS VARCHAR), {_STAMP.format('rmse_val_', -28, 28)}, value * 1.1e0 FROM events WHERE event_id % 3 = 0",
            f"SELECT CAST(event_id AS VARCHAR), {_STAMP.format('wmape_val_', 0, 56)}, value / 10 FROM events",
            f"SELECT CAST(event_id AS VARCHAR), {_STAMP.format('best_rmse_val_', 0, 56)}, value FROM events WHERE event_id % 4 = 0",
            "SELECT CAST(event_id AS VARCHAR), 'test_rmse', value FROM events WHERE event_id % 2 = 0",
        ]),
    ),
    "f_stamped": (
        "f_run_metrics",
        "SELECT run_id, max(key) AS resolved_key, arg_max(value, key) AS value, min(key) AS first_key, arg_min(value, key) AS first_value "
        "FROM f_run_metrics WHERE regexp_matches(key, '^rmse_val_') GROUP BY run_id",
    ),
    "f_candidates": ("", _select(CANDIDATES, "events")),
    "f_versions": (
        "f_candidates",
        "SELECT model_name, CAST(rn AS INT) AS version, run_id, arrived AS created_at FROM (SELECT *, row_number() OVER (PARTITION BY model_name "
        "ORDER BY arrived, event_id) AS rn FROM f_candidates WHERE user_id % 3 <> 0) WHERE rn <= 2",
    ),
    "f_aliases": (
        "f_candidates",
        "SELECT DISTINCT model_name, 'champion' AS alias, 1 AS version FROM f_candidates WHERE user_id % 3 = 1 UNION ALL "
        "SELECT DISTINCT model_name, 'challenger', 2 FROM f_candidates WHERE user_id % 3 = 1 AND user_id % 2 = 0",
    ),
    "f_latest": (
        "f_candidates f_stamped",
        "SELECT c.*, resolved_key, value FROM (SELECT model_name, CASE WHEN user_id % 7 = 0 THEN arg_min(run_id, arrived) ELSE arg_max(run_id, arrived) END "
        "AS run_id FROM f_candidates GROUP BY model_name, user_id) c LEFT JOIN f_stamped USING (run_id)",
    ),
    "f_champions": (
        "f_latest f_aliases f_versions f_stamped",
        "SELECT c.*, v.version AS champion_version, v.run_id AS champion_run_id, s.resolved_key AS champion_key, s.value AS champion_value "
        "FROM f_latest c LEFT JOIN (SELECT * FROM f_aliases WHERE alias = 'champion') a ON a.model_name = c.model_name "
        "LEFT JOIN f_versions v ON v.model_name = a.model_name AND v.version = a.version LEFT JOIN f_stamped s ON s.run_id = v.run_id",
    ),
    "f_decisions": (
        "f_champions f_versions",
        "SELECT *, CASE WHEN scenario IN ('first_registration', 'promoted', 'challenger') THEN CAST(max_version + 1 AS INT) END AS new_version FROM ("
        "SELECT c.*, coalesce(m.max_version, 0) AS max_version, CASE WHEN c.resolved_key IS NULL THEN 'error' "
        "WHEN EXISTS (SELECT 1 FROM f_versions v WHERE v.model_name = c.model_name AND v.run_id = c.run_id) THEN 'skipped_duplicate' "
        "WHEN champion_version IS NULL THEN 'first_registration' WHEN champion_value IS NULL THEN 'error' "
        "WHEN (champion_value - value) / abs(champion_value) >= 0.02e0 THEN 'promoted' ELSE 'challenger' END AS scenario "
        "FROM f_champions c LEFT JOIN (SELECT model_name, max(version) AS max_version FROM f_versions GROUP BY model_name) m USING (model_name))",
    ),
    "f_artifacts": ("", _select(ARTIFACTS, "part")),
    "f_formats": (
        "f_artifacts",
        "SELECT *, CASE resolved_format WHEN 'pickle' THEN 'sklearn' WHEN 'joblib' THEN 'sklearn' ELSE resolved_format END AS family FROM ("
        "SELECT *, CASE WHEN format = 'joblib' THEN 'joblib' WHEN format IS NOT NULL THEN NULL WHEN ext IN ('.pkl', '.pickle') THEN 'pickle' "
        "WHEN ext = '.joblib' THEN 'joblib' WHEN ext IN ('.ubj', '.json', '.bst', '.model') THEN 'xgboost' WHEN ext IN ('.cb', '.cbm') THEN 'catboost' "
        "WHEN ext = '.txt' THEN 'lightgbm' END AS resolved_format FROM (SELECT *, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS ext FROM f_artifacts))",
    ),
    "f_space": (
        "",
        "SELECT 's' || CAST(l_suppkey AS VARCHAR) AS model_name, unnest(['depth', 'subsample', 'rate', 'loss', 'seed']) AS param, "
        "unnest(['int', 'float', 'log', 'categorical', 'fixed']) AS kind, unnest([q0, d0, e0 / 1e6, NULL, NULL]) AS low, "
        "unnest([q1, d1, e1 / 1e6, NULL, NULL]) AS high FROM (SELECT l_suppkey, min(l_quantity) AS q0, max(l_quantity) AS q1, "
        "min(l_discount) AS d0, max(l_discount) AS d1, min(l_extendedprice) AS e0, max(l_extendedprice) AS e1 FROM lineitem GROUP BY l_suppkey)",
    ),
    "f_trial_scores": (
        "",
        f"SELECT {', '.join(TRIAL_SCORES)}, 0 AS step, o_totalprice AS value FROM orders UNION ALL "
        f"SELECT {', '.join(TRIAL_SCORES)}, 1, o_totalprice * (1 + (o_orderkey % 7 - 3) / 10e0) FROM orders",
    ),
}

METRIC_SQL = (
    "round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, "
    "round(100 * avg(CASE WHEN y <> 0 THEN abs(y - p) / abs(y) END), 6) AS mape, "
    "round(100 * sum(abs(y - p)) / nullif(sum(abs(y)), 0), 6) AS wmape, "
    "round(100 * avg(CASE WHEN abs(y) + abs(p) <> 0 THEN 2 * abs(y - p) / (abs(y) + abs(p)) END), 6) AS smape, "
    "round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2, count(*) AS n"
)
DIGITS = {"rmse": 4, "mae": 4, "mape": 6, "wmape": 6, "smape": 6, "r2": 6}


def rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({m: F.round(m, d) for m, d in DIGITS.items()})


def with_views(sql: str, names: list[str]) -> str:
    """A statement preceded by the views it needs, each after those it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in SQL[name][0].split():
                visit(other)
            order.append(name)

    for name in names:
        visit(name)
    text = {n: SQL[n][1].replace("{metrics}", METRIC_SQL) for n in order}
    head = ", ".join(f"{n} AS ({text[n]})" for n in order)
    body = sql.replace("{metrics}", METRIC_SQL)
    if not head:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head}, {body.lstrip()[len('WITH RECURSIVE'):].lstrip()}"
    if body.lstrip().startswith("WITH "):
        return f"WITH {head}, {body.lstrip()[len('WITH '):]}"
    return f"WITH {head} {body}"
