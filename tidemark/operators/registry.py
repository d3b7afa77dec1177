"""Champion and challenger decisions for all models at once.

``versions``: model_name, version, run_id, description, created_at. ``aliases``: model_name, alias,
version. ``version_tags``: model_name, version, key, value, one row per tag, so that a run with very
many metrics never has to fit into one map.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import four_decimals, is_better, minute_text, short_id, tag, utc_text
from tidemark.operators.runs import last_values, resolve_metric, resolve_metric_per_spec
from tidemark.operators.scan import BUCKET, Running, add_buckets, at_or_below, cut_points, running
from tidemark.session import materialise

# What can happen to a candidate.
FIRST, PROMOTED, CHALLENGER, SKIPPED = "first_registration", "promoted", "challenger", "skipped_duplicate"
ERROR = "error"


def already_registered(candidates: DataFrame, versions: DataFrame) -> DataFrame:
    """Candidates whose run is a version of their model already."""
    return candidates.join(versions.select("model_name", "run_id"), ["model_name", "run_id"], "left_semi")


def not_registered(candidates: DataFrame, versions: DataFrame) -> DataFrame:
    return candidates.join(versions.select("model_name", "run_id"), ["model_name", "run_id"], "left_anti")


def champion_lookup(
    candidates: DataFrame, aliases: DataFrame, versions: DataFrame, run_metrics: DataFrame
) -> DataFrame:
    """Add the model's champion to every candidate: version, run, resolved key and value.

    ``candidates`` carries metric, metric_pattern and metric_select; the champion's metric is resolved by
    them on its own run, because stamped keys differ from run to run. No champion gives NULLs.
    """
    champions = aliases.filter(F.col("alias") == "champion").select("model_name", "version")
    holders = champions.join(versions.select("model_name", "version", "run_id"), ["model_name", "version"])
    holders = holders.select(
        "model_name", F.col("version").alias("champion_version"), F.col("run_id").alias("champion_run_id")
    )
    # One row per candidate model. Stored, so that its size decides how the metrics are searched, and
    # joined to them the inner way, which never moves the large side while this one is small.
    known = materialise(candidates.join(holders, "model_name", "left"), "champions")
    asked = known.filter("champion_run_id IS NOT NULL").select(
        "model_name", F.col("champion_run_id").alias("run_id"), "metric", "metric_pattern", "metric_select"
    )
    resolved = resolve_metric_per_spec(asked.join(run_metrics, "run_id"), ["model_name"]).select(
        "model_name", F.col("resolved_key").alias("champion_key"), F.col("value").alias("champion_value")
    )
    return known.join(resolved, "model_name", "left")


def decide(candidates: DataFrame, versions: DataFrame) -> DataFrame:
    """Add the outcome of registering each candidate, and the version it gets.

    One candidate per model. ``candidates`` comes from ``champion_lookup`` and carries run_id,
    resolved_key, value, metric_direction, improvement_threshold and, where its run could not be
    resolved, ``error``. A champion without the metric is an error as well; one that logged it as no number
    is beaten by nobody.
    """
    own = versions.join(candidates.select("model_name"), "model_name", "left_semi")
    state = own.groupBy("model_name").agg(F.max("version").alias("_max_version"))
    taken = own.join(candidates.select("model_name", "run_id"), ["model_name", "run_id"], "left_semi")
    taken = taken.select("model_name", "run_id").distinct().withColumn("_taken", F.lit(True))
    known = candidates.join(state, "model_name", "left").join(taken, ["model_name", "run_id"], "left")

    beaten = is_better(F.col("value"), F.col("champion_value"), F.col("metric_direction"), F.col("improvement_threshold"))
    scenario = (
        F.when(F.col("error").isNotNull(), ERROR)
        .when(F.col("_taken"), SKIPPED)
        .when(F.col("champion_version").isNull(), FIRST)
        .when(F.col("champion_key").isNull(), ERROR)
        .when(F.col("champion_value").isNull(), CHALLENGER)
        .when(beaten, PROMOTED)
        .otherwise(CHALLENGER)
    )
    out = known.withColumn("scenario", scenario)
    error = F.when(
        F.col("error").isNull() & (F.col("scenario") == ERROR),
        F.concat(F.lit("champion run '"), "champion_run_id", F.lit("' has no metric for "), _wanted()),
    ).otherwise(F.col("error"))
    registered = F.col("scenario").isin(FIRST, PROMOTED, CHALLENGER)
    version = F.when(registered, F.coalesce("_max_version", F.lit(0)) + 1)
    return out.withColumns({"error": error, "new_version": version.cast("int")}).drop("_max_version", "_taken")


def _wanted() -> Column:
    pattern = F.concat(F.lit("pattern '"), F.col("metric_pattern"), F.lit("'"))
    return F.coalesce(F.col("metric"), pattern)


def versions_after(decisions: DataFrame, versions: DataFrame, registered_at: dt.datetime | Column) -> DataFrame:
    """The version table with the newly registered versions added."""
    when = registered_at if isinstance(registered_at, Column) else F.lit(registered_at)
    new = decisions.filter("new_version IS NOT NULL").withColumn("created_at", when.cast("timestamp"))
    new = new.select(
        "model_name", F.col("new_version").alias("version"), "run_id", description(F.col("created_at")).alias("description"), "created_at"
    )
    return versions.select(*new.columns).unionByName(new)


def description(registered_at: Column) -> Column:
    """The text kept with a version: headline, metric, time, the other version involved and the run."""
    at = F.concat(utc_text(registered_at), F.lit(" UTC"))
    result = F.concat("resolved_key", F.lit(" = "), four_decimals(F.col("value")))
    champion = F.col("champion_version").cast("string")
    # Headlines and field labels of the three texts.
    layouts = {
        FIRST: ("Production Champion Model", "Performance : ", "Registered  : ", None, "Run ID      : "),
        PROMOTED: (
            "Production Champion Model (Promoted)",
            "Performance     : ", "Promoted        : ", "Replaced version: ", "Run ID          : ",
        ),
        CHALLENGER: (
            "Challenger Model (Did not outperform Champion)",
            "Performance      : ", "Registered       : ", "Current Champion : Version ", "Run ID           : ",
        ),
    }
    text = F.lit(None).cast("string")
    for scenario, (headline, metric, time, other, run) in layouts.items():
        lines = [F.lit(headline), F.lit(""), F.concat(F.lit(metric), result), F.concat(F.lit(time), at)]
        if other:
            lines.append(F.concat(F.lit(other), champion))
        lines.append(F.concat(F.lit(run), "run_id"))
        text = F.when(F.col("scenario") == scenario, F.concat_ws("\n", *lines)).otherwise(text)
    return text


def aliases_after(decisions: DataFrame, aliases: DataFrame) -> DataFrame:
    """The alias table after the decisions.

    First registration: the new version is champion, a challenger stays. Promotion: new champion, and the
    old one is challenger in place of any other. Otherwise the new version replaces the challenger.
    """
    champion = F.struct(F.lit("champion").alias("alias"), F.col("new_version").alias("version"))
    demoted = F.struct(F.lit("challenger").alias("alias"), F.col("champion_version").cast("int").alias("version"))
    challenger = F.struct(F.lit("challenger").alias("alias"), F.col("new_version").alias("version"))
    moves = (
        F.when(F.col("scenario") == FIRST, F.array(champion))
        .when(F.col("scenario") == PROMOTED, F.array(champion, demoted))
        .when(F.col("scenario") == CHALLENGER, F.array(challenger))
    )
    moved = decisions.withColumn("_move", F.explode(moves)).select("model_name", "_move.*")
    kept = aliases.join(moved.select("model_name", "alias"), ["model_name", "alias"], "left_anti")
    return kept.select("model_name", "alias", "version").unionByName(moved)


def version_tags(
    decisions: DataFrame, runs: DataFrame, run_metrics: DataFrame, registered_at: dt.datetime | Column | None = None
) -> DataFrame:
    """Tags of the newly registered versions, one row each: all metrics of the run and the role tags.

    A role tag wins over a metric of the same name. Without ``registered_at`` the date tag is left out.
    """
    new = decisions.filter("new_version IS NOT NULL")
    tagged = runs.join(new.select("run_id"), "run_id", "left_semi").select("run_id", "tags")
    about = new.join(tagged, "run_id", "left")
    fields = {
        "model_type": tag(F.col("tags"), "model_type", "model_name"),
        "run_name": tag(F.col("tags"), "run_name", "mlflow.runName"),
        "role": F.when(F.col("scenario") == CHALLENGER, "challenger").otherwise("champion"),
        "promoted_from": F.when(F.col("scenario") == PROMOTED, "new_registration"),
        "replaced_version": F.when(F.col("scenario") == PROMOTED, F.col("champion_version").cast("string")),
        "current_champion_version": F.when(F.col("scenario") == CHALLENGER, F.col("champion_version").cast("string")),
    }
    if registered_at is not None:
        when = registered_at if isinstance(registered_at, Column) else F.lit(registered_at)
        fields["registered_date"] = F.concat(utc_text(when), F.lit(" UTC"))
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in fields.items()])
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    roles = about.select("model_name", F.col("new_version").alias("version"), F.inline(present))

    # A name is taken only where that scenario writes the tag.
    always = ["model_type", "run_name", "role"] + (["registered_date"] if registered_at is not None else [])
    taken = (
        F.col("key").isin(always)
        | (F.col("key").isin("promoted_from", "replaced_version") & (F.col("scenario") == PROMOTED))
        | ((F.col("key") == "current_champion_version") & (F.col("scenario") == CHALLENGER))
    )
    wanted = new.select("model_name", "new_version", "run_id", "scenario")
    # The value a version is tagged with is the one it was judged by.
    of_these = run_metrics.join(new.select("run_id").distinct(), "run_id", "left_semi")
    last = wanted.join(last_values(of_these), "run_id").filter(~taken).filter("value IS NOT NULL")
    metrics = last.select("model_name", F.col("new_version").alias("version"), "key", F.col("value").cast("string").alias("value"))
    return metrics.unionByName(roles)


def registration_results(decisions: DataFrame, catalog: str | None = None, schema: str | None = None) -> DataFrame:
    """One row per candidate with the eight result fields and an error text."""
    parts = [F.lit(p) for p in (catalog, schema) if p] + [F.col("model_name")]
    new = F.col("new_version").cast("string")
    scenario = F.col("scenario")
    failed = scenario == ERROR
    alias = (
        F.when(scenario == SKIPPED, "already_registered")
        .when(scenario.isin(FIRST, PROMOTED), "champion")
        .when(scenario == CHALLENGER, "challenger")
    )
    champion = F.when(scenario.isin(FIRST, PROMOTED), new).when(
        scenario == CHALLENGER, F.col("champion_version").cast("string")
    )
    return decisions.select(
        F.concat_ws(".", *parts).alias("registered_model_name"),
        F.when(~failed, F.coalesce(new, F.lit("N/A"))).alias("new_version"),
        alias.alias("new_alias"),
        F.when(~failed, F.coalesce(champion, F.lit("N/A"))).alias("champion_version"),
        "run_id",
        F.col("resolved_key").alias("metric"),
        F.col("value").alias("metric_value"),
        scenario.alias("scenario"),
        "error",
    )


def final_state(
    versions: DataFrame, run_metrics: DataFrame, metric: str | None = None, pattern: str | None = None,
    select: str = "latest",
) -> DataFrame:
    """All versions, newest first per model, with their metric as text, creation minute and short run id."""
    own = run_metrics.join(versions.select("run_id"), "run_id", "left_semi")
    shown = versions.join(resolve_metric(own, metric, pattern, select), "run_id", "left")
    return shown.select(
        "model_name",
        "version",
        four_decimals(F.col("value")).alias("metric_text"),
        minute_text(F.col("created_at")).alias("created"),
        short_id(F.col("run_id")).alias("short_run_id"),
    ).orderBy("model_name", F.col("version").desc())


def promotion_history(
    candidates: DataFrame, direction: str = "minimize", threshold: float = 0.0, streamed: int = 200_000
) -> DataFrame:
    """Replay registrations in arrival order: what happened to every candidate and who was champion after.

    ``candidates``: model_name, run_id, arrived, arrival_no (a number that breaks ties), value. Result: model_name, seq,
    run_id, scenario, champion_run. Nothing is registered before the first candidate.

    Only a candidate at least as good as everything before it can be promoted, because the bar is never
    easier than the best value so far. These record holders are found by a running minimum over ordered
    buckets, so a model that owns a large part of the table is still worked on by many tasks. With
    threshold 0 the records are the promotions. With a threshold the records of a model are folded in
    order, as a stream with one value of state. A model with more than ``streamed`` of them would keep
    one task busy; its promotions are found by links between records and jumps along them instead.
    """
    sign = 1.0 if direction == "minimize" else -1.0
    value = F.col("value").cast("double")
    at = F.unix_micros(F.col("arrived").cast("timestamp"))
    base = candidates.select(
        "model_name", "run_id", F.coalesce(at, F.lit(-(2**53))).alias("_at"), "arrival_no",
        F.when(~F.isnan(value), sign * value).alias("_v"),
    )
    # A run registers once: of its rows with a value only the first counts. Runs that come up more than
    # once are few as a rule; stored, their true size decides how they are joined.
    per_run = base.filter("_v IS NOT NULL").groupBy("model_name", "run_id")
    seen_often = per_run.agg(F.count(F.lit(1)).alias("_times"), F.min(F.struct("_at", "arrival_no")).alias("_first"))
    repeats = materialise(seen_often.filter("_times > 1").drop("_times"), "repeated-runs")
    marked = base.join(repeats, ["model_name", "run_id"], "left")
    is_first = F.col("_first").isNull() | (F.struct("_at", "arrival_no") == F.col("_first"))
    marked = marked.withColumn("_counts", F.col("_v").isNotNull() & is_first).drop("_first")
    bucketed = add_buckets(marked, "_at", cut_points(base, "_at", tie="arrival_no"), tie="arrival_no")
    order, keys = ["_at", "arrival_no"], ["model_name"]
    v, bar, counts = F.col("_v"), F.col("_bar"), F.col("_counts")
    measures = {
        "_before": Running("count", F.lit(1), inclusive=False),
        "_bar": Running("min", F.when(counts, v), inclusive=False),
    }
    first = counts & bar.isNull()
    if threshold == 0:
        # The best value so far is the champion's; of equal values the latest run has won, at zero the first.
        newer = F.when(v == 0, 1).otherwise(-1)
        holder = F.struct(v.alias("v"), (newer * F.col("_at")).alias("a"), (newer * F.col("arrival_no")).alias("n"), "run_id")
        measures["_holder"] = Running("min", F.when(counts, holder))
        seen = running(bucketed, keys, order, measures)
        tie = (v == bar) & (v != 0)
        known = seen.withColumns({"champion_run": F.col("_holder.run_id"), "_wins": first | (counts & ((v < bar) | tie))})
    else:
        # Stored, because the records, the rows and their bucket totals all start from it.
        seen = materialise(running(bucketed, keys, order, measures), "arrivals")
        records = seen.filter(first | (counts & (v < bar)))
        won = _promoted(records.select("model_name", BUCKET, *order, "_v"), threshold, streamed).withColumn("_won", F.lit(True))
        flagged = seen.join(won, ["model_name", BUCKET, *order], "left").withColumn("_wins", F.coalesce("_won", F.lit(False)))
        crowned = F.when(F.col("_wins"), F.col("run_id"))
        known = running(flagged, keys, order, {"champion_run": Running("last", crowned)})
    scenario = (
        F.when(F.col("_v").isNull(), ERROR)
        .when(~counts, SKIPPED)
        .when(F.col("_wins") & first, FIRST)
        .when(F.col("_wins"), PROMOTED)
        .otherwise(CHALLENGER)
    )
    return known.select("model_name", (F.col("_before") + 1).alias("seq"), "run_id", scenario.alias("scenario"), "champion_run")


def _promoted(records: DataFrame, threshold: float, streamed: int) -> DataFrame:
    """The records that are promoted under a relative threshold; values are to be minimised."""
    crowded = records.groupBy("model_name").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > streamed).select("model_name")
    if crowded.isEmpty():
        return _fold(records, threshold)
    crowded = materialise(crowded, "crowded-models")
    rest = _fold(records.join(crowded, "model_name", "left_anti"), threshold)
    return rest.unionByName(_jump(records.join(crowded, "model_name", "left_semi"), threshold))


def _beats(champion: np.ndarray, value: np.ndarray | float, threshold: float) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.where(champion == 0, value < 0, (champion - value) / np.abs(champion) >= threshold)


def _goals(champions: np.ndarray, threshold: float) -> np.ndarray:
    """The greatest number below each champion that beats it, or NaN. Numbers are searched by their bits, since the
    rounding of the rule decides at the boundary."""

    def ranked(numbers: np.ndarray) -> np.ndarray:
        # Bits of a double as an integer of the same order; the mapping is its own inverse.
        return numbers ^ ((numbers >> 63) & np.int64(2**63 - 1))

    low = np.full(len(champions), -np.inf)
    none = ~_beats(champions, low, threshold)
    under = np.nextafter(champions, -np.inf)
    whole = _beats(champions, under, threshold)
    low, high = ranked(low.view(np.int64)), ranked(under.view(np.int64))
    for _ in range(64):
        middle = (low & high) + ((low ^ high) >> 1)
        good = _beats(champions, ranked(middle).view(np.float64), threshold)
        low, high = np.where(good, middle, low), np.where(good, high, middle)
    found = np.where(whole, under, ranked(low).view(np.float64))
    return np.where(none, np.nan, found)


def _jump(records: DataFrame, threshold: float) -> DataFrame:
    """As ``_fold``, for models with many records.

    Records fall strictly, so a value names its record, and the next champion after it is the record with the greatest
    value at or below its goal. These links are found for all records at once. Those from the first record on are the
    promotions: links are joined to links twice as long, and each round reaches twice as many records.
    """

    @F.pandas_udf("double")
    def goal(values: pd.Series) -> pd.Series:
        return pd.Series(_goals(values.to_numpy(np.float64), threshold))

    by = ["model_name"]
    values = records.select("model_name", F.col("_v").alias("_x"), F.col("_v").alias("_to"))
    points = records.select("model_name", F.col("_v").alias("_from"), goal("_v").alias("_x"))
    points = materialise(points.filter("_x IS NOT NULL AND NOT isnan(_x)"), "goals")
    links = at_or_below(values, points, by, "_x", "_to").filter("_to IS NOT NULL").select("model_name", "_from", "_to")
    links = materialise(links, "links")
    reached = records.groupBy("model_name").agg(F.max("_v").alias("_from"))
    # A record that no other one leads to is passed by, unless it is the first.
    leads = links.select("model_name", F.col("_to").alias("_from")).unionByName(reached).distinct()
    links = materialise(links.join(leads, ["model_name", "_from"], "left_semi"), "links")
    reached = materialise(reached, "reached")
    while True:
        further = reached.join(links, ["model_name", "_from"]).select("model_name", F.col("_to").alias("_from"))
        further = materialise(further, "reached")
        if further.isEmpty():
            break
        reached = reached.unionByName(further)
        ends = links.withColumnRenamed("_to", "_x")
        longer = at_or_below(links.select("model_name", F.col("_from").alias("_x"), F.struct("_from", "_to").alias("_next")), ends, by, "_x", "_next")
        # A link that ends where no other one starts has no double.
        longer = longer.filter(F.col("_next._from") == F.col("_x"))
        links = materialise(longer.select("model_name", "_from", F.col("_next._to").alias("_to")), "links")
    return records.join(reached.withColumnRenamed("_from", "_v"), ["model_name", "_v"], "left_semi").drop("_v")


def _fold(records: DataFrame, threshold: float) -> DataFrame:
    """The records that are promoted under a relative threshold, by a walk through each model's records."""
    ordered = records.repartition("model_name").sortWithinPartitions("model_name", "_at", "arrival_no")

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, champion = None, 0.0
        for batch in batches:
            names, values = batch["model_name"].to_numpy(), batch["_v"].to_numpy()
            won = np.zeros(len(batch), dtype=bool)
            starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            for at, end in zip(starts, np.append(starts[1:], len(batch))):
                if names[at] != model:
                    model, champion, won[at] = names[at], values[at], True
                    at += 1
                # Jump from promotion to promotion; the records between them are compared at once.
                while at < end:
                    beats = _beats(np.float64(champion), values[at:end], threshold)
                    ahead = int(beats.argmax())
                    if not beats[ahead]:
                        break
                    at += ahead
                    champion, won[at] = values[at], True
                    at += 1
            yield batch.loc[won, ["model_name", BUCKET, "_at", "arrival_no"]]

    schema = records.drop("_v").schema
    return ordered.mapInPandas(step, schema)
