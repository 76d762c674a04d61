"""Records and reports of evaluation runs: benchmark record and table, loop history, pairings, versions, suggestions, items.

Column names of the input are fixed by each docstring. Null and missing values: sums and counts leave them out, numbers that a
record needs are 0, and ids that are missing sort last.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import evalstats as E

METRICS = ("pass_rate", "time_seconds", "tokens")
RESULT = ("pass_rate", "passed", "failed", "total", "time_seconds", "tokens", "tool_calls", "errors")
PRIORITIES = ("high", "medium", "low")
#: What a package leaves out, by any folder's name, by the name of a folder below the top, by file name and by ending.
LEFT_OUT = {"parts": ("__pycache__", "node_modules"), "below_top": ("evals",), "names": (".DS_Store",), "ending": "pyc"}


def nested_runs(runs: DataFrame) -> DataFrame:
    """Runs with their numbers under `result`; missing numbers are 0."""
    result = F.struct(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in runs.columns else F.lit(0).alias(c) for c in RESULT])
    rest = [F.col(c) if c in runs.columns else F.array().cast("array<string>").alias(c) for c in ("expectations", "notes")]
    return runs.select("eval_id", "configuration", "run_number", result.alias("result"), *rest)


def deltas(runs: DataFrame, metrics: Sequence[str] = METRICS, order: str = "eval_id") -> DataFrame:
    """One row: for each metric the rounded mean of the first configuration less that of the second."""
    means = runs.groupBy("configuration").agg(*[E.rounded(F.coalesce(F.avg(m), F.lit(0.0)), 4).alias(m) for m in metrics], F.min(F.struct(order, "configuration")).alias("_first"))
    two = means.orderBy("_first").limit(2).agg(F.array_sort(F.collect_list(F.struct("_first", *metrics))).alias("t"))
    at = lambda k, m: F.coalesce(F.get("t", F.lit(k))[m], F.lit(0.0))
    return two.select(*[F.round(at(0, m) - at(1, m), 4).alias(f"delta_{m}") for m in metrics])


def benchmark(runs: DataFrame, name: str = "", path: str = "", timestamp: str = "", notes: Sequence[str] = ()) -> dict:
    """The benchmark record as a dict, of one benchmark tree: the record holds all its runs, as its format demands.

    For many trees at once use nested_runs(), evalstats.summary() and deltas(), which stay distributed. Numbers are written as
    Python writes them, so a tie goes to the even digit of the exact value. runs: see sources.results.scan_runs().
    """
    first = {r["configuration"]: r["rank"] for r in E.ranked_configurations(runs, "eval_id").collect()}
    rows = [r.asDict(recursive=True) for r in nested_runs(runs).toLocalIterator()]
    rows.sort(key=lambda r: (first[r["configuration"]], r["eval_id"] is None, r["eval_id"] or 0, r["run_number"] or 0))
    stats = {r["configuration"]: r.asDict() for r in E.summary(runs, list(METRICS)).collect()}
    summary = {c: {m: {k: stats[c][f"{m}_{k}"] for k in ("mean", "stddev", "min", "max")} for m in METRICS} for c in sorted(stats, key=first.get)}
    mean = [[s[m]["mean"] for m in METRICS] for s in summary.values()] + [[0.0] * len(METRICS)] * 2
    change = [a - b for a, b in zip(*mean[:2], strict=True)]
    summary["delta"] = {m: f"{d:+.{places}f}" for m, d, places in zip(METRICS, change, (2, 1, 0), strict=True)}
    ids = sorted({r["eval_id"] for r in rows if r["eval_id"] is not None})
    meta = {"skill_name": name or "<skill-name>", "skill_path": path or "<path/to/skill>", "executor_model": "<model-name>", "analyzer_model": "<model-name>"}
    most = max(Counter((r["configuration"], r["eval_id"]) for r in rows).values(), default=0)
    meta |= {"timestamp": timestamp, "evals_run": ids, "runs_per_configuration": most}  # of one eval, in the tree as it is
    return {"metadata": meta, "runs": rows, "run_summary": summary, "notes": list(notes)}


def benchmark_lines(record: dict) -> list[str]:
    """The record's table, for people: two configurations side by side and what the first gains."""
    meta, summary = record["metadata"], record["run_summary"]
    sides = [c for c in summary if c != "delta"][:2]
    none = {m: {"mean": 0, "stddev": 0} for m in METRICS}
    shown = [(c.replace("_", " ").title(), summary.get(c, none)) for c in sides + ["config_a", "config_b"][len(sides) :]]
    formats = {"pass_rate": ("Pass Rate", 100, 0, "%", ""), "time_seconds": ("Time", 1, 1, "s", "s"), "tokens": ("Tokens", 1, 0, "", "")}
    lines = [f"# Skill Benchmark: {meta['skill_name']}", "", f"**Model**: {meta['executor_model']}", f"**Date**: {meta['timestamp']}"]
    lines.append(f"**Evals**: {', '.join(map(str, meta['evals_run']))} ({meta['runs_per_configuration']} runs each per configuration)")
    lines += ["", "## Summary", "", f"| Metric | {shown[0][0]} | {shown[1][0]} | Delta |", "|--------|------------|---------------|-------|"]
    for m, (title, times, places, unit, delta_unit) in formats.items():
        cells = [" ± ".join(f"{s[m][k] * times:.{places}f}{unit}" for k in ("mean", "stddev")) for _, s in shown]
        lines.append(f"| {title} | {cells[0]} | {cells[1]} | {summary['delta'][m]}{delta_unit} |")
    if record["notes"]:
        lines += ["", "## Notes", "", *[f"- {n}" for n in record["notes"]]]
    return lines


def eval_ids(runs: DataFrame) -> DataFrame:
    """One row: the evals that have runs, in order."""
    return runs.select("eval_id").distinct().agg(F.array_sort(F.collect_list("eval_id")).alias("evals_run"))


def lists(runs: DataFrame, keys: Sequence[str], fields: Sequence[str], out: str = "runs") -> DataFrame:
    """One row a key with its rows as a sorted list."""
    return runs.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def pass_rates(graded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """passed, total and pass_rate (2 decimals; 0 of 0 is 0). graded: keys and passed."""
    x = graded.groupBy(*keys).agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))
    return x.withColumn("pass_rate", F.round(F.coalesce(F.try_divide("passed", "total"), F.lit(0.0)), 2))


def total_calls(calls: Column) -> Column:
    """Sum of a map's values; 0 for a null map."""
    return F.aggregate(F.coalesce(F.map_values(calls), F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def class_counts(items: DataFrame) -> DataFrame:
    """Counts by should_trigger."""
    yes = F.coalesce(F.col("should_trigger"), F.lit(False))
    return items.agg(F.count(F.lit(1)).alias("total"), F.count_if(yes).alias("positive"), F.count_if(~yes).alias("negative"))


def headed(items: DataFrame, key: str, by: str = "should_trigger") -> DataFrame:
    """items with `header`: whether the row is the first of its group where groups are shown one after another, by key."""
    first = items.groupBy(by).agg(F.min(key).alias("_first"))
    return items.join(first.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by"))).withColumn("header", F.col(key) == F.col("_first")).drop("_by", "_first")


def paired(runs: DataFrame, metric: str) -> DataFrame:
    """eval_id, first, second, change: means of an eval under the first two configurations; null where there are no runs."""
    rank = E.ranked_configurations(runs, "eval_id").filter("rank <= 2")
    x = runs.join(F.broadcast(rank), "configuration").groupBy("eval_id")  # two rows
    x = x.agg(*[F.avg(F.when(F.col("rank") == k, F.col(metric))).alias(n) for k, n in ((1, "a"), (2, "b"))])
    return x.select("eval_id", E.rounded(F.col("a"), 4).alias("first"), E.rounded(F.col("b"), 4).alias("second"), E.rounded(F.col("a") - F.col("b"), 4).alias("change"))


def blind_pairs(outputs: DataFrame, seed: int = 42) -> DataFrame:
    """eval_id, a, b: the two configurations of an eval, which of them is side A by a seeded digest. outputs: eval_id, configuration, one row each."""
    a, b = (outputs.select("eval_id", F.col("configuration").alias(x)) for x in "xy")
    turned = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("eval_id").cast("string"), F.lit(":"), "x", F.lit(":"), "y")), 1, 1) >= "8"
    return a.join(b, "eval_id").filter("x < y").select("eval_id", F.when(turned, F.col("y")).otherwise(F.col("x")).alias("a"), F.when(turned, F.col("x")).otherwise(F.col("y")).alias("b"))


def score_text(passed: Column, total: Column) -> Column:
    return F.concat_ws("/", F.coalesce(passed, F.lit(0)).cast("string"), F.coalesce(total, F.lit(0)).cast("string"))


def hardness(runs: DataFrame, metric: str) -> DataFrame:
    """eval_id, mean, stddev, kind: hard (below a half), easy (0.8 and more) or between, of a metric from 0 to 1."""
    x = runs.groupBy("eval_id").agg(E.rounded(F.avg(metric), 4).alias("mean"), E.rounded(F.coalesce(F.stddev_samp(metric), F.lit(0.0)), 4).alias("stddev"))
    return x.withColumn("kind", F.when(F.col("mean") < 0.5, "hard").when(F.col("mean") >= 0.8, "easy").otherwise("between"))


def history_sizes(history: DataFrame, split: DataFrame) -> DataFrame:
    """One row: number of iterations, of items trained on and of items held out."""
    kinds = history.select(F.lit("iteration").alias("kind")).unionByName(split.select(F.col("split").alias("kind")))
    return kinds.agg(*[F.count_if(F.col("kind") == k).alias(n) for k, n in (("iteration", "iterations"), ("train", "train_size"), ("test", "test_size"))])


def may_stop(feedback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per iteration, whether no review says anything. feedback: keys and feedback; null and blank say nothing."""
    said = F.regexp_replace(F.coalesce("feedback", F.lit("")), r"^\s+|\s+$", "") != ""
    return feedback.groupBy(*keys).agg((F.count_if(said) == 0).alias("stop"), F.count(F.lit(1)).alias("reviews"))


def current_best(versions: DataFrame, order: str = "version") -> DataFrame:
    """The version with the best rate, of equals the earliest."""
    best = versions.agg(F.max("expectation_pass_rate").alias("_rate"))
    return versions.join(F.broadcast(best), F.col("expectation_pass_rate") == F.col("_rate")).agg(F.min(order).alias("version"), F.first("_rate").alias("expectation_pass_rate"))  # one row


def suggestion_counts(suggestions: DataFrame) -> DataFrame:
    """priority, category, n, rank of the priority (high first, what is none of the three last)."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, PRIORITIES)), F.col("priority")), F.lit(0)), F.lit(len(PRIORITIES) + 1)).cast("int")
    return suggestions.groupBy("priority", "category").agg(F.count(F.lit(1)).alias("n")).withColumn("rank", rank).orderBy("rank", F.desc("n"), "category")


def packaged(files: DataFrame, path: str = "path") -> DataFrame:
    """Files that go into a package, by their path, whose first part is the package's own folder."""
    parts = F.split(path, "/")
    folder = F.arrays_overlap(parts, F.array(*map(F.lit, LEFT_OUT["parts"]))) | ((F.size(parts) > 1) & F.coalesce(F.get(parts, F.lit(1)).isin(*LEFT_OUT["below_top"]), F.lit(False)))
    name = F.element_at(parts, -1)
    return files.filter(~(folder | name.isin(*LEFT_OUT["names"]) | name.endswith("." + LEFT_OUT["ending"])))


def acceptable(items: DataFrame, source: str, contents: Sequence[str]) -> DataFrame:
    """Items with a source and at least one content that isn't blank."""
    some = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"^\s+|\s+$", "") != "", F.lit(False)) for c in contents]
    return items.filter(F.col(source).isNotNull() & F.greatest(*some, F.lit(False)))


def cascade(tiers: Sequence[tuple[str, DataFrame]], a: str = "a_id", b: str = "b_id") -> DataFrame:
    """a, b, tier: pairs of all tiers, cheapest first; a pair that an earlier tier has isn't given again."""
    out = None
    for name, pairs in tiers:
        new = pairs.select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct().withColumn("tier", F.lit(name))
        out = new if out is None else out.unionByName(new.join(out.select(a, b), [a, b], "left_anti"))
    return out
