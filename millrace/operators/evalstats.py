"""Evaluation-run analytics: DataFrame in, DataFrame out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.shared import written


def rounded(c: Column, places: int) -> Column:
    """A double rounded as SQL does: shifted by the places first, then to the nearest whole number, halves away from zero.

    F.round() reads a double's shortest decimals instead, so that a mean of 63.949999999999996, which is 63.95 but for
    the last digit of its sum, would go down to 63.9. What is too large to be shifted has no places.
    """
    shifted = c * F.lit(10.0**places)
    return F.when(F.abs(shifted) == float("inf"), c).otherwise(F.round(shifted) / F.lit(10.0**places))


def stats(c: str, prefix: str | None = None, places: int = 4) -> list[Column]:
    """mean, sample deviation (0 for one value), least and greatest, rounded; 0 where there are no values."""
    p = prefix or c
    kept = lambda x: rounded(F.coalesce(x, F.lit(0.0)), places)
    return [kept(F.avg(c)).alias(f"{p}_mean"), kept(F.stddev_samp(c)).alias(f"{p}_stddev"), kept(F.min(c)).alias(f"{p}_min"), kept(F.max(c)).alias(f"{p}_max")]


def summary(runs: DataFrame, metrics: list[str], by: str = "configuration") -> DataFrame:
    return runs.groupBy(by).agg(*[s for m in metrics for s in stats(m)], F.count(F.lit(1)).alias("runs"))


def ranked_configurations(runs: DataFrame, order: str, by: str = "configuration") -> DataFrame:
    """Configurations in order of first appearance."""
    first = runs.groupBy(by).agg(F.min(F.struct(order, by)).alias("first"))
    return first.withColumn("rank", F.row_number().over(W.orderBy("first"))).drop("first")  # one row a configuration


def delta(runs: DataFrame, metric: str, order: str, by: str = "configuration", baseline: str | None = None) -> DataFrame:
    """Rounded mean of the first configuration less that of the second (0 if there is none; or of the named baseline)."""
    means = runs.groupBy(by).agg(rounded(F.avg(metric), 4).alias("mean")).join(ranked_configurations(runs, order, by), by)
    second = F.col(by) == baseline if baseline else F.col("rank") == 2
    first = (F.col("rank") == 1) if not baseline else (F.col("rank") == 1) & (F.col(by) != baseline)
    return means.agg(F.round(F.max(F.when(first, F.col("mean"))) - F.coalesce(F.max(F.when(second, F.col("mean"))), F.lit(0.0)), 4).alias("delta"))


def trigger_results(outcomes: DataFrame, threshold: float = 0.5) -> DataFrame:
    """query, should_trigger, triggers, runs, errors, trigger_rate, pass. outcomes: query, should_trigger, triggered (null: the call failed)."""
    hit = F.coalesce(F.col("triggered"), F.lit(False))
    out = outcomes.groupBy("query", "should_trigger").agg(F.count_if(hit).alias("triggers"), F.count(F.lit(1)).alias("runs"), F.count_if(F.col("triggered").isNull()).alias("errors"))
    rate = F.col("triggers") / F.col("runs")
    return out.withColumns({"trigger_rate": F.round(rate, 4), "pass": F.when(F.col("should_trigger"), rate >= threshold).otherwise(rate < threshold)})


def counts(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if("pass").alias("passed"), F.count_if(~F.col("pass")).alias("failed"))


def confusion(results: DataFrame) -> DataFrame:
    t, no = F.col("triggers"), F.col("runs") - F.col("triggers")
    sums = results.agg(*[F.coalesce(F.sum(F.when(F.col("should_trigger") == want, c).otherwise(0)), F.lit(0)).alias(n) for n, want, c in (("tp", True, t), ("fn", True, no), ("fp", False, t), ("tn", False, no))])
    ratio = lambda a, b, d: F.round(F.coalesce(F.try_divide(F.col(a), b), F.lit(d)), 4)
    every = F.col("tp") + F.col("fn") + F.col("fp") + F.col("tn")
    return sums.withColumns({"precision": ratio("tp", F.col("tp") + F.col("fp"), 1.0), "recall": ratio("tp", F.col("tp") + F.col("fn"), 1.0), "accuracy": F.round(F.coalesce(F.try_divide(F.col("tp") + F.col("tn"), every), F.lit(0.0)), 4)})


def correct_runs(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.sum(F.when(F.col("should_trigger"), F.col("triggers")).otherwise(F.col("runs") - F.col("triggers"))), F.lit(0)).alias("correct"), F.coalesce(F.sum("runs"), F.lit(0)).alias("total"))


#: Rows of one class that are ranked in one task; beyond that their order's leading digits are counted further.
RANKED, DIGITS = 100_000, 4


def _border(rows: DataFrame, wanted: DataFrame | None, holdout: float, length: int) -> tuple[DataFrame, int]:
    """class, prefix, k, size: of each class the leading digits of its last test row's order, how many with these are test, how many there are.

    rows: class, order (of that length). wanted: class, k; where None, the share holdout of each class, one at least.
    Digits are counted, not rows moved: a class has 16 ** DIGITS counts at most, however many rows it has.
    """
    at, n_digits = wanted, 0
    while True:
        n_digits += DIGITS
        inside = rows
        if n_digits > DIGITS:
            inside = rows.join(at.select(F.col("class").alias("c"), "prefix"), F.col("class").eqNullSafe(F.col("c")) & F.startswith("order", "prefix"), "left_semi")
        counted = written(inside.groupBy("class", F.substring("order", 1, n_digits).alias("digits")).agg(F.count(F.lit(1)).alias("size")), "digits")
        if at is None:
            at = counted.groupBy("class").agg(F.greatest(F.lit(1), F.floor(F.sum("size") * holdout)).alias("k"))
        before = F.coalesce(F.sum("size").over(W.partitionBy("class").orderBy("digits").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        met = counted.withColumn("before", before).join(at.select(F.col("class").alias("c"), "k"), F.col("class").eqNullSafe(F.col("c")))
        at = written(met.filter("before < k and k <= before + size").select("class", F.col("digits").alias("prefix"), (F.col("k") - F.col("before")).alias("k"), "size"), "border")
        most = at.agg(F.max("size")).first()[0] or 0
        if most <= RANKED or n_digits >= length:
            return at, most


def _sides(rows: DataFrame, at: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that the border's digits decide, with their split; the others, with how many of them are test (k)."""
    met = rows.join(at.select(F.col("class").alias("c"), "prefix", "k"), F.col("class").eqNullSafe(F.col("c")), "left").drop("c")
    digits = F.substr("order", F.lit(1), F.length("prefix"))
    decided = met.withColumn("split", F.when(digits < F.col("prefix"), "test").when((digits > F.col("prefix")) | F.col("prefix").isNull(), "train"))
    return decided.filter("split is not null").drop("prefix", "k"), decided.filter("split is null").drop("prefix", "split")


def stratified_split(items: DataFrame, key: str, stratum: str, holdout: float, seed: int = 42) -> DataFrame:
    """items and split: per stratum max(1, floor(n * holdout)) rows are test, those first by a seeded digest of the key.

    The last test row is found by counting the digest's leading digits per stratum, further digits where those of the border are
    many; only the border's rows are ranked. Rows with one key have one digest: of such rows at the border, as many are test as
    are still wanted, by a digest of their place in a table of the border's rows, so that one key with any share of all rows is
    no task's. A null stratum is a stratum, and a null key's digest is that of an empty one; the split of an empty table is empty.
    """
    if holdout <= 0:
        return items.withColumn("split", F.lit("train"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = items.select(F.struct(*items.columns).alias("row"), F.col(stratum).alias("class"), digest.alias("order"))
    at, most = _border(rows.select("class", "order"), None, holdout, 32)
    parts, left = _sides(rows, at)
    parts, left = [parts], written(left, "border-rows")
    own = F.concat("order", F.md5(F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))))
    left = left.select("row", "class", "k", own.alias("order"))
    if most > RANKED:
        at, _ = _border(left.select("class", "order"), left.groupBy("class").agg(F.max("k").alias("k")), holdout, 64)
        more, left = _sides(left.drop("k"), at)
        parts.append(more)
    rank = F.row_number().over(W.partitionBy("class").orderBy("order"))
    parts.append(left.withColumn("split", F.when(rank <= F.col("k"), "test").otherwise("train")))
    return reduce(DataFrame.unionByName, [p.select("row.*", "split") for p in parts])


def best_iteration(history: DataFrame) -> DataFrame:
    """The first iteration with most test (else train) passes."""
    score = F.coalesce("test_passed", "train_passed", F.lit(0))
    return history.agg(F.max_by("iteration", F.struct(score, -F.col("iteration"))).alias("iteration"), F.max(score).alias("passed"))


def blinded(history: DataFrame) -> DataFrame:
    return history.select([c for c in history.columns if not c.startswith("test_")])


def expanded(cases: DataFrame, runs: int) -> DataFrame:
    return cases.withColumn("run_idx", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def matrix(history: DataFrame, queries: list[str]) -> DataFrame:
    """Iterations by queries: 'ok' or 'no' and triggers/runs; the queries are those of the first iteration."""
    cell = F.concat(F.when(F.col("pass"), "ok ").otherwise("no "), F.col("triggers"), F.lit("/"), F.col("runs"))
    return history.groupBy("iteration").pivot("query", queries).agg(F.first(cell)).fillna("no 0/0")


def bucket(score: Column, total: Column) -> Column:
    share = F.coalesce(F.try_divide(score, total), F.lit(0.0))
    return F.when(share >= 0.8, "good").when(share >= 0.5, "ok").otherwise("bad")


def assertion_classes(graded: DataFrame) -> DataFrame:
    """eval_id, text, class. graded: eval_id, text, with_skill boolean, passed. A text that only one side has is in a class of its own."""
    rate = lambda side: F.avg(F.when(F.col("with_skill") == side, F.col("passed").cast("int")))
    x = graded.groupBy("eval_id", "text").agg(rate(True).alias("a"), rate(False).alias("b"))
    c = F.when(F.col("a").isNull() | F.col("b").isNull(), "one side").when((F.col("a") == 1) & (F.col("b") == 1), "always pass").when((F.col("a") == 0) & (F.col("b") == 0), "always fail").when((F.col("a") == 1) & (F.col("b") == 0), "skill only").when((F.col("a") == 0) & (F.col("b") == 1), "baseline only").otherwise("variable")
    return x.select("eval_id", "text", c.alias("class"))


def outliers(runs: DataFrame, metric: str, by: str = "configuration", z: float = 2.0) -> DataFrame:
    """Rows more than z sample deviations from their configuration's mean; moments are summed before the join."""
    m = runs.groupBy(by).agg(F.avg(metric).alias("_m"), F.stddev_samp(metric).alias("_s"))
    score = F.try_divide(F.col(metric) - F.col("_m"), F.col("_s"))
    return runs.join(m, by).withColumn("z", F.round(score, 4)).filter(F.abs(score) > z).drop("_m", "_s")


def rubric(scores: DataFrame, content: str = "content", structure: str = "structure") -> DataFrame:
    """Dimension scores (means of map values, 1 place) and overall = mean of the rounded dimensions, doubled."""
    mean = lambda c: F.round(F.aggregate(F.map_values(c), F.lit(0.0), lambda a, x: a + x) / F.size(c), 1)
    x = scores.withColumns({"content_score": mean(content), "structure_score": mean(structure)})
    return x.withColumn("overall_score", F.round((F.col("content_score") + F.col("structure_score")) / 2 * 2, 1))


def winner(a_overall: Column, b_overall: Column, a_rate: Column, b_rate: Column) -> Column:
    return F.when(a_overall > b_overall, "A").when(b_overall > a_overall, "B").when(a_rate > b_rate, "A").when(b_rate > a_rate, "B").otherwise("TIE")


def claim_tally(graded: DataFrame) -> DataFrame:
    c = graded.select(F.explode("claims").alias("c"))
    return c.groupBy(F.col("c.type").alias("type")).agg(F.count_if("c.verified").alias("verified"), F.count(F.lit(1)).alias("total"))


def version_steps(versions: DataFrame) -> DataFrame:
    """Each version, its parent's rate and the change."""
    p = versions.select(F.col("version").alias("parent"), F.col("expectation_pass_rate").alias("parent_rate"))
    return versions.join(p, "parent", "left").withColumn("change", F.round(F.col("expectation_pass_rate") - F.col("parent_rate"), 4))


#: The keys that a document's metadata may have.
KEYS = ("name", "description", "license", "allowed-tools", "metadata", "compatibility")


def metadata_problem(name: Column, description: Column, keys: Column | None = None, compatibility: Column | None = None, allowed: tuple[str, ...] = KEYS) -> Column:
    """The first rule that a document's metadata break, else null. White space round name and description doesn't count; both may be blank, but not missing."""
    stripped = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    n, said = stripped(name), stripped(description)
    rules = [] if keys is None else [(F.size(F.array_except(keys, F.array(*map(F.lit, allowed)))) > 0, "unexpected key")]
    rules += [
        (name.isNull(), "missing name"), (description.isNull(), "missing description"), ((n != "") & ~n.rlike("^[a-z0-9-]+$"), "name not hyphen-case"),
        (n.startswith("-") | n.endswith("-") | n.contains("--"), "misplaced hyphen"), (F.char_length(n) > 64, "name too long"),
        (said.contains("<") | said.contains(">"), "angle bracket"), (F.char_length(said) > 1024, "description too long"),
    ]
    rules += [] if compatibility is None else [(F.char_length(compatibility) > 500, "compatibility too long")]
    return F.coalesce(*[F.when(broken, F.lit(problem)) for broken, problem in rules])
