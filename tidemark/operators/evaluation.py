"""Model metrics as aggregates over (label, score) rows; scores never leave the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import count_if
from tidemark.functions.ordering import running_sum, value_positions
from tidemark.session import settle


def _div(num: Column, den: Column) -> Column:
    """num / den as doubles, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def split_number(key: str, seed: int = 42) -> Column:
    """A number that depends on the key and the seed only, the same in every run and engine."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


CELLS_BITS = 16


def class_positions(df: DataFrame, key: str, label: str | None = "label", seed: int = 42, out: str = "position") -> DataFrame:
    """Add each row's place (from 0) among the rows of its class in the order of its key's hash.

    Hashes are cut into 65,536 cells: rows are numbered within (class, cell), and each cell's first place comes from the counts
    of the cells, of which there are at most that many for each class.
    """
    group = F.col(label) if label else F.lit(0)
    hashed = df.withColumns({"_hash": split_number(key, seed), "_class": group}).withColumn("_at", F.shiftright("_hash", 32 - CELLS_BITS))
    counts = hashed.groupBy("_class", "_at").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_class").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_class").alias("_c"), F.col("_at").alias("_a"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_class", "_at").orderBy("_hash", key)
    numbered = hashed.withColumn("_place", F.row_number().over(within) - 1)
    same = F.col("_class").eqNullSafe(F.col("_c")) & (F.col("_at") == F.col("_a"))
    placed = numbered.join(F.broadcast(starts), same, "left")  # at most 65,536 rows for each class
    return placed.select(*df.columns, (F.col("_start") + F.col("_place")).alias(out))


def class_seats(df: DataFrame, percent: int, label: str | None = "label") -> DataFrame:
    """Test rows of each class: the smallest whole number of rows that holds ``percent`` of all, dealt to the classes by
    largest remainder (ties to the smaller label)."""
    sizes = df.groupBy((F.col(label) if label else F.lit(0)).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    every, ranked = Window.partitionBy(), Window.orderBy(F.desc("_rest"), "_c")  # one row for each class
    shared = sizes.withColumn("_all", F.sum("_n").over(every)).withColumn("_wanted", F.expr(f"(_all * {percent} + 99) div 100"))
    shared = shared.withColumns({"_whole": F.expr("_wanted * _n div _all"), "_rest": F.expr("_wanted * _n % _all")})
    extra = F.row_number().over(ranked) <= F.col("_wanted") - F.sum("_whole").over(every)
    return shared.select("_c", (F.col("_whole") + extra.cast("int")).alias("_seats"))


def hold_out(df: DataFrame, key: str, percent: int = 20, seed: int = 42, label: str | None = "label") -> DataFrame:
    """Mark the test rows, exactly stratified by ``label`` (None: not stratified)."""
    placed = class_positions(df, key, label, seed, "_position")
    group = F.col(label) if label else F.lit(0)
    marked = placed.join(F.broadcast(class_seats(df, percent, label)), group.eqNullSafe(F.col("_c")))
    return marked.select(*df.columns, (F.col("_position") < F.col("_seats")).alias("is_test"))


def fold_column(df: DataFrame, folds: int, key: str = "customer_id", seed: int = 42, label: str | None = "label") -> DataFrame:
    """Fold number; the sizes of a class in two folds differ by at most one."""
    placed = class_positions(df, key, label, seed + 1, "_position")
    return placed.select(*df.columns, (F.col("_position") % folds).cast("int").alias("fold"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """One row with n_neg / n_pos and the balanced weight of each class."""
    n, pos = F.count(F.lit(1)), count_if(F.col(label) == 1)
    return df.agg(n.alias("n"), pos.alias("positives")).select(
        (F.col("n") - F.col("positives")).alias("negatives"), "positives",
        _div(F.col("n") - F.col("positives"), F.col("positives")).alias("scale_pos_weight"),
        _div(F.col("n"), 2 * (F.col("n") - F.col("positives"))).alias("weight_0"),
        _div(F.col("n"), 2 * F.col("positives")).alias("weight_1"))


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", low: float = 0.10, high: float = 0.90,
                    points: int = 161, beta: float = 2.0) -> DataFrame:
    """F-beta at every threshold. Scores are counted per threshold cell; only the cells are ordered."""
    step = (high - low) / (points - 1)

    def at(i: Column) -> Column:
        return F.lit(low) + i * F.lit(step)

    guess = F.floor((F.col(score) - low) / step)
    cell = F.when(F.col(score) >= at(guess + 1), guess + 1).when(F.col(score) < at(guess), guess - 1).otherwise(guess)
    cell = F.greatest(F.lit(-1), F.least(F.lit(points - 1), cell)).cast("int")  # the last threshold met; -1 for none
    counts = df.groupBy(cell.alias("i")).agg(F.count(F.lit(1)).alias("_n"), count_if(F.col(label) == 1).alias("_p"))
    spine = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
    all_cells = spine.unionByName(df.sparkSession.range(1).select(F.lit(-1).alias("i"))).join(counts, "i", "left")
    above = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)  # one row per threshold
    zero = F.lit(0)
    summed = all_cells.select("i", F.sum(F.coalesce("_n", zero)).over(above).alias("predicted"),
                              F.sum(F.coalesce("_p", zero)).over(above).alias("tp"),
                              F.sum(F.coalesce("_p", zero)).over(Window.partitionBy()).alias("_pos")).where("i >= 0")
    b2 = beta * beta
    f = _div((1 + b2) * F.col("tp"), b2 * F.col("_pos") + F.col("predicted"))
    return summed.select(at(F.col("i")).alias("threshold"), "tp", (F.col("predicted") - F.col("tp")).alias("fp"),
                         (F.col("_pos") - F.col("tp")).alias("fn"), f.alias("f_beta"))


def best_threshold(df: DataFrame, label: str = "label", score: str = "score", **sweep) -> DataFrame:
    """The first maximum wins."""
    return threshold_sweep(df, label, score, **sweep).orderBy(F.desc("f_beta"), "threshold").limit(1)


def metrics_at(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """One row of threshold metrics and the confusion matrix."""
    y, p = F.col(label) == 1, F.col(score) >= threshold
    counts = df.agg(count_if(~y & ~p).alias("tn"), count_if(~y & p).alias("fp"), count_if(y & ~p).alias("fn"),
                    count_if(y & p).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.select(
        F.lit(float(threshold)).alias("threshold"), _div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _div(tp, tp + fp).alias("precision"), _div(tp, tp + fn).alias("recall"),
        _div(2 * tp, 2 * tp + fp + fn).alias("f1"), _div(5 * tp, 5 * tp + 4 * fn + fp).alias("f2"),
        "tn", "fp", "fn", "tp")


def _by_score(df: DataFrame, label: str, score: str, **cutting) -> DataFrame:
    """Per distinct score: rows and positives at it and below it."""
    return value_positions(df, [score], {"pos": F.col(label)}, **cutting)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", **cutting) -> DataFrame:
    """From the rank sum of the positives; a tie counts half."""
    scores = _by_score(df, label, score, **cutting)
    sums = scores.agg(F.sum(F.col("pos") * (2 * F.col("below") + F.col("equal") + 1)).alias("_twice"),
                      F.sum("pos").alias("_p"), F.max("n").alias("_n"))
    p, n = F.col("_p"), F.col("_n")
    return sums.select(_div(F.col("_twice") - p * (p + 1), 2 * p * (n - p)).alias("roc_auc"))


def roc_auc_by(df: DataFrame, group: str, label: str = "label", score: str = "score", **cutting) -> DataFrame:
    """The ROC-AUC of each group, all groups in one scan over distinct scores."""
    counted = settle(df.groupBy(group, score).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("bigint")).alias("_pos")), "score-counts")
    to = running_sum(counted, [group], [score], {"_to": F.col("_n")}, **cutting)
    sums = to.groupBy(group).agg(F.sum(F.col("_pos") * (2 * F.col("_to") - F.col("_n") + 1)).alias("_twice"), F.sum("_pos").alias("_p"),
                                 F.sum("_n").alias("_all"))
    p, n = F.col("_p"), F.col("_all")
    return sums.select(group, _div(F.col("_twice") - p * (p + 1), 2 * p * (n - p)).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score", **cutting) -> DataFrame:
    """One step per distinct score, from high to low."""
    scores = _by_score(df, label, score, **cutting)
    total = df.agg(F.sum(label).alias("_p"))  # one row
    steps = scores.crossJoin(F.broadcast(total)).select(
        "pos", "_p", (F.col("_p") - F.col("pos_below")).alias("_tp"), (F.col("n") - F.col("below")).alias("_seen"))
    gained = _div(F.col("pos"), F.col("_p")) * _div(F.col("_tp"), F.col("_seen"))
    return steps.agg(F.sum(gained).alias("average_precision"))


def classification_report(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """Per class, macro and weighted averages."""
    c = metrics_at(df, threshold, label, score).select("tn", "fp", "fn", "tp")

    def row(name: str, hit: str, wrong: str, missed: str) -> Column:
        h, w, m = F.col(hit), F.col(wrong), F.col(missed)
        return F.struct(F.lit(name).alias("class"), _div(h, h + w).alias("precision"), _div(h, h + m).alias("recall"),
                        _div(2 * h, 2 * h + w + m).alias("f1"), (h + m).alias("support"))

    both = c.select(row("0", "tn", "fn", "fp").alias("a"), row("1", "tp", "fp", "fn").alias("b"))

    def average(name: str, left: Column, right: Column) -> Column:
        parts = [((F.col(f"a.{m}") * left + F.col(f"b.{m}") * right) / (left + right)).alias(m)
                 for m in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class"), *parts,
                        (F.col("a.support") + F.col("b.support")).alias("support"))

    rows = F.array(F.col("a"), F.col("b"), average("macro avg", F.lit(1.0), F.lit(1.0)),
                   average("weighted avg", F.col("a.support"), F.col("b.support")))
    return both.select(F.explode(rows).alias("r")).select("r.*")


def risk_band(score: str | Column) -> Column:
    """Right-closed bands."""
    s = F.col(score) if isinstance(score, str) else score
    # The band limits and names.
    return (F.when(s <= 0.30, "Low").when(s <= 0.55, "Medium").when(s <= 0.75, "High")
            .when(s.isNotNull(), "Critical"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R2 in one pass."""
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    sums = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("_mse"), F.var_pop(y).alias("_var"))
    return sums.select("mae", F.sqrt("_mse").alias("rmse"), (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"))


def correlations(df: DataFrame, target: str, columns: Sequence[str], k: int = 20, digits: int = 6) -> DataFrame:
    """Strongest linear relations with the target; constant columns have none."""
    y = F.col(target).cast("double")
    wide = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in columns])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.round(c, digits).alias("correlation"))
                                           for c in columns])).alias("x")).select("x.*")
    known = long.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    return known.orderBy(F.desc(F.abs("correlation")), "feature").limit(k)
