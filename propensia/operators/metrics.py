"""Ranking and calibration metrics as distributed aggregates.

Rows are first summed per distinct score (map-side combined: count and
positives), and everything but the tie-break of the top tenth follows from
that table: prefix sums over distinct scores give positives and rows at or
above each score (the range-split prefix sums of ``ranking``), so

* AP  = sum_s pos_s / P * TP(>=s) / seen(>=s)   (step-wise over distinct
  thresholds; 0 without positives)
* AUC = sum_s neg_s * (TP(>=s) - pos_s / 2) / (P N)   (ties count 1/2)
* Brier = sum_s (pos_s (s - 1)^2 + neg_s s^2) / n
* precision@10 = mean label of the ``max(1, ceil(0.1 n))`` highest rows: all
  rows above the score at the border, and of the rows with that score those
  that the tie-break puts first (only they are ranked)
* lift@10 = precision@10 / prevalence (0 when prevalence is 0)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensia.operators import ranking as R


def evaluation_metrics(
    df: DataFrame,
    label_col: str = "adopted_card",
    score_col: str = "propensity_score",
    tiebreak: list[str] | None = None,
    fraction: float = 0.10,
) -> DataFrame:
    """One-row DataFrame of n, positives, prevalence and M1-M5.

    M6: an empty input, or a row without label or score, is an error. The
    table per distinct score is written once to the shared folder; the scored
    rows are read once for it and once more for the rows at the border score.
    """
    from propensia.session import materialize

    tiebreak = list(tiebreak or [])
    y, p = F.col(label_col).cast("double"), F.col(score_col).cast("double")
    rows = df.select(y.alias("_y"), p.alias("_p"), *tiebreak)
    per = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").alias("_pos"), F.count_if(F.col("_y").isNull()).alias("_bad"))
    per = materialize(per, "scores")
    c, pos, s = F.col("_c"), F.col("_pos"), F.col("_p")
    total = per.agg(
        F.sum(c).alias("n"),
        F.sum(pos).alias("positives"),
        (F.sum("_bad") + F.sum(F.when(s.isNull(), c).otherwise(0))).alias("missing"),
        F.sum(pos * F.pow(s - 1, 2) + (c - pos) * F.pow(s, 2)).alias("error"),
    ).first()
    n = int(total["n"] or 0)
    if n == 0 or total["missing"]:
        raise ValueError(f"Metrics need rows that all have a label and a score (rows: {n}, incomplete: {total['missing'] or 0}).")
    positives = float(total["positives"])
    k = R.top_count(n, fraction)
    below = R.prefix_sums(per, ["_p"], {"_rows": c, "_tp": pos}, materialize=False)
    tp = F.lit(positives) - (F.col("_tp") - pos)
    seen = F.lit(n) - (F.col("_rows") - c)
    above = F.lit(n) - F.col("_rows")  # rows with a higher score
    curve = below.select(
        (pos * tp / seen).alias("ap"),
        ((c - pos) * (tp - pos / 2.0)).alias("auc"),
        F.when(seen <= k, pos).otherwise(0.0).alias("sure"),
        F.when((above < k) & (seen > k), F.struct(s.alias("s"), (F.lit(k) - above).alias("take"))).alias("border"),
    ).agg(F.sum("ap").alias("ap"), F.sum("auc").alias("auc"), F.sum("sure").alias("sure"), F.max("border").alias("border")).first()
    hits = float(curve["sure"])
    if curve["border"] is not None:  # the tie-break decides among rows of one score
        tied = rows.filter(F.col("_p") == F.lit(curve["border"]["s"])).select("_y", *tiebreak)
        if tiebreak:
            ranked, m = R.global_rank(tied, tiebreak, "_r")
            tied = ranked.filter(F.col("_r") > m - int(curve["border"]["take"]))
            hits += float(tied.agg(F.sum("_y")).first()[0] or 0.0)
        else:  # without a tie-break the tied rows count alike
            hits += float(curve["border"]["take"]) * float(tied.agg(F.avg("_y")).first()[0])
    precision = hits / k
    prevalence = positives / n
    negatives = n - positives
    values = {
        "n": n,
        "positives": int(positives),
        "prevalence": prevalence,
        "pr_auc": float(curve["ap"]) / positives if positives else 0.0,
        "roc_auc": float(curve["auc"]) / (positives * negatives) if positives and negatives else None,
        "precision_at_10": precision,
        "lift_at_10": precision / prevalence if prevalence else 0.0,
        "brier_score": float(total["error"]) / n,
    }
    kinds = {"n": "long", "positives": "long"}
    row = [F.lit(v).cast(kinds.get(name, "double")).alias(name) for name, v in values.items()]
    return df.sparkSession.range(1, numPartitions=1).select(*row)


def segment_distribution(scores: DataFrame) -> DataFrame:
    """Customers and mean score per campaign segment."""
    return scores.groupBy("campaign_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("propensity_score").alias("avg_score")
    )
