"""Score JSON requests (batch or Structured Streaming).

Validation order (first failing check wins):
0. body absent (NULL)                    -> not an object
1. body is not valid JSON                 -> not valid JSON
2. required fields missing (sorted)       -> the missing names. Fields of an
   object are its keys (of a repeated key the last value counts); an array
   has the fields that its string elements name; a string has none.
3. any other body that is no object (numbers, booleans, null, and an array
   that names every field)                -> not an object
4. fields not numeric (bool, string, null, object...; sorted) -> their names
5. digital_ratio_30d outside [0, 1]
6. the model needs a feature that requests don't carry -> status 500
Good rows: status 200 with score (4 places, the binary value rounded half to
even), absolute decile ``min(10, max(1, ceil(10 p)))``, recommendation and
``"%.1fx"`` lift.

Everything is column expressions over ``try_parse_json`` (variant), so the
same function serves ``spark.read`` and ``spark.readStream`` inputs. Notes:
``NaN`` and ``Infinity`` are not JSON here; Java formatting rounds exact halves
of the lift up (0.25 -> "0.3x").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensia import schemas as S
from propensia.functions.expr import campaign_segment, expected_lift, format_lift, probability_decile, round_binary

# Variant type names that count as JSON numbers (booleans do not).
NUMERIC_TYPES = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"


def _is_numeric(t: Column) -> Column:
    return F.coalesce(t.rlike(NUMERIC_TYPES), F.lit(False))


def _joined(names: list[str], flags: dict[str, Column]) -> Column:
    """Comma-joined names (already sorted) whose flag is true."""
    return F.concat_ws(", ", *[F.when(flags[n], F.lit(n)) for n in names])


def _parsed(df: DataFrame, body_col: str) -> DataFrame:
    """``df`` with the body as a variant ``_v`` (null: not JSON) in which the
    last value of a repeated key counts.

    The parser takes that option from the session when the projection is
    analysed, i.e. here; it is put back at once.
    """
    conf, key = df.sparkSession.conf, "spark.sql.variant.allowDuplicateKeys"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return df.select("*", F.try_parse_json(F.col(body_col)).alias("_v"))
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def validate_requests(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``status`` (200/400), ``error`` and one double per model feature.

    Three narrow projections: parse once, type every field once, then
    decide; each stage refers to the previous one's columns, so no parse
    or type probe is evaluated twice per row.
    """
    fields = S.REQUEST_FIELDS
    parsed = _parsed(df, body_col)
    v = F.col("_v")
    typed = parsed.select(
        "*",
        F.schema_of_variant(v).alias("_top"),
        F.try_variant_get(v, "$", "array<string>").alias("_named"),
        *[F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant")).alias(f"_t_{f}") for f in fields],
        *[F.try_variant_get(v, f"$.{f}", "double").alias(f"_x_{f}") for f in fields],
    )
    is_array = F.col("_top").startswith("ARRAY")
    is_object = F.col("_top").startswith("OBJECT")

    def absent(f: str) -> Column:
        named = F.coalesce(F.array_contains(F.col("_named"), f), F.lit(False))
        return F.when(is_object, F.col(f"_t_{f}").isNull()).when(is_array, ~named).otherwise(F.col("_top") == "STRING")

    flags = typed.select(
        *df.columns,
        "_v",
        is_object.alias("_obj"),
        *[absent(f).alias(f"_m_{f}") for f in fields],
        *[(~_is_numeric(F.col(f"_t_{f}"))).alias(f"_i_{f}") for f in fields],
        *[F.col(f"_x_{f}") for f in fields],
    )
    missing = {f: F.col(f"_m_{f}") for f in fields}
    invalid = {f: F.col(f"_i_{f}") for f in fields}
    any_missing = F.lit(False)
    any_invalid = F.lit(False)
    for f in fields:
        any_missing = any_missing | missing[f]
        any_invalid = any_invalid | invalid[f]
    ratio = F.col("_x_digital_ratio_30d")
    bad_ratio = F.coalesce(~((ratio >= 0.0) & (ratio <= 1.0)), F.lit(True)) | F.isnan(ratio)
    error = (
        F.when(F.col(body_col).isNull(), F.lit(S.ERROR_NOT_OBJECT))
        .when(v.isNull(), F.lit(S.ERROR_NOT_JSON))
        .when(any_missing, F.concat(F.lit(S.ERROR_MISSING), _joined(fields, missing)))
        .when(~F.col("_obj"), F.lit(S.ERROR_NOT_OBJECT))
        .when(any_invalid, F.concat(F.lit(S.ERROR_NOT_NUMERIC), _joined(fields, invalid)))
        .when(bad_ratio, F.lit(S.ERROR_RATIO))
    )
    decided = flags.select("*", error.alias("error"))
    ok = F.col("error").isNull()
    return decided.select(
        *df.columns,
        F.when(ok, F.lit(200)).otherwise(F.lit(400)).alias("status"),
        "error",
        *[F.when(ok, F.col(f"_x_{api}")).alias(model) for api, model in S.MODEL_INPUT_MAP.items()],
    )


def score_requests(df: DataFrame, model, body_col: str = "body", base_rate: float = S.BASE_ADOPTION_RATE) -> DataFrame:
    """Validated requests -> status, error, score, decile, advice, lift."""
    checked = validate_requests(df, body_col)
    unsupported = sorted(set(_features(model)).difference(S.MODEL_INPUT_MAP.values()))
    if unsupported:  # the model cannot be fed from requests: valid ones fail too
        failed = F.col("status") == 200
        scored = checked.withColumn("error", F.when(failed, F.lit(S.ERROR_SCORING)).otherwise(F.col("error")))
        scored = scored.withColumn("status", F.when(failed, F.lit(500)).otherwise(F.col("status")))
        scored = scored.withColumn("propensity_score", F.lit(None).cast("double"))
    else:
        scored = model.transform(checked)
    ok = F.col("status") == 200
    p = F.col("propensity_score")
    decile = probability_decile(p)
    return scored.select(
        *df.columns,
        "status",
        "error",
        F.when(ok, round_binary(p, 4)).alias("propensity_score"),
        F.when(ok, decile).alias("score_decile"),
        F.when(ok, campaign_segment(decile)).alias("recommendation"),
        F.when(ok, format_lift(expected_lift(p, base_rate))).alias("expected_lift"),
    )


def _features(model) -> list[str]:
    """Features the model asks for; none where it doesn't say."""
    if hasattr(model, "feature_columns"):
        return list(model.feature_columns)
    if hasattr(model, "stages"):
        from propensia.sources.lake import model_features

        return model_features(model)
    return []


#: An arrival: the request's id (may be null), when it came, its body.
ARRIVALS = "request_id string, received_at timestamp, body string"


def epoch_sink(root: str):
    """A ``foreachBatch`` sink that writes each epoch's rows to a partition of its own.

    Spark may hand over an epoch again after a failure, always with the same
    rows: the partition is replaced then, so no row is lost or doubled.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        out = batch.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite")
        out.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("epoch").parquet(root)

    return write


def serve_requests(
    spark, source: str, model, responses: str, checkpoint: str, *, delay: str = "1 hour", files_per_epoch: int | None = None, fmt: str = "json"
):
    """R1 as a service job: score every request that has arrived at ``source`` since the last run, once.

    A request sent again (same id, within ``delay`` of the first) is answered
    once: the ids seen are kept in state until the watermark passes them, so
    the state's size follows the traffic of ``delay``, not of all time.
    Requests without an id are told apart by time of arrival and body. One that
    arrives more than ``delay`` behind the newest is dropped by the watermark,
    so ``delay`` must exceed the source's own lateness. Responses are written
    by ``epoch_sink``: a run that was killed is finished by the next one from
    ``checkpoint``, with no row lost or doubled. For large states set RocksDB
    as the session's state store.
    """
    reader = spark.readStream.schema(ARRIVALS)
    if files_per_epoch:
        reader = reader.option("maxFilesPerTrigger", files_per_epoch)
    arrived = reader.format(fmt).load(source)
    unnamed = F.concat(F.lit("unnamed:"), F.sha2(F.concat_ws("|", F.col("received_at").cast("string"), F.coalesce("body", F.lit(""))), 256))
    keyed = arrived.withColumn("_key", F.coalesce(F.concat(F.lit("id:"), "request_id"), unnamed))
    once = keyed.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")
    scored = score_requests(once, model).drop("body")
    query = scored.writeStream.foreachBatch(epoch_sink(responses)).option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_responses(spark, responses: str) -> DataFrame:
    """All responses written so far, with the epoch of each."""
    return spark.read.option("basePath", responses).parquet(responses)


def stream_requests(spark, source_dir: str, model, sink, checkpoint: str, fmt: str = "text"):
    """R1 on a file stream: each line of ``source_dir`` is one request body.

    ``sink(batch_df, epoch_id)`` receives each scored micro-batch, after a
    failure perhaps again (``epoch_sink`` writes either way once). Runs with
    ``trigger(availableNow=True)`` and returns the finished query.
    """
    stream = spark.readStream.format(fmt).load(source_dir).withColumnRenamed("value", "body")
    scored = score_requests(stream, model)
    q = scored.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
