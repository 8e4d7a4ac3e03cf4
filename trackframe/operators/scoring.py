"""JSON requests to feature vectors, predictions to JSON replies. Works on batches and streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from trackframe.functions.columns import is_whole, text_part


def _path(*names: str) -> str:
    return "$" + "".join("['" + n.replace("'", "\\'") + "']" for n in names)


def _field(*names: str, to: str = "variant") -> Column:
    return F.try_variant_get(F.col("message"), _path(*names), to)


def parse_requests(df: DataFrame, text: str = "value") -> DataFrame:
    """Add the envelope fields of a JSON request.

    Echoed fields stay variants, so that a reply repeats them with their type. ``fault`` names
    what makes a request unusable and is NULL otherwise.
    """
    parsed = df.withColumn("message", F.try_parse_json(F.col(text)))
    parsed = parsed.withColumns({
        "app_name": _field("AppName"),
        "command": _field("Command"),
        "reply_id": _field("ReplyId"),
        "version": _field("Parameters", "version"),
        "reply_info": _field("ReplyInfo", to="string"),
    })
    fault = (
        F.when(F.col("message").isNull(), "malformed")
        .when(F.col("app_name").isNull(), "no AppName")
        .when(F.col("command").isNull(), "no Command")
        .when(F.col("version").isNull(), "no version")
    )
    return parsed.withColumns({
        "reply_host": text_part(F.col("reply_info"), ":", 1),
        "reply_port": text_part(F.col("reply_info"), ":", 2).try_cast("int"),
        "fault": fault,
    })


def extract_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add one double column per configured feature, ``features`` in that order, and what is missing.

    A feature that is absent or not a number makes the request unusable.
    """
    out = df.withColumns({f: _field("Parameters", f, to="double") for f in features})
    absent = F.array_compact(F.array(*[F.when(F.col(f).isNull() | F.isnan(f), F.lit(f)) for f in features]))
    out = out.withColumns({"features": F.array(*[F.col(f) for f in features]), "missing_features": absent})
    lacking = F.concat(F.lit("no number for "), F.array_join("missing_features", ","))
    return out.withColumn("fault", F.coalesce("fault", F.when(F.size("missing_features") > 0, lacking)))


def predict(
    df: DataFrame, model: PipelineModel, features: Sequence[str], prediction: str = "predicted_label"
) -> DataFrame:
    """Score the usable rows in one pass; unusable ones come back with a NULL prediction.

    Their features are scored as zeros first, so no stage has to skip or refuse rows.
    """
    usable = F.col("fault").isNull()
    kept = {f"_kept_{f}": F.col(f) for f in features}
    filled = df.withColumns(kept).withColumns({f: F.when(usable, F.col(f)).otherwise(F.lit(0.0)) for f in features})
    scored = model.transform(filled)
    out = scored.withColumn("predicted", F.when(usable, F.col(prediction).cast("string")))
    return out.select(*[F.col(f"_kept_{c}").alias(c) if c in features else F.col(c) for c in df.columns], "predicted")


def predict_foreign(
    df: DataFrame, make_predict: Callable, inputs: Sequence[str], out: str = "predicted", batch_rows: int = 4096
) -> DataFrame:
    """Score with a model of another library, loaded once per worker and called on Arrow batches.

    ``make_predict`` returns a function from a (rows x inputs) array to one number per row.
    """
    call = predict_batch_udf(
        make_predict, return_type=DoubleType(), batch_size=batch_rows, input_tensor_shapes=[[len(inputs)]]
    )
    vector = F.array(*[F.col(c).cast("double") for c in inputs])
    return df.withColumn(out, call(vector))


def reply_json(df: DataFrame, target: str, prediction: str = "predicted") -> DataFrame:
    """Add ``reply``, the JSON answer; NULL where there is no prediction.

    A whole-number prediction becomes a JSON integer, another number a float, the rest text.
    A request without ReplyId gets a reply without one.
    """
    number = F.col(prediction).try_cast("double")

    def answer(value: Column) -> Column:
        return F.to_json(F.struct(
            F.col("app_name").alias("AppName"),
            F.col("command").alias("ReplyForCommand"),
            F.col("reply_id").alias("ReplyId"),
            F.lit("Normal").alias("ReplyStatus"),
            F.struct(value.alias(target), F.col("version").alias("version")).alias("Parameters"),
        ))

    text = (
        F.when(number.isNotNull() & is_whole(number), answer(number.cast("long")))
        .when(number.isNotNull(), answer(number))
        .otherwise(answer(F.col(prediction)))
    )
    return df.withColumn("reply", F.when(F.col(prediction).isNotNull() & F.col("fault").isNull(), text))


def answer_requests(
    df: DataFrame, model: PipelineModel, features: Sequence[str], target: str, text: str = "value"
) -> DataFrame:
    """Request text to outcome: ``outcome`` is ``reply`` or ``dead``, with the reply or the fault."""
    scored = predict(extract_features(parse_requests(df, text), features), model, features)
    replied = reply_json(scored, target)
    return replied.withColumns({
        "outcome": F.when(F.col("reply").isNotNull(), "reply").otherwise("dead"),
        "fault": F.when(F.col("reply").isNull(), F.coalesce("fault", F.lit("no prediction"))),
    }).select(*[F.col(c) for c in df.columns], "outcome", "reply", "reply_host", "reply_port", "fault")
