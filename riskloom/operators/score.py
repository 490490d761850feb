"""Scoring: parse requests, assemble, predict, round, verdict.

Every step is a column expression or MLlib's JVM-side model UDF, so a whole
scoring plan is one map-only stage: no shuffle, no Python workers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from riskloom.functions import (
    parse_double,
    parse_int,
    round_half_even,
    verdict_code,
    verdict_colour,
    verdict_message,
)
from riskloom.operators.model import COMPILED_DEPTH, compiled_prediction
from riskloom.operators.prepare import assemble
from riskloom.specs import DatasetSpec


def parse_requests(
    df: DataFrame,
    spec: DatasetSpec,
    strict: bool = True,
    keep: list[str] | None = None,
    reject_col: str = "rejected",
) -> DataFrame:
    """Text request columns (named like the spec's features) to typed columns.

    Strict: a bad value aborts the job (the reference's ``int()``/``float()``).
    Tolerant: bad values become NULL and ``rejected`` flags the row; a
    missing (NULL) value and NaN are also rejections: they cannot be scored.
    """
    keep = list(keep or [])
    typed = []
    for f in spec.feature_schema.fields:
        if isinstance(f.dataType, IntegerType):
            c = parse_int(f.name, strict)
        else:
            c = parse_double(f.name, strict)
        typed.append(c.alias(f.name))
    out = df.select(*[F.col(k) for k in keep], *typed)
    if strict:
        return out
    bad = F.lit(False)
    for f in spec.feature_schema.fields:
        c = F.col(f.name)
        bad = bad | c.isNull()
        if not isinstance(f.dataType, IntegerType):
            bad = bad | F.coalesce(F.isnan(c), F.lit(False))
    return out.withColumn(reject_col, bad)


def rounded_pairs(pred: DataFrame, label: str, keep: list[str] | None = None) -> DataFrame:
    """(prediction, label) per row, prediction rounded half-to-even to int.

    Replaces the reference's positional zip of two RDD projections of the
    same frame: both values already sit in one row, no join needed.
    """
    keep = list(keep or [])
    return pred.select(
        *[F.col(k) for k in keep],
        round_half_even("prediction").alias("prediction"),
        F.col(label).alias("label"),
    )


def add_verdict(df: DataFrame, spec: DatasetSpec, prediction: str = "prediction") -> DataFrame:
    rule = spec.verdict
    return df.select(
        *df.columns,
        verdict_message(prediction, rule).alias("message"),
        verdict_code(prediction, rule).alias("val"),
        verdict_colour(prediction, rule).alias("colour"),
    )


def score_typed(
    model,
    typed: DataFrame,
    spec: DatasetSpec,
    keep: list[str] | None = None,
    reject_col: str | None = None,
) -> DataFrame:
    """Score typed requests: assemble -> predict -> round -> verdict.

    With ``reject_col``, rejected rows stay in the output with NULL
    prediction and verdict (no row is dropped); valid rows are scored. A
    model of another number of features than the spec's raises. Trees are
    compiled into one expression; deep ones are scored by the model.
    """
    if model.numFeatures != len(spec.features):
        raise ValueError(f"the model has {model.numFeatures} features, {spec.name} has {len(spec.features)}")
    keep = list(keep or [])
    if model.depth <= COMPILED_DEPTH:
        value = compiled_prediction(model, spec.features)
        if not reject_col:  # a value that is missing raises, as the assembler does
            missing = F.lit(False)
            for f in spec.features:
                missing = missing | F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
            value = F.when(missing, F.raise_error(F.lit("a feature is NULL or NaN")).cast("double")).otherwise(value)
        pred = typed.withColumn("prediction", value)
    else:
        pred = model.transform(assemble(typed, spec.features, "features", handle_invalid="keep" if reject_col else "error"))
    rounded = round_half_even("prediction")
    if reject_col:
        rounded = F.when(F.col(reject_col), F.lit(None).cast("int")).otherwise(rounded)
    base = pred.select(
        *[F.col(k) for k in keep],
        *([F.col(reject_col)] if reject_col else []),
        rounded.alias("prediction"),
    )
    out = add_verdict(base, spec)
    if reject_col:
        nullify = [
            F.when(F.col(reject_col), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
            for c in ("message", "val", "colour")
        ]
        out = out.select(*[c for c in out.columns if c not in ("message", "val", "colour")], *nullify)
    return out


def score_requests(
    model,
    requests: DataFrame,
    spec: DatasetSpec,
    strict: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Batch scoring of a table of text requests (all steps in one lazy plan)."""
    typed = parse_requests(requests, spec, strict=strict, keep=keep)
    return score_typed(model, typed, spec, keep=keep, reject_col=None if strict else "rejected")


def score_routed(
    requests: DataFrame,
    routes: dict[str, tuple[DatasetSpec, object]],
    keep: list[str] | None = None,
    dataset: str = "dataset",
    form: str = "form",
) -> DataFrame:
    """One table or stream of requests for several datasets, scored in one pass.

    ``form`` maps a request's field names to text (names of two datasets may
    differ in case only, so they can't be columns side by side); ``dataset``
    names the route. Each row is parsed and scored by its own route alone, in
    one map-only plan. Rows of an unknown or NULL dataset, without a form, or
    with a value that can't be scored stay, rejected, without a verdict.
    """
    keep = list(keep or [])
    typed, at = [], {}
    for n, (name, (spec, _)) in enumerate(routes.items()):
        for i, f in enumerate(spec.feature_schema.fields):
            text = F.when(F.col(dataset) == name, F.col(form)[f.name])
            parsed = parse_int(text, False) if isinstance(f.dataType, IntegerType) else parse_double(text, False)
            at[name, f.name] = f"route{n}_{i}"
            typed.append(parsed.alias(at[name, f.name]))
    rows = requests.select(*[F.col(k) for k in [*keep, dataset]], *typed)
    known, bad, value = F.lit(False), F.lit(False), F.lit(None).cast("double")
    for name, (spec, model) in routes.items():
        own = F.coalesce(F.col(dataset) == name, F.lit(False))
        columns = [at[name, f] for f in spec.features]
        missing = F.lit(False)
        for c in columns:
            missing = missing | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        known, bad = known | own, bad | (own & missing)
        value = F.when(own, compiled_prediction(model, columns)).otherwise(value)
    rejected = ~known | bad
    rounded = F.when(~rejected, round_half_even(value))
    out = rows.select(*keep, dataset, rejected.alias("rejected"), rounded.alias("prediction"))
    verdicts = []
    for column, verdict in (("message", verdict_message), ("val", verdict_code), ("colour", verdict_colour)):
        text = F.lit(None).cast("string")
        for name, (spec, _) in routes.items():
            text = F.when((F.col(dataset) == name) & ~F.col("rejected"), verdict("prediction", spec.verdict)).otherwise(text)
        verdicts.append(text.alias(column))
    return out.select(*out.columns, *verdicts)
