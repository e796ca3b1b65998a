"""Projection, filtering and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import REQUEST

# Fixed values of the reference: feature sets and accepted request values.
SEQUENCE_FEATURES = ["close", "volume", "MA_5", "MA_20", "RSI", "BB_Upper", "BB_Lower"]
LINEAR_FEATURES = ["MA_5", "MA_20", "RSI", "Volume_MA"]
MODEL_TYPES = ["lstm", "prophet", "arima"]
SERVED_TYPES = [*MODEL_TYPES, "linear"]  # the linear model is served here as well
DEFAULT_SYMBOL = "AAPL"
DEFAULT_MODEL_TYPE = "lstm"
DEFAULT_DAYS_AHEAD = 1
MAX_DAYS_AHEAD = 30


def select_features(df: DataFrame, features=SEQUENCE_FEATURES,
                    keys=("symbol", "date")) -> DataFrame:
    """Keys plus the model features, as doubles."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in ``subset`` (default: all columns).

    Positional operators applied afterwards number the surviving rows.
    """
    cols = list(subset) if subset else df.columns
    return df.na.drop(how="any", subset=cols)


def to_ds_y(df: DataFrame, date: str = "date", value: str = "close") -> DataFrame:
    """``(symbol, ds, y)`` projection."""
    return df.select("symbol", F.col(date).alias("ds"), F.col(value).cast("double").alias("y"))


def select_by_prefix(df: DataFrame, prefixes=("MA_", "RSI", "BB_"), keys=("symbol", "date")) -> DataFrame:
    """Keys plus every column starting with one of ``prefixes``."""
    picked = [c for c in df.columns if c.startswith(tuple(prefixes))]
    return df.select(*keys, *picked)


def quarantine(bars: DataFrame, universe: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """P5: split bars into ``good`` rows and ``rejected(symbol, date, reason)``.

    Rules: NULL or non-positive close, high below low, duplicate (symbol, date),
    symbol absent from ``universe(symbol)``. Duplicates are found with lag/lead
    over the per-symbol date order, which shares its exchange with the
    indicator window; the universe is matched with a left join that the
    planner broadcasts only when the universe is measured small.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    reasons = [
        F.when(F.col("close").isNull() | F.isnan("close") | (F.col("close") <= 0), F.lit("non_positive_price")),
        F.when(F.col("high") < F.col("low"), F.lit("high_below_low")),
        F.when((F.lag("date").over(w) == F.col("date")) | (F.lead("date").over(w) == F.col("date")),
               F.lit("duplicate_bar")),
    ]
    df = bars
    if universe is not None:
        u = universe.select(F.col("symbol").alias("_u_symbol")).distinct()
        df = df.join(u, df.symbol == u._u_symbol, "left")
        reasons.append(F.when(F.col("_u_symbol").isNull(), F.lit("unknown_symbol")))
    flagged = df.withColumn("_reasons", F.filter(F.array(*reasons), lambda r: r.isNotNull()))
    if universe is not None:
        flagged = flagged.drop("_u_symbol")
    good = flagged.where(F.size("_reasons") == 0).drop("_reasons")
    rejected = flagged.where(F.size("_reasons") > 0).select(
        "symbol", "date", F.explode("_reasons").alias("reason"))
    return good, rejected


def validate_requests(req: DataFrame, max_days: int = MAX_DAYS_AHEAD) -> DataFrame:
    """Normalise prediction requests; invalid ones carry ``error``.

    symbol upper-cased (default AAPL), model type lower-cased (default lstm), days_ahead
    defaults to 1 and is capped at ``max_days`` (``requested_days`` keeps what was asked);
    unknown model types and bodies that did not parse (``parse_error``) are errors.
    """
    mt = F.lower(F.coalesce(F.col("model_type"), F.lit(DEFAULT_MODEL_TYPE)))
    asked = F.col("days_ahead").cast("int")
    error = F.when(~mt.isin(SERVED_TYPES), F.concat(F.lit("Unsupported model type: "), mt))
    parsed = "parse_error" in req.columns
    if parsed:
        error = F.coalesce(F.col("parse_error"), error)

    def unless_broken(c):
        return F.when(F.col("parse_error").isNull(), c) if parsed else c

    return req.select(
        *[c for c in req.columns if c not in ("symbol", "model_type", "days_ahead", "parse_error")],
        unless_broken(F.upper(F.coalesce(F.col("symbol"), F.lit(DEFAULT_SYMBOL)))).alias("symbol"),
        unless_broken(mt).alias("model_type"), asked.alias("requested_days"),
        unless_broken(F.least(F.coalesce(asked, F.lit(DEFAULT_DAYS_AHEAD)), F.lit(max_days))).alias("days_ahead"),
        error.alias("error"))


def parse_request_body(df: DataFrame, body: str = "body") -> DataFrame:
    """A JSON string body, or an already parsed struct, → request columns and ``parse_error``
    (a body that is no JSON object, or whose days_ahead is no number). A null body asks for the
    defaults."""
    keep = [c for c in df.columns if c != body]
    if isinstance(df.schema[body].dataType, T.StructType):
        return df.select(*keep, *[F.col(f"{body}.{c}").cast(t).alias(c) for c, t in (
            ("symbol", "string"), ("model_type", "string"), ("days_ahead", "int"))], F.lit(None).cast("string").alias("parse_error"))
    broken = T.StructType([*REQUEST.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json(F.col(body), broken, {"columnNameOfCorruptRecord": "_broken"})
    bad = F.col(body).isNotNull() & (parsed["_broken"].isNotNull() | parsed.isNull())
    return df.select(*keep, *[parsed[c].alias(c) for c in ("symbol", "model_type", "days_ahead")],
                     F.when(bad, F.lit("Malformed request body")).alias("parse_error"))
