"""Decoding of JSON measurement payloads.

The tolerant decoder follows the rules of a typed JSON object mapper:

* unknown fields and trailing text after the object are accepted;
* numbers given as text (``"value": "2.5"``) are coerced, fractional ids are
  truncated (``1.7 -> 1``);
* a whole-number field given as *text* must be a whole number: ``1.7`` is 1,
  ``"1.7"`` and ``"1e3"`` are invalid;
* absent or ``null`` numeric fields become 0, and so does empty or blank text;
* anything else is *invalid*: unparsable bytes, a non-object (``[1]``,
  ``null``), empty input, ``NaN``/``Infinity`` literals, numeric text that does
  not parse, and a missing location (the grouping key).

Parsing reads every field as STRING: Spark renders a non-string token as its
JSON text there, so the cast after parsing decides validity the same way for
``2.5`` and ``"2.5"``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

CORRUPT = "_corrupt"
PRUNED_FIELDS = ("sensorId", "value", "location")
FULL_FIELDS = PRUNED_FIELDS + ("measurementInformation",)
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowNonNumericNumbers": "false",
}


def _text_schema(fields) -> str:
    return ", ".join(f"{f} STRING" for f in fields) + f", {CORRUPT} STRING"


def _is_text(payload: Column, field: str) -> Column:
    """Whether a field is a JSON string (its token kind is lost in the text)."""
    tree = F.try_parse_json(payload.cast("string"))
    return F.coalesce(F.schema_of_variant(F.try_variant_get(tree, f"$.{field}", "variant")) == "STRING", F.lit(False))


def _as_int(text: Column) -> Column:
    return text.try_cast("double").try_cast("int")


def parse_payload(payload: Column, fields=PRUNED_FIELDS) -> tuple[Column, Column]:
    """``(struct of typed fields, invalid flag)`` for a payload column (bytes
    or text)."""
    parsed = F.from_json(payload.cast("string"), _text_schema(fields), JSON_OPTIONS)
    sid, val = parsed["sensorId"], parsed["value"]
    place = parsed["location"]
    # the few rows whose text leaves the token kind open are looked at again:
    # an object or array is no location, and a text like "1.7" no whole number
    nested = F.when(place.rlike(r"^[\[{]"), ~_is_text(payload, "location")).otherwise(False)
    broken = F.when(sid.rlike("[.eE]"), _is_text(payload, "sensorId")).otherwise(False)
    invalid = (
        parsed.isNull()
        | parsed[CORRUPT].isNotNull()
        | (sid.isNotNull() & (F.trim(sid) != "") & _as_int(sid).isNull())
        | (val.isNotNull() & (F.trim(val) != "") & val.try_cast("double").isNull())
        | place.isNull() | nested | broken
    )
    typed = [
        F.coalesce(_as_int(sid), F.lit(0)).alias("sensorId"),
        F.coalesce(val.try_cast("double"), F.lit(0.0)).alias("value"),
        parsed["location"].alias("location"),
    ]
    if "measurementInformation" in fields:
        typed.append(parsed["measurementInformation"].alias("measurementInformation"))
    return F.struct(*typed), F.coalesce(invalid, F.lit(True))


def with_decoded(df: DataFrame, payload_col: str = "value", fields=PRUNED_FIELDS,
                 keep=("seq", "timestamp", "partition")) -> DataFrame:
    """``keep`` columns + decoded fields + ``_invalid``. The payload column is
    replaced by the decoded fields."""
    typed, invalid = parse_payload(F.col(payload_col), fields)
    cols = [c for c in keep if c in df.columns]
    return (df.select(*cols, typed.alias("_m"), invalid.alias("_invalid"))
              .select(*cols, "_m.*", "_invalid"))


@dataclass
class Decoded:
    valid: DataFrame        # rows that decoded, ``_invalid`` dropped
    invalid: DataFrame      # quarantine: the rows that did not (payload kept)
    observation: Observation | None  # batch counter ``numInvalidRecords``


def tolerant_decode(df: DataFrame, payload_col: str = "value", fields=PRUNED_FIELDS,
                    keep=("seq", "timestamp", "partition"), metric_name: str = "decode",
                    streaming: bool | None = None) -> Decoded:
    """Decode, drop and count invalid records.

    The invalid count is collected with ``observe`` on the decoded frame: in a
    batch job through an :class:`Observation` (read ``observation.get`` after
    an action on ``valid``), in a stream through the query progress
    (``observedMetrics[metric_name]``).
    """
    typed, broken = parse_payload(F.col(payload_col), fields)
    decoded = df.select("*", typed.alias("_m"), broken.alias("_invalid"))
    counter = F.count_if(F.col("_invalid")).alias("numInvalidRecords")
    streaming = df.isStreaming if streaming is None else streaming
    observation = None
    if streaming:
        decoded = decoded.observe(metric_name, counter)
    else:
        observation = Observation(metric_name)
        decoded = decoded.observe(observation, counter)
    # both outputs filter the counted frame: the counter keeps the filter above
    # the parse, which therefore runs once per row
    valid = decoded.filter(~F.col("_invalid")).select(*[c for c in keep if c in df.columns], "_m.*")
    quarantine = decoded.filter(F.col("_invalid")).select(*df.columns)
    return Decoded(valid, quarantine, observation)


def invalid_count(df: DataFrame, payload_col: str = "value", fields=PRUNED_FIELDS) -> DataFrame:
    """One row: ``numInvalidRecords`` over the whole input (data-level twin of
    the counter)."""
    _, invalid = parse_payload(F.col(payload_col), fields)
    return df.select(F.count_if(invalid).alias("numInvalidRecords"))


def strict_decode(df: DataFrame, payload_col: str = "value", fields=FULL_FIELDS,
                  keep=("seq", "timestamp", "partition")) -> DataFrame:
    """Fail-fast decode: the first malformed record fails the job."""
    schema = ", ".join(f"{f} {'INT' if f == 'sensorId' else 'DOUBLE' if f == 'value' else 'STRING'}"
                       for f in fields)
    parsed = F.from_json(F.col(payload_col).cast("string"), schema,
                         {"mode": "FAILFAST", "allowNonNumericNumbers": "false"})
    cols = [c for c in keep if c in df.columns]
    return df.select(*cols, parsed.alias("_m")).select(*cols, "_m.*")


def dynamic_decode(df: DataFrame, payload_col: str = "value",
                   keep=("seq", "timestamp", "partition")) -> DataFrame:
    """Untyped decode to a VARIANT tree (``payload``); unparsable records are
    dropped. Fields are read with ``try_variant_get``; prefer the typed
    decoders on hot paths."""
    v = F.try_parse_json(F.col(payload_col).cast("string"))
    cols = [c for c in keep if c in df.columns]
    return df.select(*cols, v.alias("payload")).filter(F.col("payload").isNotNull())


def variant_double(payload: str, path: str) -> Column:
    """Numeric field of a VARIANT as double, text coerced (``"2.5" -> 2.5``)."""
    return F.try_variant_get(F.col(payload), path, "double")


def encode_payload(sensor_id, value, location, info=None) -> Column:
    """Measurement -> JSON bytes."""
    fields = [sensor_id.alias("sensorId"), value.alias("value"), location.alias("location")]
    if info is not None:
        fields.append(info.alias("measurementInformation"))
    return F.to_json(F.struct(*fields)).cast("binary")
