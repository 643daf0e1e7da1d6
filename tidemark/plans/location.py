"""Location pipeline (batch): records -> decode -> watermark -> on-time
tumbling sum/count per location, plus the late side output and the quarantine
of undecodable records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.decode import parse_payload
from tidemark.operators.watermark import watermark_trace
from tidemark.operators.windows import tumbling_sum_count
from tidemark.presets import REF, Preset


@dataclass
class LocationOutputs:
    main: DataFrame          # windowStart, windowEnd, location, eventsPerWindow, sumPerWindow
    late: DataFrame          # late records, unchanged, with the watermark they met
    invalid: DataFrame       # quarantined (undecodable) records
    trace: DataFrame         # every record with watermark / windowEnd / late
    observation: Observation | None


def location_pipeline(records: DataFrame, preset: Preset = REF, scope: str = "global",
                      partitions=None, payload_col: str = "value", **trace_kw) -> LocationOutputs:
    """Payloads are decoded before the watermark's shuffle, so the main output
    moves the decoded fields and not the payload. Undecodable records stay in the
    trace: they advance the watermark and count as late or on time like any other."""
    typed, broken = parse_payload(F.col(payload_col))
    parsed = records.select("*", typed.alias("_m"), broken.alias("_invalid"))
    traced = watermark_trace(parsed, preset.out_of_orderness_ms, preset.window_ms,
                             scope=scope, partitions=partitions, **trace_kw)
    observation = Observation("decode")
    counted = traced.observe(observation, F.count_if(F.col("_invalid")).alias("numInvalidRecords"))
    on_time = counted.filter(~F.col("_invalid") & ~F.col("late")).select("seq", "timestamp", "partition", "_m.*")
    trace = traced.drop("_m", "_invalid")
    # the trace holds every record, so its columns need no parse
    late = trace.filter(F.col("late")).drop("late")
    invalid = (traced.filter(F.col("_invalid"))
               .drop("_m", "_invalid", "late", "watermark", "windowEnd"))
    return LocationOutputs(tumbling_sum_count(on_time, preset.window_ms), late, invalid, trace, observation)
