"""Records to canonical documents: property mapping, envelopes, lineage, handoffs and their times, as projections.

Functions add columns and an error code instead of failing rows; payload and provenance are MAP<STRING,STRING>, so
that a present null stays apart from an absent field.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import content_hash, iso_micros

#: Registry of transforms: name to Column function.
TRANSFORMS = {"IDENTITY": lambda c: c}
OFFSET_TIME = r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{1,9})?)?(Z|[+-]\d\d:\d\d)$"


def first_error(*codes: Column) -> Column:
    return F.coalesce(*codes)


def map_properties(payload: Column, mappings: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(mapped, error_code) for mappings (source field, target IRI, transform).

    A later mapping of the same target is an error only if an earlier one gave it a value.
    """
    unknown = next((t for _, _, t in mappings if t not in TRANSFORMS), None)
    if not mappings or unknown is not None:
        return F.lit(None).cast("map<string,string>"), F.lit("ING_TRANSFORM_UNSUPPORTED" if unknown is not None else "ING_MAPPING_EMPTY")
    value = lambda f, t: TRANSFORMS[t](payload[f])
    codes, seen = [], {}
    for source, target, transform in mappings:
        codes.append(F.when(~F.map_contains_key(payload, source), "ING_MAPPING_SOURCE_FIELD_MISSING"))
        if target in seen:
            codes.append(F.when(reduce(lambda a, b: a | b, [v.isNotNull() for v in seen[target]]), "ING_MAPPING_TARGET_DUPLICATE"))
        seen.setdefault(target, []).append(value(source, transform))
    error = F.coalesce(*codes)
    mapped = F.map_from_arrays(F.array(*map(F.lit, seen)), F.array(*(v[-1] for v in seen.values())))
    return F.when(error.isNull(), mapped), error


def utc_text(c: Column) -> Column:
    """An ISO date-time with an offset as UTC text, null if it is none."""
    return F.when(c.rlike(OFFSET_TIME), iso_micros(F.try_to_timestamp(c)))


def observation_time(provenance: Column, acquired_at: Column, policy: str) -> tuple[Column, Column]:
    if policy == "ACQUISITION_TIME":
        return acquired_at, F.lit(None).cast("string")
    given = provenance["observedAt"]
    code = F.when(given.isNull(), "ING_OBSERVED_AT_MISSING").when(utc_text(given).isNull(), "ING_OBSERVED_AT_INVALID")
    return utc_text(given), code


def validity_interval(provenance: Column) -> tuple[Column, Column, Column]:
    a, b = provenance["validFrom"], provenance["validTo"]
    bad = (a.isNotNull() & utc_text(a).isNull()) | (b.isNotNull() & utc_text(b).isNull())
    code = F.when(bad, "ING_TEMPORAL_METADATA_INVALID").when(utc_text(b) < utc_text(a), "ING_VALID_TIME_INVALID")
    return utc_text(a), utc_text(b), code


def operation(provenance: Column) -> tuple[Column, Column]:
    op = F.coalesce(provenance["operation"], F.lit("UPSERT"))
    return op, F.when(~op.isin("UPSERT", "DELETE", "TOMBSTONE"), "ING_OPERATION_UNSUPPORTED")


def tombstone_projection(op: Column, object_id: Column, provenance: Column) -> Column:
    return F.when(op.isin("DELETE", "TOMBSTONE"), F.to_json(F.struct(op.alias("operation"), object_id.alias("sourceObjectId"), provenance["sourceRevision"].alias("sourceRevision"))))


def change_representation(provenance: Column, mode: Column) -> tuple[Column, Column]:
    """(JSON, error_code): FULL_SNAPSHOT by default; a patch needs a base, events need their sequence."""
    m = F.coalesce(mode, F.lit("FULL_SNAPSHOT"))
    rev, base, seq = provenance["baseRevisionRef"], provenance["baseContentHash"], provenance["eventSequence"]
    code = F.when((m == "DELTA_PATCH") & rev.isNull() & base.isNull(), "ING_DELTA_BASE_REQUIRED").when((m == "PROPERTY_EVENTS") & seq.isNull(), "ING_EVENT_SEQUENCE_REQUIRED")
    only = lambda c, k: F.when(m == k, c)
    body = F.struct(m.alias("mode"), only(rev, "DELTA_PATCH").alias("baseRevisionRef"), only(base, "DELTA_PATCH").alias("baseContentHash"), only(seq, "PROPERTY_EVENTS").alias("eventSequence"))
    return F.when(code.isNull(), F.to_json(body)), code


def bundle_ref() -> Column:
    return F.concat_ws(":", "bundle_id", "bundle_version", "bundle_checksum")


def idempotency_key(suffix: Column | str = "handoff") -> Column:
    return F.concat_ws(":", "run_id", "partition_key", "sequence_no", F.lit(suffix) if isinstance(suffix, str) else suffix)


def build_envelope(op: Column, data: Column) -> Column:
    """Envelope 1.0 of the columns run_id, source_id, source_object_id, observed_at, acquired_at, correlation_id; data only for UPSERT."""
    return F.to_json(
        F.struct(
            F.lit("1.0").alias("envelopeVersion"), F.col("run_id").cast("string").alias("runId"), F.col("source_id").alias("sourceId"), F.col("source_object_id").alias("sourceObjectId"),
            op.alias("operation"), F.col("observed_at").alias("observedAt"), F.col("acquired_at").alias("acquiredAt"), F.lit("application/json").alias("contentType"),
            F.when(op == "UPSERT", data).alias("data"), F.struct(F.col("correlation_id").alias("correlationId")).alias("provenance"),
        )
    )


def build_lineage(raw: Column, normalized: Column, output: Column, transforms: Column) -> Column:
    return F.to_json(
        F.struct(
            F.struct(F.col("source_id").alias("sourceId"), F.col("source_object_id").alias("sourceObjectId")).alias("source"),
            F.struct(F.lit("1.1.0").alias("pipelineVersion"), F.array_distinct(transforms).alias("transformationIds")).alias("processing"),
            F.struct(content_hash(raw).alias("rawHash"), content_hash(normalized).alias("normalizedHash"), content_hash(output).alias("outputHash")).alias("data"),
            F.struct(F.col("correlation_id").alias("correlationId")).alias("trace"), F.struct(F.lit("SUCCESS").alias("status")).alias("outcome"),
        )
    )


def build_handoff(op: Column, canonical: Column, labels: Column) -> Column:
    return F.to_json(
        F.struct(
            F.struct(F.col("source_id").alias("sourceId"), F.col("source_object_id").alias("sourceObjectId")).alias("sourceIdentity"), op.alias("operation"),
            F.when(op == "UPSERT", canonical).alias("canonicalPayload"), content_hash(canonical).alias("contentHash"), F.when(F.size(labels) > 0, labels).alias("dataAccessLabels"),
        )
    )


def schema_surveillance(fields: Column, expected: list[str], observed_version: Column, version: str) -> tuple[Column, Column, Column, Column]:
    """(outcome, checksum, added, missing) of the field names of a record against the expected ones."""
    want = F.array(*map(F.lit, sorted(expected)))
    added, missing = F.array_sort(F.array_except(fields, want)), F.array_sort(F.array_except(want, fields))
    outcome = F.when(observed_version.isNotNull() & (observed_version != version), "UNKNOWN_VERSION").when(F.size(missing) > 0, "INCOMPATIBLE").when(F.size(added) > 0, "COMPATIBLE_ADDITIVE").otherwise("MATCH")
    return outcome, content_hash(F.array_join(F.array_sort(fields), "\n")), added, missing


def observe_schema(records: DataFrame) -> DataFrame:
    """Upsert counts per (source, type, checksum, versions), nulls equal; run_id is the first observer's."""
    key = ["source_id", "type_code", "schema_checksum", "expected_version", "observed_version"]
    return records.groupBy(*key).agg(F.count("*").alias("observation_count"), F.min("observed_at").alias("first_observed_at"), F.max("observed_at").alias("last_observed_at"), F.min_by("run_id", F.struct("observed_at", "run_id")).alias("run_id"))


def sensitive_key(m: Column) -> Column:
    return F.exists(F.map_keys(m), lambda k: F.lower(k).rlike("(url|credential|password|secret|token)"))


def classify_blocking(code: Column, non_blocking: list[str]) -> tuple[Column, Column]:
    blocking = ~F.array_contains(F.array(*map(F.lit, non_blocking)), code)
    return blocking, F.when(blocking, "ERROR").otherwise("WARNING")


def stamped(df: DataFrame, error: Column, **values: Column) -> DataFrame:
    return df.withColumns({**values, "error_code": error})


#: How many key fields each identity policy takes.
POLICIES = {"NATIVE_KEY": (1, 1), "COMPOSITE": (2, None), "MANAGED_DETERMINISTIC": (0, 0)}


def source_identity(policy: str, source: Column, fields: dict[str, Column], asset_hash: Column | None = None, sheet: Column | None = None, ordinal: Column | None = None) -> tuple[Column, Column]:
    """(object_id, error_code) by policy: one native key, several, or the row's place in its asset."""
    from ..functions import scalar as S

    least, most = POLICIES[policy]
    if len(fields) < least or most is not None and len(fields) > most:
        raise ValueError("ING_SOURCE_IDENTITY_POLICY_INVALID")
    if policy == "MANAGED_DETERMINISTIC":
        return S.managed_row_id(source, asset_hash, sheet, ordinal), F.lit(None).cast("string")
    key = S.managed_key_id(source, fields)
    return key, F.when(key.isNull(), "ING_MANAGED_IDENTITY_MISSING")
