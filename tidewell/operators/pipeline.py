"""The record pipeline: surveillance, times, operation, mapping, contracts; every record ends staged or quarantined, with its evidence."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import content_hash
from ..plans.scratch import spread
from . import mapping as M
from .contracts import validate_contract


def run_pipeline(records: DataFrame, expected: list[str], mappings: list[tuple[str, str, str]]) -> DataFrame:
    """records(payload, provenance, …) with outcome, error_code, raw_hash, mapped, valid_from, valid_to, schema_outcome.

    The first failing step names the error. A quarantined record keeps the hash of its raw payload and has no mapping.
    Stateless, so that it runs on tables and on streams alike.
    """
    schema, _, _, _ = M.schema_surveillance(F.map_keys("payload"), expected, F.lit(None).cast("string"), "1")
    op, op_error = M.operation(F.col("provenance"))
    start, end, time_error = M.validity_interval(F.col("provenance"))
    mapped, map_error = M.map_properties(F.col("payload"), mappings)
    drift = F.when(schema.isin("INCOMPATIBLE", "UNKNOWN_VERSION"), F.concat(F.lit("ING_SCHEMA_"), schema))
    error = F.coalesce(drift, op_error, time_error, map_error)
    return records.select(
        "*", schema.alias("schema_outcome"), error.alias("error_code"), content_hash(F.to_json("payload")).alias("raw_hash"), op.alias("operation"), start.alias("valid_from"), end.alias("valid_to"),
        F.when(error.isNull() & (op == "UPSERT"), mapped).alias("mapped"), F.when(error.isNull(), "STAGED").otherwise("QUARANTINED").alias("outcome"),
    )


@dataclass(frozen=True)
class Config:
    """What a bundle pins for its records; contracts: JSON schemas of envelope, lineage and handoff, where they are to be checked."""

    mappings: list[tuple[str, str, str]]
    refs: dict[str, str]
    schema_id: str = "schema"
    schema_version: str = "1"
    type_code: str = "OBJECT"
    observation_policy: str = "ACQUISITION_TIME"
    change_mode: str = "FULL_SNAPSHOT"
    expected_fields: list[str] | None = None
    labels: list[str] = field(default_factory=list)
    non_blocking: list[str] = field(default_factory=list)
    adapter_id: str = "adapter"
    contracts: dict[str, dict] = field(default_factory=dict)


class Outcomes(NamedTuple):
    zones: DataFrame
    lineage: DataFrame
    handoffs: DataFrame
    attempts: DataFrame
    quarantine: DataFrame
    issues: DataFrame


def key_of(suffix: str) -> Column:
    return F.concat_ws(":", "run_id", "partition_key", "sequence_no", F.lit(suffix))


def id_of(suffix: str) -> Column:
    """An identifier that a repeat of the same record in the same run and place gets again."""
    return F.sha2(F.concat_ws(":", key_of(suffix), "attempt_no"), 256)


def judged(records: DataFrame, cfg: Config) -> DataFrame:
    """records with every document that the pipeline makes of them, error_code, and failed_at: the step that failed.

    records: run_id, partition_key, sequence_no, attempt_no, source_id, bundle_id, bundle_version, bundle_checksum,
    source_object_id, correlation_id, acquired_at (text), payload and provenance (maps of texts). Steps: 1 times of
    observation, before anything is kept; 2 drift, metadata, mapping and envelope, when the raw payload is kept; 3 change
    representation, lineage and handoff, when all three zones are.
    """
    p = F.col("provenance")
    observed, seen_error = M.observation_time(p, F.col("acquired_at"), cfg.observation_policy)
    op, op_error = M.operation(p)
    start, end, time_error = M.validity_interval(p)
    mapped, map_error = M.map_properties(F.col("payload"), cfg.mappings)
    drift = F.lit(None).cast("string")
    if cfg.expected_fields is not None:
        schema, _, _, _ = M.schema_surveillance(F.map_keys("payload"), cfg.expected_fields, F.lit(None).cast("string"), cfg.schema_version)
        drift = F.when(schema == "INCOMPATIBLE", "ING_SCHEMA_INCOMPATIBLE")
    base, seq = F.coalesce(p["baseRevisionRef"], p["baseContentHash"]), p["eventSequence"]
    change_error = F.lit(None).cast("string")
    if cfg.change_mode == "DELTA_PATCH":
        change_error = F.when(base.isNull(), "ING_DELTA_BASE_REQUIRED")
    elif cfg.change_mode == "PROPERTY_EVENTS":
        change_error = F.when(seq.isNull(), "ING_EVENT_SEQUENCE_REQUIRED")
    upsert = F.col("operation") == "UPSERT"
    out = spread(records).select(
        "*", op.alias("operation"), observed.alias("observed_at"), start.alias("valid_from"), end.alias("valid_to"), F.to_json("payload").alias("raw"),
        seen_error.alias("e1"), F.coalesce(drift, op_error, time_error, F.when(op == "UPSERT", map_error)).alias("e2"), change_error.alias("e3"), F.when(op == "UPSERT", mapped).alias("mapped"),
    )
    rev = p["sourceRevision"]
    source_ref = F.coalesce(p["managedObjectRef"], F.concat(F.lit("source-object:"), F.col("source_object_id")))
    out = out.withColumns({"attempt_id": id_of("attempt"), "lineage_id": id_of("lineage"), "handoff_id": id_of("handoff"), "ingestion_id": key_of("ingestion"), "bundle_ref": M.bundle_ref()})
    out = out.withColumn("raw_ref", F.when(F.col("e1").isNull(), F.concat_ws("/", F.lit("RAW"), key_of("raw"))).otherwise(source_ref))
    kept_provenance = F.map_concat(F.map_filter(p, lambda k, v: k != "correlationId"), F.create_map(F.lit("correlationId"), F.col("correlation_id")))
    out = out.withColumn(
        "envelope",
        F.to_json(
            F.struct(
                F.lit("1.0").alias("envelopeVersion"), F.col("ingestion_id").alias("ingestionId"), F.col("run_id").cast("string").alias("runId"), F.col("source_id").alias("sourceId"), F.lit(cfg.type_code).alias("typeCode"),
                F.col("source_object_id").alias("sourceObjectId"), F.lit(cfg.schema_id).alias("sourceSchemaId"), F.lit(cfg.schema_version).alias("sourceSchemaVersion"), F.col("bundle_id").alias("configurationBundleId"),
                F.col("bundle_version").alias("configurationBundleVersion"), F.col("operation"), F.col("observed_at").alias("observedAt"), F.col("acquired_at").alias("acquiredAt"), F.lit("application/json").alias("contentType"),
                F.col("raw_ref").alias("sourceDataRef"), kept_provenance.alias("provenance"), F.col("mapped").alias("data"),
            )
        ),
    )
    tombstone = F.to_json(F.struct("operation", F.col("source_object_id").alias("sourceObjectId"), rev.alias("sourceRevision")))
    out = out.withColumn("curated", F.when(upsert, F.to_json("mapped")).otherwise(tombstone))
    out = out.withColumns({"raw_hash": content_hash(F.col("raw")), "normalized_hash": content_hash(F.col("envelope")), "output_hash": content_hash(F.col("curated"))})
    refs = F.struct(*(F.lit(v).alias(k) for k, v in cfg.refs.items()), F.col("bundle_ref").alias("bundleRef"))
    transforms = F.array(*(F.lit(t) for t in dict.fromkeys(t for _, _, t in cfg.mappings)))
    lineage = F.struct(
        F.col("lineage_id").alias("lineageId"), F.col("run_id").cast("string").alias("ingestionRunId"), F.col("ingestion_id").alias("ingestionId"), F.col("handoff_id").alias("handoffId"),
        F.struct(F.col("source_id").alias("sourceId"), F.lit(cfg.type_code).alias("typeCode"), F.col("source_object_id").alias("sourceObjectId"), F.col("observed_at").alias("sourceObservedAt"), rev.alias("sourceRevision")).alias("source"),
        refs.alias("contracts"), F.struct(F.lit("1.1.0").alias("pipelineVersion"), transforms.alias("transformationIds"), F.col("attempt_id").alias("processingAttemptId")).alias("processing"),
        F.struct(F.col("raw_ref").alias("rawObjectRef"), F.col("raw_hash").alias("rawHash"), F.col("normalized_hash").alias("normalizedHash"), F.col("output_hash").alias("outputHash")).alias("data"),
        F.struct(F.col("acquired_at").alias("acquiredAt"), F.col("acquired_at").alias("processedAt")).alias("times"), F.struct(F.col("correlation_id").alias("correlationId")).alias("trace"),
        F.struct(F.lit("SUCCESS").alias("status"), F.array().cast("array<string>").alias("issueRefs")).alias("outcome"),
    )
    change = F.struct(
        F.lit(cfg.change_mode).alias("mode"), F.when(upsert, F.col("output_hash")).alias("canonicalContentHash"), *(p[k].alias(k) for k in ("baseRevisionRef", "baseContentHash", "eventSequence", "geometryHash", "relationshipsHash", "contractEvidenceHash"))
    )
    labels = F.array(*map(F.lit, cfg.labels)) if cfg.labels else F.lit(None).cast("array<string>")
    handoff = F.struct(
        F.col("handoff_id").alias("handoffId"), F.col("run_id").cast("string").alias("ingestionRunId"), F.col("ingestion_id").alias("ingestionId"),
        F.struct(
            F.col("source_id").alias("sourceId"), F.lit(cfg.type_code).alias("typeCode"), F.col("source_object_id").alias("sourceObjectId"), F.col("observed_at").alias("observedAt"), rev.alias("sourceRevision"),
            F.col("valid_from").alias("validFrom"), F.col("valid_to").alias("validTo"),
        ).alias("sourceIdentity"),
        "operation", F.col("raw_ref").alias("rawObjectRef"), refs.alias("contractRefs"), F.col("lineage_id").alias("lineageId"), F.col("output_hash").alias("contentHash"), F.col("observed_at").alias("occurredAt"),
        F.col("acquired_at").alias("acquiredAt"), change.alias("changeRepresentation"), F.col("correlation_id").alias("correlationId"), F.col("mapped").alias("canonicalPayload"), labels.alias("dataAccessLabels"),
    )
    out = out.withColumns({"lineage": F.to_json(lineage), "handoff": F.to_json(handoff)})
    check = lambda name: validate_contract(F.col(name), cfg.contracts[name])[1] if name in cfg.contracts else F.lit(None).cast("string")
    out = out.withColumn("e2", F.coalesce("e2", check("envelope"))).withColumn("e3", F.coalesce("e3", check("lineage"), check("handoff")))
    failed = F.when(F.col("e1").isNotNull(), 1).when(F.col("e2").isNotNull(), 2).when(F.col("e3").isNotNull(), 3)
    return out.withColumn("error_code", F.coalesce("e1", "e2", "e3")).withColumn("failed_at", failed).drop("e1", "e2", "e3", "mapped")


def process(records: DataFrame, cfg: Config, stage: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> Outcomes:
    """What the pipeline leaves of records: see judged(). stage: how to keep that frame, which all six outcomes read; a written table for more rows than a cluster's disks should cache.

    A record that fails keeps what its steps had written, a FAILED attempt, an open quarantine and an issue, ERROR where it
    blocks; it has no lineage and no handoff. Documents of a zone are told apart by their idempotency keys.
    """
    all_ = stage(judged(records, cfg))
    zone = lambda name, last, content, hash_: all_.where(f"failed_at is null or failed_at > {last}").select(
        F.lit(name).alias("zone"), "run_id", "source_id", "source_object_id", key_of(name.lower()).alias("idempotency_key"), F.col(content).alias("content"), F.col(hash_).alias("content_hash")
    )
    zones = zone("RAW", 1, "raw", "raw_hash").unionByName(zone("NORMALIZED", 2, "envelope", "normalized_hash")).unionByName(zone("CURATED", 2, "curated", "output_hash"))
    good, bad = all_.where("error_code is null"), all_.where("error_code is not null")
    blocking, severity = M.classify_blocking(F.col("error_code"), cfg.non_blocking) if cfg.non_blocking else (F.lit(True), F.lit("ERROR"))
    quarantine_id = id_of("quarantine")
    return Outcomes(
        zones,
        good.select("lineage_id", "run_id", "attempt_id", "source_object_id", "bundle_ref", F.col("lineage").alias("evidence")),
        good.select("handoff_id", "run_id", "lineage_id", "partition_key", "sequence_no", key_of("handoff").alias("idempotency_key"), F.col("handoff").alias("payload"), F.lit("READY").alias("state")),
        all_.select("attempt_id", "run_id", "source_object_id", "attempt_no", F.lit(cfg.adapter_id).alias("adapter_id"), "bundle_version", F.when(F.col("error_code").isNull(), "SUCCEEDED").otherwise("FAILED").alias("state"), F.col("error_code").alias("reason_code")),
        bad.select(
            quarantine_id.alias("quarantine_id"), "run_id", "attempt_id", "source_object_id", F.col("error_code").alias("reason_code"), F.col("raw_ref").alias("payload_ref"),
            F.concat(F.lit("contract-or-mapping:"), F.col("error_code")).alias("evidence_ref"), F.lit("OPEN").alias("lifecycle_state"), blocking.alias("blocking"), "correlation_id",
        ),
        bad.select(
            id_of("issue").alias("issue_id"), "run_id", "source_id", F.lit(cfg.type_code).alias("type_code"), severity.alias("severity"), F.lit("ING_RECORD_QUARANTINED").alias("issue_code"),
            F.concat(F.lit("quarantine:"), quarantine_id).alias("evidence_ref"), F.lit("OPEN").alias("status"),
        ),
    )


def compatibility_report(records: DataFrame, cfg: Config) -> DataFrame:
    """One row: status, validated_rows, error_code, content_hash of a dry run over all rows; nothing is kept.

    Every row must hold the expected fields and pass mapping, times and the three contracts; no row at all proves
    nothing. content_hash: over the sorted hashes of all rows' raw payloads, folded as sums, so that no task holds them.
    """
    checked = judged(records, cfg)
    digest = F.conv(F.substring(F.sha2("raw", 256), 1, 12), 16, 10).cast("decimal(38,0)")
    if cfg.expected_fields is not None:
        missing = F.size(F.array_except(F.array(*map(F.lit, cfg.expected_fields)), F.map_keys("payload"))) > 0
        checked = checked.withColumn("error_code", F.when(missing, "ING_SCHEMA_INCOMPATIBLE").otherwise(F.col("error_code")))
    n, e = F.count("*"), F.min("error_code")
    code = F.when(n == 0, "ING_COMPAT_EMPTY_ASSET_UNPROVEN").otherwise(e)
    return checked.agg(
        F.when(code.isNull(), "PASS").otherwise("FAIL").alias("status"), n.alias("validated_rows"), code.alias("error_code"), content_hash(F.coalesce(F.sum(digest), F.lit(0)).cast("string")).alias("content_hash")
    )
