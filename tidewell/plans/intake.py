"""Queries over records: identities, schema surveillance, mapping and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import contracts, mapping as M
from ..operators import pipeline
from ..operators import policies as P
from ..operators import reports as R
from .registry import query
from .scratch import spread, written


def payloads(records: DataFrame) -> DataFrame:
    """records with payload: name and segment, less the name where variant % 5 = 1, plus an extra field where variant % 5 = 2; and provenance."""
    base = F.create_map(F.lit("id"), F.col("id"), F.lit("segment"), F.col("segment"))
    name, extra = F.create_map(F.lit("name"), F.col("name")), F.create_map(F.lit("extra"), F.lit("x"))
    v = F.col("variant") % 5
    payload = F.when(v == 1, base).when(v == 2, F.map_concat(base, name, extra)).otherwise(F.map_concat(base, name))
    op = F.when(F.col("variant") == 7, "DELETE").when(F.col("variant") == 8, "SNAPSHOT_RECORD").otherwise(F.lit(None).cast("string"))
    start = F.when(F.col("variant") == 3, "2025-01-01T00:00:00+01:00").when(F.col("variant") == 4, "not a time").otherwise("2025-06-01T00:00:00Z")
    end = F.when(F.col("variant") == 5, "2024-01-01T00:00:00Z").otherwise("2026-01-01T00:00:00Z")
    seen = F.when(F.col("variant") == 9, F.lit(None).cast("string")).when(F.col("variant") == 10, "2025-13-01").otherwise("2025-02-03T04:05:06+02:00")
    seq = F.when(F.col("variant") % 3 == 0, F.col("id"))
    prov = {"operation": op, "validFrom": start, "validTo": end, "observedAt": seen, "eventSequence": seq, "baseRevisionRef": F.when(F.col("variant") % 4 == 0, F.col("id")), "baseContentHash": F.lit(None).cast("string"), "sourceRevision": F.col("nation")}
    return records.withColumn("payload", payload).withColumn("provenance", F.create_map(*[x for k, c in prov.items() for x in (F.lit(k), c)]))


FIELDS_SQL = "CASE variant % 5 WHEN 1 THEN ['id','segment'] WHEN 2 THEN ['extra','id','name','segment'] ELSE ['id','name','segment'] END"


@query("SELECT ordinal, concat('managed:', sha256(concat_ws(chr(31), source_id, 'KEY', concat('id=', id), concat('name=', name)))) AS object_id FROM records", "records")
def source_identity_key(records):
    return records.select("ordinal", S.managed_key_id(F.col("source_id"), {"id": F.col("id"), "name": F.col("name")}).alias("object_id"))


@query("SELECT ordinal, concat('managed:', sha256(concat_ws(chr(31), source_id, 'ROW', sha256(name), 'sheet', CAST(ordinal AS STRING)))) AS object_id FROM records", "records")
def source_identity_row(records):
    return records.select("ordinal", S.managed_row_id(F.col("source_id"), F.sha2("name", 256), F.lit("sheet"), F.col("ordinal")).alias("object_id"))


@query("SELECT ordinal, concat('native:', sha256(concat_ws(chr(31), source_id, segment, concat('id=', id)))) AS object_id FROM records", "records")
def native_id(records):
    return records.select("ordinal", S.native_id(F.col("source_id"), F.col("segment"), {"id": F.concat(F.lit(" \t"), F.col("id"), F.lit("\n"))}).alias("object_id"))


@query("""SELECT ordinal, concat('managed-gpkg:', sha256(concat('GPKG1', length(source_id), ':', source_id, length(segment), ':', segment, '2:id', length(id), ':', id))) AS object_id FROM records""", "records")
def layer_feature_id(records):
    return records.select("ordinal", S.layer_feature_id(F.col("source_id"), F.col("segment"), {"id": F.col("id")}).alias("object_id"))


@query("SELECT source_id, nation, count(*) AS n FROM records GROUP BY ALL HAVING count(*) > 1", "records")
def duplicate_identities(records):
    return P.duplicate_identities(records, "source_id", "nation")


@query(f"""SELECT ordinal, CASE WHEN variant = 11 THEN 'UNKNOWN_VERSION' WHEN variant % 5 = 1 THEN 'INCOMPATIBLE' WHEN variant % 5 = 2 THEN 'COMPATIBLE_ADDITIVE' ELSE 'MATCH' END AS outcome,
 concat('sha256:', sha256(array_to_string({FIELDS_SQL}, chr(10)))) AS checksum FROM records""", "records")
def schema_surveillance(records):
    p = payloads(records)
    outcome, checksum, _, _ = M.schema_surveillance(F.map_keys("payload"), ["id", "name", "segment"], F.when(F.col("variant") == 11, "9").otherwise("1"), "1")
    return p.select("ordinal", outcome.alias("outcome"), checksum.alias("checksum"))


@query("""SELECT ordinal, CASE variant % 5 WHEN 2 THEN 'extra' ELSE '' END AS added, CASE variant % 5 WHEN 1 THEN 'name' ELSE '' END AS missing FROM records""", "records")
def field_set_diff(records):
    _, _, added, missing = M.schema_surveillance(F.map_keys("payload"), ["id", "name", "segment"], F.lit(None).cast("string"), "1")
    return payloads(records).select("ordinal", F.array_join(added, ",").alias("added"), F.array_join(missing, ",").alias("missing"))


@query(f"""SELECT source_id, segment AS type_code, concat('sha256:', sha256(array_to_string({FIELDS_SQL}, chr(10)))) AS schema_checksum, '1' AS expected_version, CASE WHEN variant = 11 THEN '9' END AS observed_version,
 count(*) AS observation_count, min(ordinal) AS first_observed_at, max(ordinal) AS last_observed_at, min(ordinal) * 10 AS run_id FROM records GROUP BY ALL""", "records")
def observe_schema(records):
    p = payloads(records).select(
        "source_id", F.col("segment").alias("type_code"), S.content_hash(F.array_join(F.array_sort(F.map_keys("payload")), "\n")).alias("schema_checksum"), F.lit("1").alias("expected_version"),
        F.when(F.col("variant") == 11, "9").alias("observed_version"), F.col("ordinal").alias("observed_at"), (F.col("ordinal") * 10).alias("run_id"),
    )
    return M.observe_schema(p)


MAPPINGS = [("id", "https://example.test/id", "IDENTITY"), ("name", "https://example.test/name", "IDENTITY")]


@query("""SELECT ordinal, CASE WHEN variant % 5 = 1 THEN NULL ELSE id END AS id, CASE WHEN variant % 5 = 1 THEN NULL ELSE name END AS name, CASE WHEN variant % 5 = 1 THEN 'ING_MAPPING_SOURCE_FIELD_MISSING' END AS error_code FROM records""", "records")
def map_properties(records):
    mapped, error = M.map_properties(F.col("payload"), MAPPINGS)
    p = payloads(records).withColumn("m", mapped)
    return p.select("ordinal", F.col("m")["https://example.test/id"].alias("id"), F.col("m")["https://example.test/name"].alias("name"), error.alias("error_code"))


@query("""SELECT ordinal, CASE WHEN variant = 9 OR variant = 10 THEN NULL ELSE '2025-02-03T02:05:06.000000Z' END AS observed_at, CASE variant WHEN 9 THEN 'ING_OBSERVED_AT_MISSING' WHEN 10 THEN 'ING_OBSERVED_AT_INVALID' END AS error_code FROM records""", "records")
def observation_time(records):
    at, code = M.observation_time(F.col("provenance"), F.lit("x"), "PROVENANCE_OBSERVED_AT")
    return payloads(records).select("ordinal", at.alias("observed_at"), code.alias("error_code"))


@query("""SELECT ordinal, CASE variant WHEN 3 THEN '2024-12-31T23:00:00.000000Z' WHEN 4 THEN NULL ELSE '2025-06-01T00:00:00.000000Z' END AS valid_from, CASE variant WHEN 4 THEN 'ING_TEMPORAL_METADATA_INVALID' WHEN 5 THEN 'ING_VALID_TIME_INVALID' END AS error_code FROM records""", "records")
def validity_interval(records):
    a, _, code = M.validity_interval(F.col("provenance"))
    return payloads(records).select("ordinal", a.alias("valid_from"), code.alias("error_code"))


@query("""SELECT ordinal, CASE variant WHEN 7 THEN concat('{"operation":"DELETE","sourceObjectId":"', id, '","sourceRevision":"', nation, '"}') END AS tombstone, CASE variant WHEN 8 THEN 'ING_OPERATION_UNSUPPORTED' END AS error_code FROM records""", "records")
def tombstone_projection(records):
    op, code = M.operation(F.col("provenance"))
    return payloads(records).select("ordinal", M.tombstone_projection(op, F.col("id"), F.col("provenance")).alias("tombstone"), code.alias("error_code"))


@query("""SELECT ordinal, CASE ordinal % 3 WHEN 0 THEN '{"mode":"FULL_SNAPSHOT"}' WHEN 1 THEN CASE WHEN variant % 4 = 0 THEN concat('{"mode":"DELTA_PATCH","baseRevisionRef":"', id, '"}') END
 ELSE CASE WHEN variant % 3 = 0 THEN concat('{"mode":"PROPERTY_EVENTS","eventSequence":"', id, '"}') END END AS representation,
 CASE WHEN ordinal % 3 = 1 AND variant % 4 <> 0 THEN 'ING_DELTA_BASE_REQUIRED' WHEN ordinal % 3 = 2 AND variant % 3 <> 0 THEN 'ING_EVENT_SEQUENCE_REQUIRED' END AS error_code FROM records""", "records")
def change_representation(records):
    mode = F.when(F.col("ordinal") % 3 == 1, "DELTA_PATCH").when(F.col("ordinal") % 3 == 2, "PROPERTY_EVENTS")
    body, code = M.change_representation(F.col("provenance"), mode)
    return payloads(records).select("ordinal", body.alias("representation"), code.alias("error_code"))


def _envelope(records: DataFrame) -> DataFrame:
    r = records.select(
        "ordinal", F.col("ordinal").alias("run_id"), "source_id", F.col("id").alias("source_object_id"), F.lit("2025-01-01T00:00:00Z").alias("observed_at"), F.lit("2025-01-02T00:00:00Z").alias("acquired_at"),
        F.col("nation").alias("correlation_id"), F.struct(F.col("name").alias("name")).alias("data"), F.when(F.col("variant") == 7, "DELETE").otherwise("UPSERT").alias("op"), "segment",
    )
    return r


@query("""SELECT ordinal, concat('{"envelopeVersion":"1.0","runId":"', ordinal, '","sourceId":"', source_id, '","sourceObjectId":"', id, '","operation":"', CASE variant WHEN 7 THEN 'DELETE' ELSE 'UPSERT' END,
 '","observedAt":"2025-01-01T00:00:00Z","acquiredAt":"2025-01-02T00:00:00Z","contentType":"application/json",', CASE variant WHEN 7 THEN '' ELSE concat('"data":{"name":"', name, '"},') END, '"provenance":{"correlationId":"', nation, '"}}') AS envelope FROM records""", "records")
def build_envelope(records):
    return _envelope(records).select("ordinal", M.build_envelope(F.col("op"), F.col("data")).alias("envelope"))


@query("""SELECT ordinal, concat('{"source":{"sourceId":"', source_id, '","sourceObjectId":"', id, '"},"processing":{"pipelineVersion":"1.1.0","transformationIds":["IDENTITY","', segment, '"]},"data":{"rawHash":"sha256:', sha256(name),
 '","normalizedHash":"sha256:', sha256(id), '","outputHash":"sha256:', sha256(nation), '"},"trace":{"correlationId":"', nation, '"},"outcome":{"status":"SUCCESS"}}') AS lineage FROM records""", "records")
def build_lineage(records):
    r = records.withColumn("source_object_id", F.col("id")).withColumn("correlation_id", F.col("nation"))
    return r.select("ordinal", M.build_lineage(F.col("name"), F.col("id"), F.col("nation"), F.array(F.lit("IDENTITY"), F.col("segment"), F.lit("IDENTITY"))).alias("lineage"))


@query("""SELECT ordinal, concat('{"sourceIdentity":{"sourceId":"', source_id, '","sourceObjectId":"', id, '"},"operation":"', CASE variant WHEN 7 THEN 'DELETE' ELSE 'UPSERT' END, '",', CASE variant WHEN 7 THEN '' ELSE concat('"canonicalPayload":"', name, '",') END,
 '"contentHash":"sha256:', sha256(name), '"', CASE WHEN variant % 2 = 0 THEN ',"dataAccessLabels":["OPEN"]' ELSE '' END, '}') AS handoff FROM records""", "records")
def build_handoff(records):
    r = records.withColumn("source_object_id", F.col("id"))
    labels = F.when(F.col("variant") % 2 == 0, F.array(F.lit("OPEN"))).otherwise(F.array().cast("array<string>"))
    op = F.when(F.col("variant") == 7, "DELETE").otherwise("UPSERT")
    return r.select("ordinal", M.build_handoff(op, F.col("name"), labels).alias("handoff"))


@query("SELECT run_id, concat_ws(':', bundle_id, bundle_version, bundle_checksum) AS bundle_ref, concat_ws(':', run_id, 'default', control_version, 'handoff') AS idempotency_key FROM runs", "runs")
def composite_refs(runs):
    r = runs.withColumn("partition_key", F.lit("default")).withColumn("sequence_no", F.col("control_version"))
    return r.select("run_id", M.bundle_ref().alias("bundle_ref"), M.idempotency_key().alias("idempotency_key"))


@query("SELECT ordinal, variant % 5 = 2 AS rejected FROM records", "records")
def sensitive_key_filter(records):
    p = payloads(records).withColumn("payload", F.transform_keys("payload", lambda k, v: F.when(k == "extra", "Api_Token").otherwise(k)))
    return p.select("ordinal", M.sensitive_key(F.col("payload")).alias("rejected"))


@query("SELECT quarantine_id, reason_code <> 'ING_VALID_TIME_INVALID' AS is_blocking, CASE WHEN reason_code <> 'ING_VALID_TIME_INVALID' THEN 'ERROR' ELSE 'WARNING' END AS severity FROM quarantine", "quarantine")
def classify_blocking(quarantine):
    b, s = M.classify_blocking(F.col("reason_code"), ["ING_VALID_TIME_INVALID"])
    return quarantine.select("quarantine_id", b.alias("is_blocking"), s.alias("severity"))


def _doc(cols: dict):
    return F.to_json(F.struct(*(c.alias(k) for k, c in cols.items())))


def _validated(df: DataFrame, key: str, schema: dict) -> DataFrame:
    valid, code, path = contracts.validate_contract(F.col("doc"), schema)
    return df.select(key, valid.alias("valid"), code.alias("code"), path.alias("path"))


def _contract_sql(key: str, table: str, path: str) -> str:
    return f"SELECT {key}, p IS NULL AS valid, CASE WHEN p IS NOT NULL THEN 'ING_CONTRACT_INVALID' END AS code, p AS path FROM (SELECT {key}, {path} AS p FROM {table})"


@query(_contract_sql("ordinal", "records", "CASE WHEN length(name) < 19 AND FALSE THEN '$' WHEN variant % 5 = 1 THEN '$.name' WHEN variant >= 20 THEN '$.nation' WHEN segment NOT IN ('BUILDING','MACHINERY') THEN '$.segment' END"), "records")
def validate_contract_object(records):
    schema = {
        "type": "object", "required": ["name"],
        "properties": {"name": {"type": "string", "minLength": 3}, "nation": {"type": "integer", "not": {}, "oneOf": [{"enum": list(range(20))}]}, "segment": {"enum": ["BUILDING", "MACHINERY"]}},
    }
    doc = _doc({"name": F.when(F.col("variant") % 5 != 1, F.col("name")), "nation": F.col("variant"), "segment": F.col("segment")})
    return _validated(records.withColumn("doc", doc), "ordinal", schema)


@query(_contract_sql("ordinal", "records", "CASE WHEN variant % 4 = 0 THEN '$.extra' END"), "records")
def validate_contract_closed(records):
    schema = {"properties": {"a": {"const": 1}}, "additionalProperties": False}
    return _validated(records.withColumn("doc", _doc({"a": F.lit(1), "extra": F.when(F.col("variant") % 4 == 0, "x")})), "ordinal", schema)


@query(_contract_sql("ordinal", "records", "CASE WHEN variant % 5 = 0 THEN '$.list' WHEN variant % 5 = 1 THEN '$.list' WHEN variant % 5 = 2 THEN '$.list[1]' END"), "records")
def validate_contract_array(records):
    schema = {"properties": {"list": {"type": "array", "minItems": 2, "uniqueItems": True, "items": {"type": "integer", "minimum": 0}}}}
    v = F.col("variant") % 5
    items = F.when(v == 0, F.array(F.lit(1))).when(v == 1, F.array(F.lit(1), F.lit(1))).when(v == 2, F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1), F.lit(2)))
    return _validated(records.withColumn("doc", _doc({"list": items})), "ordinal", schema)


@query(_contract_sql("ordinal", "records", "CASE WHEN variant % 3 = 0 THEN '$.t' WHEN variant % 3 = 1 AND segment <> 'BUILDING' THEN '$.why' END"), "records")
def validate_contract_conditional(records):
    schema = {
        "$defs": {"time": {"type": "string", "format": "date-time"}}, "properties": {"t": {"$ref": "#/$defs/time"}},
        "if": {"properties": {"op": {"const": "DELETE"}}}, "then": {"required": ["why"]}, "allOf": [{"anyOf": [{"type": "object"}, {"type": "null"}]}],
    }
    v = F.col("variant") % 3
    doc = _doc({"t": F.when(v == 0, "2025-01-01T00:00:00").otherwise("2025-01-01T00:00:00Z"), "op": F.when(v == 1, "DELETE").otherwise("UPSERT"), "why": F.when(F.col("segment") == "BUILDING", "x")})
    schema = {"properties": schema["properties"], "$defs": schema["$defs"], "allOf": [schema["allOf"][0], {"if": schema["if"], "then": schema["then"]}]}
    return _validated(records.withColumn("doc", doc), "ordinal", schema)


REFS = {"sourceSchemaRef": "schema:1", "semanticPublicationSetRef": "set:1", "adapterProfileRef": "adapter:1"}
#: Schemas of the three documents, for what the queries check.
CONTRACTS = {
    "envelope": {"type": "object", "required": ["envelopeVersion", "runId", "sourceObjectId", "operation"], "properties": {"envelopeVersion": {"const": "1.0"}, "operation": {"enum": ["UPSERT", "DELETE", "TOMBSTONE"]}}},
    "lineage": {"required": ["lineageId", "source", "outcome"], "properties": {"source": {"required": ["sourceId", "sourceObjectId"]}, "processing": {"properties": {"transformationIds": {"type": "array", "minItems": 1}}}}},
    "handoff": {"required": ["handoffId", "contentHash"], "if": {"properties": {"operation": {"const": "UPSERT"}}}, "then": {"required": ["canonicalPayload"]}},
}


def commands(records: DataFrame) -> DataFrame:
    """records as the pipeline takes them: one run per source, in the order of their numbers."""
    return payloads(records).select(
        F.col("source_id").alias("run_id"), F.lit("default").alias("partition_key"), F.col("ordinal").alias("sequence_no"), F.lit(1).alias("attempt_no"), "source_id", F.lit("b1").alias("bundle_id"), F.lit("1").alias("bundle_version"),
        F.lit("c1").alias("bundle_checksum"), F.col("id").alias("source_object_id"), F.concat(F.lit("corr-"), "nation").alias("correlation_id"), F.lit("2025-01-02T00:00:00Z").alias("acquired_at"), "payload", "provenance", "variant", "ordinal",
    )


def config(**more) -> pipeline.Config:
    return pipeline.Config(MAPPINGS, REFS, expected_fields=["id", "name", "segment"], contracts=CONTRACTS, **more)


def processed(records: DataFrame, **more) -> pipeline.Outcomes:
    """The pipeline's outcomes, all of which read one written frame."""
    return pipeline.process(commands(records), config(**more), lambda df: df.sparkSession.read.schema(df.schema).parquet(written(df, "judged")))


@query("SELECT CASE WHEN min(e) IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS validated_rows, min(e) AS error_code FROM (SELECT CASE WHEN variant % 5 = 1 THEN 'ING_SCHEMA_INCOMPATIBLE' WHEN variant = 8 THEN 'ING_OPERATION_UNSUPPORTED' WHEN variant = 4 THEN 'ING_TEMPORAL_METADATA_INVALID' WHEN variant = 5 THEN 'ING_VALID_TIME_INVALID' END AS e FROM records)", "records")
def compatibility_report(records):
    return pipeline.compatibility_report(commands(records), config()).select("status", "validated_rows", "error_code")


@query("""SELECT source_id, CASE WHEN count(*) FILTER (variant % 5 = 1) > 0 THEN 'ING_SCHEMA_INCOMPATIBLE' WHEN count(*) FILTER (variant = 8) > 0 THEN 'x' END IS NULL AS clean FROM records WHERE source_id = 'src-none' GROUP BY 1
 UNION ALL SELECT 'none', FALSE""", "records")
def compatibility_of_nothing(records):
    """An asset without rows proves nothing."""
    none = commands(records.where("source_id = 'src-none'"))
    return pipeline.compatibility_report(none, config()).select(F.lit("none").alias("source_id"), (F.col("error_code") != "ING_COMPAT_EMPTY_ASSET_UNPROVEN").alias("clean"))


ERROR_SQL = "CASE WHEN variant % 5 = 1 THEN 'ING_SCHEMA_INCOMPATIBLE' WHEN variant = 8 THEN 'ING_OPERATION_UNSUPPORTED' WHEN variant = 4 THEN 'ING_TEMPORAL_METADATA_INVALID' WHEN variant = 5 THEN 'ING_VALID_TIME_INVALID' END"
PAYLOAD_SQL = """concat('{"id":"', id, '","segment":"', segment, '"', CASE WHEN variant % 5 <> 1 THEN concat(',"name":"', name, '"') ELSE '' END, CASE WHEN variant % 5 = 2 THEN ',"extra":"x"' ELSE '' END, '}')"""
KEY_SQL = "concat_ws(':', source_id, 'default', ordinal, {})"


@query(f"""SELECT 'RAW' AS zone, id AS source_object_id, {KEY_SQL.format("'raw'")} AS idempotency_key, concat('sha256:', sha256({PAYLOAD_SQL})) AS content_hash FROM records
 UNION ALL SELECT 'NORMALIZED', id, {KEY_SQL.format("'normalized'")}, NULL FROM records WHERE {ERROR_SQL} IS NULL
 UNION ALL SELECT 'CURATED', id, {KEY_SQL.format("'curated'")}, concat('sha256:', sha256(CASE WHEN variant = 7 THEN concat('{{"operation":"DELETE","sourceObjectId":"', id, '","sourceRevision":"', nation, '"}}')
  ELSE concat('{{"https://example.test/id":"', id, '","https://example.test/name":"', name, '"}}') END)) FROM records WHERE {ERROR_SQL} IS NULL""", "records")
def pipeline_zones(records):
    z = processed(records).zones
    return z.select("zone", "source_object_id", "idempotency_key", F.when(F.col("zone") != "NORMALIZED", F.col("content_hash")).alias("content_hash"))


@query(f"SELECT id AS source_object_id, source_id AS run_id, 'b1:1:c1' AS bundle_ref, 'sha256:' AS raw_hash, id AS object_id, 'SUCCESS' AS status, nation AS revision, '1.1.0' AS version FROM records WHERE {ERROR_SQL} IS NULL", "records")
def pipeline_lineage(records):
    at = lambda p: F.get_json_object("evidence", p)
    return processed(records).lineage.select(
        "source_object_id", "run_id", "bundle_ref", F.substring(at("$.data.rawHash"), 1, 7).alias("raw_hash"), at("$.source.sourceObjectId").alias("object_id"), at("$.outcome.status").alias("status"),
        at("$.source.sourceRevision").alias("revision"), at("$.processing.pipelineVersion").alias("version"),
    )


@query(f"""SELECT sha256(concat({KEY_SQL.format("'lineage'")}, ':1')) AS lineage_id, id AS source_object_id, 'b1:1:c1' AS bundle_ref, 'b1:1:c1' AS contract FROM records WHERE source_id = 'src-6' AND {ERROR_SQL} IS NULL ORDER BY lineage_id LIMIT 150""", "records")
def lineage_page(records):
    lineage = processed(records).lineage.withColumn("created_at", F.get_json_object("evidence", "$.times.processedAt"))
    runs = records.select(F.col("source_id").alias("run_id"), F.expr("concat('tenant-', cast(substring(source_id, 5) as int) % 5)").alias("tenant_id")).distinct()
    page = R.lineage_page(lineage, runs, "tenant-1", "src-6", 150)
    return page.select("lineage_id", "source_object_id", "bundle_ref", F.get_json_object("contract_refs", "$.bundleRef").alias("contract"))


@query(f"""SELECT {KEY_SQL.format("'handoff'")} AS idempotency_key, ordinal AS sequence_no, CASE WHEN variant = 7 THEN 'DELETE' ELSE 'UPSERT' END AS operation, CASE WHEN variant <> 7 THEN name END AS name,
 CASE WHEN variant = 3 THEN '2024-12-31T23:00:00.000000Z' ELSE '2025-06-01T00:00:00.000000Z' END AS valid_from, CASE WHEN variant % 4 = 0 THEN id END AS base, 'OPEN' AS label FROM records WHERE {ERROR_SQL} IS NULL""", "records")
def pipeline_handoffs(records):
    doc = F.parse_json("payload")
    at = lambda p: F.try_variant_get(doc, p, "string")
    return processed(records, labels=["OPEN"]).handoffs.select(
        "idempotency_key", "sequence_no", at("$.operation").alias("operation"), at("$.canonicalPayload['https://example.test/name']").alias("name"), at("$.sourceIdentity.validFrom").alias("valid_from"),
        at("$.changeRepresentation.baseRevisionRef").alias("base"), at("$.dataAccessLabels[0]").alias("label"),
    )


@query(f"SELECT state, reason_code, count(*) AS n FROM (SELECT CASE WHEN {ERROR_SQL} IS NULL THEN 'SUCCEEDED' ELSE 'FAILED' END AS state, {ERROR_SQL} AS reason_code FROM records) GROUP BY ALL", "records")
def pipeline_attempts(records):
    return processed(records).attempts.groupBy("state", "reason_code").agg(F.count("*").alias("n"))


@query(f"SELECT id AS source_object_id, {ERROR_SQL} AS reason_code, concat_ws('/', 'RAW', {KEY_SQL.format(chr(39) + 'raw' + chr(39))}) AS payload_ref, concat('contract-or-mapping:', {ERROR_SQL}) AS evidence_ref, {ERROR_SQL} <> 'ING_VALID_TIME_INVALID' AS blocking FROM records WHERE {ERROR_SQL} IS NOT NULL", "records")
def pipeline_quarantine(records):
    return processed(records, non_blocking=["ING_VALID_TIME_INVALID"]).quarantine.select("source_object_id", "reason_code", "payload_ref", "evidence_ref", "blocking")


@query(f"SELECT source_id, severity, count(*) AS n FROM (SELECT source_id, CASE WHEN {ERROR_SQL} = 'ING_VALID_TIME_INVALID' THEN 'WARNING' ELSE 'ERROR' END AS severity FROM records WHERE {ERROR_SQL} IS NOT NULL) GROUP BY ALL", "records")
def pipeline_issues(records):
    return processed(records, non_blocking=["ING_VALID_TIME_INVALID"]).issues.groupBy("source_id", "severity").agg(F.count("*").alias("n"))


@query(f"""SELECT zone, count(*) AS n FROM (SELECT unnest(CASE WHEN variant IN (9, 10) THEN [] WHEN {ERROR_SQL} IS NOT NULL THEN ['RAW'] ELSE ['RAW','NORMALIZED','CURATED'] END) AS zone FROM records) GROUP BY 1
 UNION ALL SELECT 'HANDOFF', count(*) FROM records WHERE variant NOT IN (9, 10) AND {ERROR_SQL} IS NULL AND variant % 4 = 0""", "records")
def pipeline_delta_zones(records):
    """Times of observation from the records, and patches that need a base: what a record keeps depends on the step that failed."""
    out = processed(records, observation_policy="PROVENANCE_OBSERVED_AT", change_mode="DELTA_PATCH")
    return out.zones.groupBy("zone").agg(F.count("*").alias("n")).unionByName(out.handoffs.agg(F.count("*").alias("n")).select(F.lit("HANDOFF").alias("zone"), "n"))


@query("""SELECT ordinal, v, CASE WHEN ordinal % 11 = 0 THEN 'ING_ADAPTER_ID_MISMATCH' WHEN ordinal % 7 = 0 THEN 'ING_ADAPTER_VERSION_INVALID' WHEN NOT (CAST(variant AS INT) BETWEEN 5 AND 12) THEN 'ING_ADAPTER_VERSION_UNSUPPORTED' END AS code FROM (SELECT *, CASE WHEN ordinal % 7 = 0 THEN '1.x' ELSE concat('1.', CAST(variant AS STRING), '.0') END AS v FROM records)""", "records")
def version_window(records):
    v = F.when(F.col("ordinal") % 7 == 0, "1.x").otherwise(F.concat(F.lit("1."), F.col("nation"), F.lit(".0")))
    adapter = F.when(F.col("ordinal") % 11 == 0, "other").otherwise("adapter")
    return records.select("ordinal", v.alias("v"), P.version_window(adapter, v, "adapter", "1.5.0", "1.12.9").alias("code"))


@query("""SELECT event_id, CASE WHEN body > 90 THEN 'DATA' WHEN st BETWEEN 200 AND 299 THEN 'OK' WHEN st IN (408, 429) OR st >= 500 THEN 'TRANSIENT' WHEN st IN (401, 403) THEN 'AUTH_ROUTE' ELSE 'CONFIGURATION' END AS error_class,
 CASE WHEN st = 429 AND ra ~ '^[1-9][0-9]*$' THEN CAST(ra AS BIGINT) WHEN st = 429 AND ra LIKE 'Wed%' THEN user_id % 60 + 60 END AS retry_after FROM (SELECT event_id, user_id, [200, 401, 403, 404, 408, 429, 503][event_id % 7 + 1] AS st, user_id % 100 AS body,
 CASE user_id % 4 WHEN 0 THEN CAST(user_id AS STRING) WHEN 1 THEN 'Wed' WHEN 2 THEN 'Tue, past' ELSE 'x' END AS ra FROM events)""", "events")
def classify_response(events):
    from ..operators.health import classify_response as classify

    date = F.concat(F.lit("Wed, 1 Jan 2025 00:01:"), F.lpad((F.col("user_id") % 60).cast("string"), 2, "0"), F.lit(" GMT"))
    header = F.when(F.col("user_id") % 4 == 0, F.col("user_id").cast("string")).when(F.col("user_id") % 4 == 1, date).when(F.col("user_id") % 4 == 2, "Tue, 31 Dec 2024 00:00:00 GMT").otherwise("x")
    e = events.select("event_id", F.get(F.array(*map(F.lit, [200, 401, 403, 404, 408, 429, 503])), (F.col("event_id") % 7).cast("int")).alias("status"), (F.col("user_id") % 100).alias("body_bytes"), header.alias("retry_after"))
    return classify(e, 90, F.lit("2025-01-01T00:00:00Z").cast("timestamp")).select("event_id", "error_class", F.col("retry_after_seconds").alias("retry_after"))


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 2 = 0 ELSE c_custkey % 2 = 1 OR NOT (c_custkey BETWEEN 60 AND 2678400) END THEN 'poll' END, CASE WHEN NOT (t BETWEEN 1 AND 300) THEN 'timeout' END, CASE WHEN NOT (r BETWEEN 0 AND 100) THEN 'retries' END,
 CASE WHEN NOT (c_nationkey * 5000 BETWEEN 1 AND 86400) THEN 'backoff' END, CASE WHEN NOT (c_nationkey * 200 BETWEEN 30 AND 3650) THEN 'retention' END], lambda x: x IS NOT NULL), ',') AS violations
 FROM (SELECT c_custkey, c_nationkey, c_nationkey * 20 AS t, c_nationkey * 6 AS r FROM customer)""", "customer")
def policy_bounds(customer):
    nation, poll = F.col("c_nationkey"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey"))
    found = P.policy_violations({"poll": poll, "timeout": nation * 20, "retries": nation * 6, "backoff": nation * 5000, "retention": nation * 200}, F.col("c_custkey") % 3 == 0)
    order = F.filter(F.array(*map(F.lit, ["poll", "timeout", "retries", "backoff", "retention"])), lambda x: F.array_contains(found, x))
    return customer.select("c_custkey", F.array_join(order, ",").alias("violations"))


@query("""SELECT ordinal, CASE ordinal % 16 WHEN 2 THEN 'ING_MANAGED_POLLING_FORBIDDEN' WHEN 3 THEN 'ING_PUBLICATION_CADENCE_INVALID' WHEN 7 THEN 'ING_PREFLIGHT_REFS_REQUIRED' WHEN 8 THEN 'ING_PREFLIGHT_EXACT_REF_REQUIRED'
 WHEN 9 THEN 'ING_PUBLICATION_HASH_MISMATCH' WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 14 THEN NULL ELSE 'ING_PUBLICATION_INVALID' END AS error_code FROM records""", "records")
def activation_errors(records):
    """Published activations of which each ordinal of 16 has its own defect; 0, 1 (managed) and 14 (a value at its bound) have none."""
    k = F.col("ordinal") % 16
    one = lambda at, bad, good: F.when(k == at, F.lit(bad)).otherwise(F.lit(good))
    once = k.isin(1, 2)
    poll = F.when(k == 1, F.lit(None)).when(k == 3, "PT30S").when(k == 4, "daily").otherwise("PT1H")
    policy = F.struct(
        one(12, "Mars/Base", "Europe/Rome").alias("timeZone"), one(13, None, 60).alias("misfireToleranceSeconds"), one(14, 300, 30).alias("sourceTimeoutSeconds"), F.lit(3).alias("maxRetryAttempts"),
        F.lit(600).alias("maxRetryElapsedSeconds"), F.lit(60).alias("incidentDedupWindowSeconds"), one(5, 29, 30).alias("operationalRetentionDays"), one(6, "SECRET", "TENANT_OPERATIONAL").alias("operationalVisibilityClass"),
    )
    sync = F.struct(poll.alias("pollInterval"), F.lit(5).alias("retryBackoffSeconds"), policy.alias("operationalPolicy"))
    refs = F.when(k == 7, F.array().cast("array<string>")).when(k == 8, F.array(F.lit("model"))).otherwise(F.array(F.concat("segment", F.lit("@1"))))
    refs = F.transform(refs, lambda r: F.regexp_replace(r, r"\s", "-"))
    mode = F.when(k == 15, "PUSH").when(once, "MANAGED").otherwise("PULL")
    source = F.struct(F.col("source_id").alias("sourceId"), mode.alias("acquisitionMode"))
    parts = dict(source=source, status=F.lit("ACTIVE"), createdFromOnboardingVersion=F.lit("v1"), syncProfile=sync, semanticRefs=refs, bundleId=F.col("id"))
    r = spread(records).withColumn("plain", F.to_json(F.struct(*(c.alias(n) for n, c in parts.items()))))
    r = r.withColumn("sum", F.when(k == 9, "sha256:0").otherwise(P.configuration_hash(F.col("plain"))))
    envelope = dict(sourceId=F.col("source_id"), tenantId=F.lit("t"), onboardingVersionId=F.lit("v1"), sourceStatus=one(10, "PAUSED", "ENABLED"), publicationSequence=one(11, 0, 7), checksum=F.col("sum"))
    bundle = F.concat(F.expr("substring(plain, 1, length(plain) - 1)"), F.lit(',"checksum":"'), F.col("sum"), F.lit('"}'))
    head = F.to_json(F.struct(*(c.alias(n) for n, c in envelope.items())))
    doc = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"bundle":'), bundle, F.lit("}"))
    return r.select("ordinal", P.activation_error(doc, F.lit("t")).alias("error_code"))


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN NULL WHEN c_nationkey % 4 = 1 THEN 'OPEN' ELSE 'OPEN,PERSONAL' END AS labels, CASE WHEN c_nationkey % 4 = 0 THEN 'ING_ACCESS_LABEL_INVALID' END AS code FROM customer""", "customer")
def access_labels(customer):
    v = F.col("c_nationkey") % 4
    given = F.when(v == 0, F.array(F.lit("OPEN"), F.lit("SECRET"))).when(v == 1, F.array(F.lit("OPEN"), F.lit("OPEN"))).otherwise(F.array(F.lit("OPEN"), F.lit("PERSONAL"), F.lit("OPEN")))
    labels, code = P.access_labels(given)
    return customer.select("c_custkey", F.array_join(labels, ",").alias("labels"), code.alias("code"))


@query("""SELECT ordinal, concat('sha256:', sha256(concat('{"a":"', name, '\\"q","b":{"x":[2,1],"y":"', nation, '"},"c":null}'))) AS hash, ordinal % 2 = 0 AS matches FROM records""", "records")
def configuration_hash(records):
    plain = F.struct(F.col("b.y").alias("y"), F.col("b.x").alias("x"))
    r = records.withColumn("b", F.struct(F.array(F.lit(2), F.lit(1)).alias("x"), F.col("nation").alias("y"))).withColumn("hash0", F.lit("x"))
    doc = F.to_json(F.struct(F.lit("zzz").alias("checksum"), F.lit(None).cast("string").alias("c"), plain.alias("b"), F.concat("name", F.lit('"q')).alias("a")), {"ignoreNullFields": "false"})
    r = r.withColumn("hash", P.configuration_hash(doc))
    declared = F.when(F.col("ordinal") % 2 == 0, F.col("hash")).otherwise("sha256:0")
    return r.select("ordinal", "hash", (F.col("hash") == declared).alias("matches"))


@query("""SELECT ordinal, concat('{"a":"', name, '","list":["', least(id, nation), '","', greatest(id, nation), '"]}') AS fingerprint, ordinal % 2 = 0 AS found, FALSE AS as_key FROM records""", "records")
def canonical_fingerprint(records):
    doc = F.to_json(F.struct(F.array("id", "nation").alias("list"), F.col("name").alias("a")))
    ref = F.when(F.col("ordinal") % 2 == 0, F.col("name")).otherwise("nowhere")
    return records.select("ordinal", S.canonical_fingerprint(doc).alias("fingerprint"), S.any_value_equals(doc, ref).alias("found"), S.any_value_equals(doc, F.lit("list")).alias("as_key"))


@query("""WITH refs AS (SELECT DISTINCT bundle_id AS id FROM runs), b AS (SELECT concat('b', CAST(c_nationkey % 9 AS STRING)) AS id, count(*) AS n, min(CASE WHEN c_nationkey % 9 = 2 THEN 0 ELSE 1 END) AS ok FROM (SELECT DISTINCT c_nationkey % 18 AS c_nationkey FROM customer WHERE c_nationkey % 18 < 9 OR c_nationkey % 18 = 12) GROUP BY 1)
SELECT coalesce(refs.id, b.id) AS ref, CASE WHEN b.id IS NULL THEN 'UNBOUND' WHEN refs.id IS NULL THEN 'UNUSED' WHEN n > 1 THEN 'AMBIGUOUS' WHEN ok = 0 THEN 'INACTIVE' ELSE 'EXACT' END AS state FROM refs FULL OUTER JOIN b ON refs.id = b.id""", "runs customer")
def exact_bindings(runs, customer):
    refs = runs.select(F.col("bundle_id").alias("ref")).distinct()
    keys = customer.select((F.col("c_nationkey") % 18).alias("k")).distinct().where("k < 9 or k = 12")
    bound = keys.select(F.expr("concat('b', k % 9)").alias("ref"), F.when(F.col("k") % 9 == 2, "DEPRECATED").otherwise("ACTIVE").alias("status"))
    return P.exact_bindings(refs, bound)


@query("SELECT count(*) = 0 AS equal FROM ((SELECT DISTINCT bundle_id FROM runs EXCEPT SELECT DISTINCT concat('b', CAST(c_nationkey % 7 AS STRING)) FROM customer) UNION ALL (SELECT DISTINCT concat('b', CAST(c_nationkey % 7 AS STRING)) FROM customer EXCEPT SELECT DISTINCT bundle_id FROM runs))", "runs customer")
def binding_set_equality(runs, customer):
    a = runs.select(F.col("bundle_id").alias("id")).distinct()
    b = customer.select(F.expr("concat('b', c_nationkey % 7)").alias("id")).distinct()
    return a.exceptAll(b).unionByName(b.exceptAll(a)).agg((F.count("*") == 0).alias("equal"))


@query("SELECT ordinal, concat('sha256:', sha256(name)) AS hash, CASE WHEN segment ~ '^[A-Z0-9_]{1,80}$' AND ordinal % 2 = 0 THEN segment ELSE 'ING_UNEXPECTED' END AS code FROM records", "records")
def content_hash(records):
    code = S.safe_code(F.when(F.col("ordinal") % 2 == 0, F.col("segment")).otherwise(F.lower("segment")), "ING_UNEXPECTED")
    return records.select("ordinal", S.content_hash(F.col("name")).alias("hash"), code.alias("code"))


@query("SELECT ordinal, CASE WHEN variant * 60 BETWEEN 60 AND 2678400 THEN CAST(variant * 60 AS BIGINT) END AS seconds, CASE WHEN ordinal % 2 = 0 THEN CAST(variant * 86400 + 3600 AS BIGINT) END AS long_form FROM (SELECT ordinal, variant FROM records)", "records")
def iso_duration_seconds(records):
    return records.select("ordinal", S.iso_duration_seconds(F.expr("concat('PT', variant, 'M')")).alias("seconds"), F.when(F.col("ordinal") % 2 == 0, S.iso_duration_seconds(F.expr("if(variant = 0, 'PT1H', concat('P', variant, 'DT1H'))"))).alias("long_form"))


@query("SELECT ordinal, CASE WHEN variant % 3 = 0 THEN NULL ELSE concat('managed:', sha256(concat_ws(chr(31), source_id, 'KEY', concat('id=', id), concat('segment=', segment)))) END AS object_id, CASE WHEN variant % 3 = 0 THEN 'ING_MANAGED_IDENTITY_MISSING' END AS error_code FROM records", "records")
def source_identity(records):
    blank = F.when(F.col("variant") % 3 == 0, F.lit("  ")).otherwise(F.col("segment"))
    i, e = M.source_identity("COMPOSITE", F.col("source_id"), {"id": F.col("id"), "segment": blank})
    return records.select("ordinal", i.alias("object_id"), e.alias("error_code"))


@query("SELECT event_id, CAST(user_id AS STRING) AS found, CAST(NULL AS STRING) AS missing FROM events", "events")
def path_get(events):
    doc = F.to_json(F.struct(F.struct(F.struct(F.col("user_id").alias("c")).alias("b")).alias("a")))
    return events.select("event_id", S.path_get(doc, "a.b.c").alias("found"), S.path_get(doc, "a.x.c").alias("missing"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM events", "events")
def iso_micros(events):
    return events.select("event_id", S.iso_micros(F.col("ts")).alias("at"))


@query("SELECT event_id, least(900, 5 * CAST(pow(2, least(event_id % 12, 7)) AS INTEGER)) AS base, TRUE AS bounded FROM events", "events")
def backoff_seconds(events):
    a = F.col("event_id") % 12 + 1
    base = F.least(F.lit(900), F.lit(5) * F.pow(F.lit(2), F.least(a - 1, F.lit(7))).cast("int"))
    wait = S.backoff_seconds(a, F.col("user_id"))
    return events.select("event_id", base.alias("base"), ((wait >= base) & (wait <= base * 1.2 + 1)).alias("bounded"))


@query("SELECT ordinal, CASE WHEN ordinal % 3 = 0 THEN '' ELSE name END AS stripped, ordinal % 3 = 0 AS blank FROM records", "records")
def strip_ws(records):
    padded = F.when(F.col("ordinal") % 3 == 0, F.lit(" \t \n")).otherwise(F.concat(F.lit("  "), F.col("name"), F.lit("\r\n")))
    return records.select("ordinal", S.strip_ws(padded).alias("stripped"), S.is_blank(padded).alias("blank"))
