"""Cases whose outcome is known by hand."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tidewell.functions import scalar
from tidewell.operators import contracts, governance, health, incidents, mapping, outbox, reports
from tidewell.sources import delimited, readers
from tidewell.streaming import jobs

T = datetime(2025, 1, 1)


def handoffs(spark, states):
    return spark.createDataFrame([("r", "default", i + 1, s, T, T) for i, s in enumerate(states)], "run_id string, partition_key string, sequence_no long, state string, next_attempt_at timestamp, lease_until timestamp")


@pytest.mark.parametrize("states, mark", [(["READY", "READY"], None), (["ACKED", "READY"], 1), (["ACKED", "ACKED"], 2), (["READY", "ACKED"], None), (["ACKED", "FAILED_TERMINAL", "ACKED"], 1)])
def test_watermark_is_the_acked_prefix(spark, states, mark):
    got = outbox.ack_watermark(handoffs(spark, states)).collect()
    assert [r.watermark for r in got] == ([] if mark is None else [mark])


def test_expired_lease_is_claimable_again(spark):
    h = handoffs(spark, ["ACKED", "DELIVERING", "READY"])
    later, sooner = F.lit(T + timedelta(hours=1)), F.lit(T - timedelta(hours=1))
    assert [r.sequence_no for r in outbox.next_deliverable(h, later).collect()] == [2]
    assert outbox.deliverable_handoffs(h, sooner).collect() == []


def test_staging_is_idempotent(spark):
    old = spark.createDataFrame([("k", "p")], "idempotency_key string, payload string")
    new = spark.createDataFrame([("k", "p"), ("k", "other"), ("n", "p")], "idempotency_key string, payload string")
    got = {(r.idempotency_key, r.payload): r.outcome for r in outbox.stage_handoffs(new, old).collect()}
    assert got == {("k", "p"): "NOOP", ("k", "other"): "CONFLICT", ("n", "p"): "INSERT"}


def circuit(spark, outcomes, **options):
    log = spark.createDataFrame([(1, i * 10, i, o) for i, o in enumerate(outcomes)], "source_id long, at_seconds long, event_id long, outcome string")
    return health.circuit_states(log, **options).first()


def test_circuit(spark):
    r = circuit(spark, ["TRANSIENT"] * 5)
    assert (r.status, r.failures, r.attempts, r.open_until) == ("PAUSED", 5, 5, 40 + 900)
    r = circuit(spark, ["TRANSIENT"] * 2 + ["DATA"] * 8)
    assert (r.status, r.failures, r.attempts, r.retry_at) == ("DEGRADED", 0, 2, 0)
    assert circuit(spark, ["TRANSIENT", "SUCCESS"]).status == "HEALTHY"
    assert circuit(spark, ["TRANSIENT"] * 3, window=15).attempts == 1


def test_pressure_hysteresis(spark):
    for sizes, state in [([999], "NORMAL"), ([1000], "SOFT"), ([1000, 600], "SOFT"), ([1000, 500], "NORMAL"), ([5000, 600], "RECOVERY"), ([5000, 600, 500], "NORMAL"), ([5000], "HARD")]:
        b = spark.createDataFrame([(1, i, n) for i, n in enumerate(sizes)], "tenant_id long, at long, backlog long")
        assert health.pressure_states(b).first().state == state


def issue(i, lifecycle, severity, day):
    return (i, "t", 1, lifecycle, severity, T + timedelta(days=day))


def test_old_open_error_comes_before_the_limit(spark):
    rows = [issue(0, "OPEN", "ERROR", 0)] + [issue(i, "OPEN", "WARNING", i) for i in range(1, 13)] + [issue(i, "RESOLVED", "ERROR", i) for i in range(13, 25)]
    df = spark.createDataFrame(rows, "issue_id long, tenant_id string, issue_version long, lifecycle string, severity string, observed_at timestamp")
    assert incidents.top_incidents(df, 1).first().issue_id == 0


def test_late_publication_gets_the_next_revision(spark):
    rows = spark.createDataFrame([("t", 1, 5, 2), ("t", 2, 4, 1)], "tenant_id string, transition_id long, issue_id long, issue_version long")
    none = spark.createDataFrame([], "tenant_id string, transition_id long, revision long")
    first = jobs.publish_late_safe(rows.where("transition_id = 1"), none).select("tenant_id", "transition_id", "revision")
    second = jobs.publish_late_safe(rows, first).collect()
    assert [(r.transition_id, r.revision) for r in second] == [(2, 2)]


def test_pages_cover_the_snapshot(spark):
    df = spark.createDataFrame([issue(i, "OPEN", "ERROR", i) for i in range(8)], "issue_id long, tenant_id string, issue_version long, lifecycle string, severity string, observed_at timestamp")
    snap = incidents.prioritise_incidents(df)
    pages = [incidents.snapshot_page(snap, p, 3).collect() for p in (0, 3, 6)]
    assert sorted(r.issue_id for p in pages for r in p) == list(range(8))
    assert [p[0].has_next for p in pages] == [True, True, False]


def test_recovery_budget(spark):
    claims = spark.createDataFrame([("r", 1, T), ("r", 2, T), ("r", 3, T), ("s", 4, T)], "run_id string, claim_id long, claimed_at timestamp")
    sessions = spark.createDataFrame([("r", 1, T + timedelta(days=1))], "run_id string, max_attempts int, deadline_at timestamp")
    got = {r.claim_id: (r.decision, r.opens_incident) for r in governance.recovery_admission(claims, sessions).collect()}
    assert got == {1: ("ADMITTED", False), 2: ("EXHAUSTED", True), 3: ("EXHAUSTED", False), 4: ("ADMITTED", False)}


def test_length_prefix_keeps_keys_apart(spark):
    us = "\x1f"
    df = spark.createDataFrame([(f"x{us}b=y", "z"), ("x", f"y{us}b=z")], "a string, b string")
    ids = df.select(scalar.layer_feature_id(F.lit("s"), F.lit("l"), {"a": F.col("a"), "b": F.col("b")}).alias("i"))
    assert ids.distinct().count() == 2


@pytest.mark.parametrize("text, seconds", [("PT1M", 60), ("PT15M", 900), ("P31D", 2678400), ("PT59S", None), ("P32D", None), ("PT", None), ("15M", None), ("P1DT1H", 90000), ("PT1H30M", 5400)])
def test_iso_duration(spark, text, seconds):
    assert spark.range(1).select(scalar.iso_duration_seconds(F.lit(text)).alias("s")).first().s == seconds


def test_absent_is_not_null(spark):
    p = F.create_map(F.lit("a"), F.lit(None).cast("string"))
    mapped, error = mapping.map_properties(p, [("a", "t", "IDENTITY")])
    missing = mapping.map_properties(p, [("b", "t", "IDENTITY")])[1]
    unknown = mapping.map_properties(p, [("a", "t", "UPPER")])[1]
    r = spark.range(1).select(mapped.alias("m"), error.alias("e"), missing.alias("x"), unknown.alias("u")).first()
    assert (r.m, r.e, r.x, r.u) == ({"t": None}, None, "ING_MAPPING_SOURCE_FIELD_MISSING", "ING_TRANSFORM_UNSUPPORTED")


@pytest.mark.parametrize(
    "schema, document, path",
    [
        ({"type": "object", "required": ["a", "b"]}, '{"a":1}', "$.b"),
        ({"type": ["string", "null"]}, "null", None),
        ({"type": "integer", "minimum": 3}, "2", "$"),
        ({"minLength": 2}, '"x"', "$"),
        ({"properties": {"a": {"const": "x"}}}, '{"a":"y"}', "$.a"),
        ({"properties": {"a": {}}, "additionalProperties": False}, '{"a":1,"z":2}', "$.z"),
        ({"additionalProperties": False}, '{"z":2}', None),
        ({"oneOf": [{"type": "string"}, {"minLength": 1}]}, '"x"', "$"),
        ({"$defs": {"s": {"type": "string"}}, "properties": {"a": {"$ref": "#/$defs/s", "type": "integer"}}}, '{"a":"x"}', None),
        ({"items": {"type": "integer"}}, '[1,"x"]', "$[1]"),
        ({"uniqueItems": True}, "[1,1]", "$"),
        ({"minItems": 1}, "[]", "$"),
        ({"format": "date-time"}, '"2025-01-01T00:00:00Z"', None),
        ({"format": "date-time"}, '"2025-01-01T00:00:00"', "$"),
        ({"if": {"properties": {"o": {"const": 1}}}, "then": {"required": ["w"]}}, '{"o":1}', "$.w"),
        ({"anyOf": [{"type": "string"}, {"type": "null"}]}, "1", "$"),
        ({"enum": ["a", 1]}, "1", None),
        ({"allOf": [{"type": "object"}, {"required": ["q"]}]}, "{}", "$.q"),
        ({"type": "object"}, "not json", "$"),
        ({"const": "città"}, '"città"', None),
        ({"const": {"b": 1, "a": [2]}}, '{"a":[2],"b":1}', None),
        ({"const": 1}, "1.0", None),
        ({"const": 1}, '"1"', "$"),
        ({"enum": [{"b": 1}, "è"]}, '{"b": 1}', None),
        ({"enum": [True]}, "1", "$"),
    ],
)
def test_contract_keywords(spark, schema, document, path):
    valid, code, first = contracts.validate_contract(F.col("d"), schema)
    r = spark.createDataFrame([(document,)], "d string").select(valid.alias("v"), code.alias("c"), first.alias("p")).first()
    assert (r.v, r.p) == (path is None, path)


def test_unknown_reference(spark):
    _, code, _ = contracts.validate_contract(F.lit("{}"), {"$ref": "#/nowhere"})
    assert spark.range(1).select(code.alias("c")).first().c == "ING_CONTRACT_REF_UNAVAILABLE"


def test_delimited(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_bytes("﻿nome_teatro;precisione\r\nA;\"edificio; circa\n10 m\"\r\nB;\r\nC\r\nD;1;2\r\n".encode())
    got = {r.payload["nome_teatro"]: (r.payload, r.error_code) for r in delimited.read_delimited(spark, str(f), ";").collect()}
    assert set(got) == {"A", "B", "C", "D"}
    assert got["A"] == ({"nome_teatro": "A", "precisione": "edificio; circa\n10 m"}, None)
    assert got["B"] == ({"nome_teatro": "B", "precisione": ""}, None)
    assert got["C"] == ({"nome_teatro": "C"}, None)
    assert got["D"][1] == "ING_DELIMITED_TOO_MANY_FIELDS"
    f.write_text("a,a\n1,2\n")
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, str(f))


def test_delimited_rows_are_numbered_within_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\nA,Alpha\nB,Beta\n")
    (tmp_path / "b.csv").write_text("id,name\nC,x,y\nD,z\n")
    (tmp_path / "c.csv").write_text("id,other\nE,x\n")
    rows = delimited.read_delimited(spark, str(tmp_path))
    got = {(r.file[-5:], r.ordinal): (r.payload.get("id"), r.error_code) for r in rows.collect()}
    assert got == {
        ("a.csv", 1): ("A", None), ("a.csv", 2): ("B", None), ("b.csv", 1): ("C", "ING_DELIMITED_TOO_MANY_FIELDS"), ("b.csv", 2): ("D", None), ("c.csv", 1): ("E", "ING_MANAGED_HEADER_INVALID"),
    }
    assert {r.payload["id"] for r in readers.release_assets(rows).collect()} == {"A", "B"}
    assert readers.release_assets(rows, max_rows=1).count() == 0


def test_features_of_xml(spark):
    space = 'xmlns:w="http://www.opengis.net/wfs/2.0" xmlns:gml="http://www.opengis.net/gml"'
    docs = [
        (1, f'<w:FC {space}><w:member><r gml:id="r1"><name>A &amp; B</name><name>last</name><shape srsName="EPSG::4326"><gml:pos>1 <b>2</b></gml:pos></shape></r><s/></w:member><w:member/></w:FC>'),
        (2, "<!DOCTYPE x []><x/>"), (3, "<x><open></x>"), (4, None), (5, "<x><featureMember><r/></featureMember></x>"),
    ]
    got = [(r.doc, r.fields, r.srs_name, r.gml_id, r.error_code) for r in readers.xml_feature_records(spark.createDataFrame(docs, "doc long, body string"), "LON_LAT").orderBy("doc").collect()]
    assert got == [
        (1, {"name": "last", "shape": "1 2"}, "EPSG::4326", "r1", None), (2, None, None, None, "ING_XML_DOCTYPE_FORBIDDEN"), (3, None, None, None, "ING_WFS_XML_INVALID"), (4, None, None, None, "ING_WFS_XML_INVALID"), (5, {}, None, None, None),
    ]


def test_pages_with_limits(spark):
    pages = spark.createDataFrame([(1, '{"items":[{"id":1},{"id":2}],"nextPageToken":"p2"}'), (2, '{"items":[{"id":3}],"nextPageToken":" "}'), (3, '{"items":[1]}'), (4, "no"), (5, "{}")], "page long, body string")
    got = [(r.page, r.ordinal, r.next_token, r.error_code) for r in readers.json_page_records(pages, "$.items", max_records=2, max_pages=4).orderBy("page", "ordinal").collect()]
    assert got == [(1, 0, "p2", None), (1, 1, "p2", None), (2, 2, None, "ING_RECORD_LIMIT_EXCEEDED"), (3, None, None, "ING_JSON_RECORD_INVALID"), (4, None, None, "ING_JSON_INVALID"), (5, None, None, "ING_PAGE_LIMIT_EXCEEDED")]


def test_first_row_of_a_batch_holds_the_key(spark):
    new = spark.createDataFrame([("k", "p", 1, "h1"), ("k", "p", 2, "h2"), ("k", "q", 3, "h3")], "idempotency_key string, payload string, at int, handoff_id string")
    none = new.limit(0)
    got = {r.at: (r.outcome, r.staged_id, r.error_code) for r in outbox.stage_handoffs(new, none, "at").collect()}
    assert got == {1: ("INSERT", "h1", None), 2: ("NOOP", "h1", None), 3: ("CONFLICT", "h1", "ING_IDEMPOTENCY_CONFLICT")}


def test_canonical_texts(spark):
    doc = F.lit('{"b":[3,{"z":1,"a":"x\\"y"},"2"],"a":null}')
    r = spark.range(1).select(
        scalar.canonical_json(doc).alias("c"), scalar.canonical_fingerprint(doc).alias("f"), scalar.any_value_equals(doc, F.lit('x"y')).alias("found"), scalar.any_value_equals(doc, F.lit("z")).alias("key"), scalar.any_value_equals(F.lit("no"), F.lit("z")).alias("none")
    ).first()
    assert r.c == '{"a":null,"b":[3,{"a":"x\\"y","z":1},"2"]}' and r.f == '{"a":null,"b":["2",3,{"a":"x\\"y","z":1}]}'
    assert (r.found, r.key, r.none) == (True, False, False)


@pytest.mark.parametrize("header, seconds", [("120", 120), ("0", None), (" 7 ", 7), ("Wed, 01 Jan 2025 00:01:00 GMT", 60), ("Wed, 1 Jan 2025 00:01:00 GMT", 60), ("Tue, 31 Dec 2024 00:00:00 GMT", None), ("soon", None), (None, None)])
def test_retry_after(spark, header, seconds):
    now = F.lit("2025-01-01T00:00:00Z").cast("timestamp")
    assert spark.range(1).select(scalar.retry_after_seconds(F.lit(header).cast("string"), now).alias("s")).first().s == seconds


def test_circuit_waits_as_long_as_it_is_asked_to(spark):
    log = spark.createDataFrame([(1, 10, 1, "SUCCESS", None), (1, 20, 2, "TRANSIENT", 300)], "source_id long, at_seconds long, event_id long, outcome string, retry_after long")
    r = health.circuit_states(log).first()
    assert (r.status, r.failures, r.retry_at) == ("DEGRADED", 1, 320)


def test_watermark_of_a_stream_with_gaps_and_late_changes(spark, tmp_path):
    def batch(n, rows):
        spark.createDataFrame(rows, "run_id long, partition_key string, sequence_no long, state string").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")

    def run():
        source = spark.readStream.schema("run_id long, partition_key string, sequence_no long, state string").option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        out = jobs.ack_watermark_stream(source).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).outputMode("append").start(f"{tmp_path}/out")
        out.awaitTermination()
        return sorted(r.watermark for r in spark.read.parquet(f"{tmp_path}/out").collect())

    batch(1, [(1, "p", 2, "READY"), (1, "p", 5, "READY"), (1, "p", 9, "READY"), (1, "p", 5, "ACKED")])
    assert run() == []
    batch(2, [(1, "p", 2, "ACKED")])
    assert run() == [5]
    batch(3, [(1, "p", 9, "ACKED"), (1, "p", 2, "ACKED")])
    assert run() == [5, 9]


def test_pipeline_keeps_what_its_steps_had_written(spark):
    from tidewell.operators import pipeline

    base = {"operation": None, "validFrom": "2025-01-01T00:00:00+01:00", "observedAt": "2025-01-01T00:00:00Z"}
    rows = [
        (1, {"name": "Town Hall"}, base), (2, {"name": "x"}, base | {"observedAt": None}), (3, {"unexpected": "x"}, base), (4, {"name": "x"}, base | {"operation": "TOMBSTONE", "baseRevisionRef": "r"}), (5, {"name": "x"}, base | {"baseRevisionRef": "r"}),
    ]
    df = spark.createDataFrame([("run", "p", i, 1, "s", "b", "1", "c", f"o{i}", "corr", "2025-02-01T00:00:00Z", p, q) for i, p, q in rows],
        "run_id string, partition_key string, sequence_no long, attempt_no int, source_id string, bundle_id string, bundle_version string, bundle_checksum string, source_object_id string, correlation_id string, acquired_at string, payload map<string,string>, provenance map<string,string>")
    cfg = pipeline.Config([("name", "https://example.test/name", "IDENTITY")], {"sourceSchemaRef": "s"}, observation_policy="PROVENANCE_OBSERVED_AT", change_mode="DELTA_PATCH", expected_fields=["name"])
    out = pipeline.process(df, cfg)
    zones = {}
    for r in out.zones.collect():
        zones.setdefault(r.source_object_id, set()).add(r.zone)
    whole = {"RAW", "NORMALIZED", "CURATED"}
    assert zones == {"o1": whole, "o3": {"RAW"}, "o4": whole, "o5": whole}
    assert {r.source_object_id: r.reason_code for r in out.quarantine.collect()} == {"o1": "ING_DELTA_BASE_REQUIRED", "o2": "ING_OBSERVED_AT_MISSING", "o3": "ING_SCHEMA_INCOMPATIBLE"}
    assert {r.source_object_id: r.payload_ref for r in out.quarantine.collect()}["o2"] == "source-object:o2"
    import json

    docs = {json.loads(r.payload)["sourceIdentity"]["sourceObjectId"]: json.loads(r.payload) for r in out.handoffs.collect()}
    assert set(docs) == {"o4", "o5"} and docs["o5"]["canonicalPayload"] == {"https://example.test/name": "x"} and "canonicalPayload" not in docs["o4"]
    assert docs["o5"]["sourceIdentity"]["validFrom"].startswith("2024-12-31T23:00:00") and docs["o5"]["changeRepresentation"]["mode"] == "DELTA_PATCH"
    assert out.attempts.where("state = 'FAILED'").count() == 3 and out.issues.count() == 3 and out.lineage.count() == 2


def test_geometry_defects(spark):
    good = bytes.fromhex("475000" + "01" + "e6100000" + "01" + "01000000" + "0000000000002a40" + "0000000000804640")
    bad = [good[:-1], good + b"\0", b"XX" + good[2:], good[:4] + b"\0\0\0\0" + good[8:], good[:9] + b"\x09" + good[10:], b"", None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate([good, *bad])], "k long, g binary")
    got = {r.k: r.error_code for r in readers.geometry_to_geojson(df, "k", "g", 4326).collect()}
    assert got[0] is None and all(got[i] == "ING_GEOMETRY_INVALID" for i in range(1, 8))


def test_log_window_is_bounded(spark):
    df = spark.createDataFrame([(T,)], "at timestamp")
    assert reports.time_window(df, "at", T, T + timedelta(hours=1)).count() == 1
    with pytest.raises(ValueError):
        reports.time_window(df, "at", T, T + timedelta(hours=25))
    for end, purpose, severity, code in [(25, "p", None, "WINDOW_INVALID"), (0, "p", None, "WINDOW_INVALID"), (1, " ", None, "PURPOSE_REQUIRED"), (1, None, None, "PURPOSE_REQUIRED"), (1, "p", "DEBUG", "SEVERITY_INVALID")]:
        with pytest.raises(ValueError, match=f"ING_LOG_{code}"):
            reports.search_log(df, 5, T, T + timedelta(hours=end), purpose, severity=severity)


def test_entry_imports_without_a_session():
    import subprocess
    import sys

    from conftest import ROOT

    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0


def test_contract_paths(spark):
    tree = {"$ref": "#/defs/node", "defs": {"node": {"type": "object", "required": ["v"], "properties": {"v": {"type": "integer"}, "kids": {"type": "array", "items": {"$ref": "#/defs/node"}}}}}}
    nest = lambda n: '{"v": 1, "kids": [' + (nest(n - 1) if n else '{"v": "x"}') + "]}"
    names = {"type": "object", "properties": {"it's": {"type": "string"}, 'a"b': {"minLength": 2}, "n": {"type": ["null", "integer"]}, "x.y": {"const": 1}}, "additionalProperties": False}
    cases = [
        (tree, '{"v": 1, "kids": [{"v": 2}, {"v": 3, "kids": [{"v": 4}, {"w": 5}]}]}', "ING_CONTRACT_INVALID", "$.kids[1].kids[1].v"),
        (tree, nest(2), "ING_CONTRACT_INVALID", "$.kids[0].kids[0].kids[0].v"), (tree, nest(40), "ING_CONTRACT_DEPTH_EXCEEDED", None), (tree, '{"v": 12345678901234567890123}', None, None),
        (names, '{"it\'s": 1}', "ING_CONTRACT_INVALID", "$.it's"), (names, '{"a\\"b": "x"}', "ING_CONTRACT_INVALID", '$.a"b'), (names, '{"n": null, "it\'s": "s"}', None, None), (names, '{"n": 1.5}', "ING_CONTRACT_INVALID", "$.n"),
        (names, '{"zz": 1, "yy": 2}', "ING_CONTRACT_INVALID", "$.yy"), (names, '{"x.y": 1.0}', None, None), (names, "[]", "ING_CONTRACT_INVALID", "$"), (names, "{", "ING_CONTRACT_INVALID", "$"),
        ({"items": {"type": "object", "required": ["id"]}, "uniqueItems": True}, '[{"id": 1}, {}]', "ING_CONTRACT_INVALID", "$[1].id"), ({"$ref": "#/a", "a": {"$ref": "#/a"}}, "1", "ING_CONTRACT_DEPTH_EXCEEDED", None),
    ]
    for schema, text, want_code, want_path in cases:
        valid, code, path = contracts.validate_contract(F.col("d"), schema)
        r = spark.createDataFrame([(text,)], "d string").select(valid.alias("valid"), code.alias("code"), path.alias("path")).first()
        assert (r.valid, r.code, r.path) == (want_code is None, want_code, want_path), (schema, text)


def test_a_capture_does_not_change(spark, tmp_path):
    from tidewell.operators import snapshots

    rows = [issue(i, "OPEN", "WARNING", i) for i in range(7)] + [issue(7, "OPEN", "ERROR", 0)]
    df = spark.createDataFrame(rows, "issue_id long, tenant_id string, issue_version long, lifecycle string, severity string, observed_at timestamp")
    path, now = str(tmp_path), F.lit(T)
    sessions = snapshots.capture(df, path, "a", now, 2)
    like = df.select("*", F.lit(0).cast("long").alias("position"), F.lit(0).cast("long").alias("page"), F.lit("").alias("session"))
    items = snapshots.read_items(spark, path, like)
    cursors = spark.createDataFrame([("a", "t", p) for p in (0, 2, 4, 6, 8)], "session string, tenant_id string, position int").withColumn("at", now)
    read = lambda: [(r.cursor, r.issue_id, r.severity, r.has_next) for r in snapshots.pages(items, sessions, cursors).orderBy("cursor", "position").collect()]
    first = read()
    assert first[0] == (0, 7, "ERROR", True) and sorted(r[1] for r in first[:-1]) == list(range(8)) and first[-1] == (8, None, None, False)
    snapshots.capture(df.withColumn("severity", F.lit("ERROR")), path, "a", now, 2, sessions)
    assert read() == first and snapshots.altered(items, sessions).count() == 0
    assert [r.error_code for r in snapshots.altered(items.where("position <> 3"), sessions).collect()] == ["ING_CURSOR_EVIDENCE_INVALID"]
    scan = items.where("session = 'a' and tenant_id = 't' and position >= 2 and position < 4")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(session" in scan and "GreaterThanOrEqual(position,2)" in scan
    with pytest.raises(ValueError, match="ING_OPERATIONAL_QUERY_INVALID"):
        snapshots.capture(df, path, "b", now, 101)


def test_page_chains(spark):
    def chain(rows, most=100):
        return [tuple(r) for r in readers.page_chain(spark.createDataFrame(rows, "page_token string, next_token string"), most).orderBy("depth").collect()]

    line = [(None, "a"), ("a", "b"), ("b", "c"), ("c", " "), ("x", "y"), ("y", "x")]
    assert chain(line) == [(None, 0, None), ("a", 1, None), ("b", 2, None), ("c", 3, None)]
    assert chain(line, 3) == [(None, 0, None), ("a", 1, None), ("b", 2, "ING_PAGE_LIMIT_EXCEEDED")] and chain(line, 4)[-1] == ("c", 3, None)
    assert chain([*line[:3], ("c", "a")])[-1] == ("c", 3, "ING_PAGE_CYCLE") and chain([(None, "gone")]) == [(None, 0, None)]
    assert chain([("a", "b")]) == [] and chain([(None, "a"), ("a", "a")])[-1] == ("a", 1, "ING_PAGE_CYCLE")
    assert chain([(None, "b"), (None, "a"), ("a", None), ("b", None)]) == [(None, 0, None), ("a", 1, None)]


def test_history_violations_of_odd_rows(spark):
    from tidewell.operators.reports import session_violations, transition_violations

    kind = "session_id int, attempts int, state string, note string"
    before = spark.createDataFrame([(1, 1, "ACTIVE", None), (2, 1, "ENDED", None), (3, 1, "ACTIVE", "a"), (4, None, None, "a"), (5, 2, "ACTIVE", "a"), (6, 1, "ACTIVE", None)], kind)
    after = spark.createDataFrame([(1, 2, "ENDED", None), (2, 2, "ENDED", None), (3, 1, "ACTIVE", None), (4, 1, None, "a"), (5, None, "ACTIVE", "a"), (7, 0, "ENDED", "new")], kind)
    assert sorted(map(tuple, session_violations(before, after).collect())) == [(2, "FROZEN"), (3, "CHANGED"), (4, "FROZEN"), (5, "LOWERED"), (6, "DELETED")]
    assert session_violations(before, before).count() == 0 == session_violations(before.limit(0), after).count()
    kind = "transition_id int, publication_revision int, published_at int, note string"
    rows = lambda *r: spark.createDataFrame(r, kind)
    got = transition_violations(rows((1, None, None, "a"), (2, 1, 1, "a"), (3, None, None, "a"), (4, 1, 1, "a")), rows((1, 5, 5, "a"), (2, 1, 2, "a"), (3, 5, None, "a"), (4, 1, 1, "a")))
    assert sorted(map(tuple, got.collect())) == [(2, "REGAINED"), (3, "REGAINED")]


def test_no_page_of_the_table_is_cut_off(spark, tmp_path):
    """json_page_records over more pages and records than the reader's default limits allow."""
    from tidewell.plans import registry

    spark.range(100_500).selectExpr("id AS event_id", "'view' AS event_type").write.parquet(f"{tmp_path}/events.parquet")
    got = registry.queries()["json_page_records"](spark, str(tmp_path))
    assert got.where("event_id = ordinal and page = event_id div 100").count() == 100_500


def test_the_whole_log_is_searched(spark, tmp_path):
    """search_log gives the newest errors of all days."""
    from tidewell.plans import registry

    spark.range(100).selectExpr("id AS event_id", "timestamp_seconds(1704067200 + id * 86400) AS ts", "id AS user_id", "'error' AS event_type", "1.0 AS value").write.parquet(f"{tmp_path}/events.parquet")
    assert {r.event_id for r in registry.queries()["search_log"](spark, str(tmp_path)).collect()} == set(range(80, 100))
