"""Source plug-ins and chains of pages: limits, identities, checkpoints inside pages, streams that go on."""

import json

import pytest
from tidewell.sources.acquisition import ADAPTERS, AcquisitionError, Adapter, Adapters, Bundle


def put(root, pages):
    for token, body in pages.items():
        place = root / "binding=b" / f"page={token or 'start'}"
        place.mkdir(parents=True, exist_ok=True)
        (place / "part-0.txt").write_text(body if isinstance(body, str) else json.dumps(body))


def bundle(root, **config):
    return Bundle("s", "REST_JSON", "gateway://b", config={"root": f"file://{root}", "identityFields": ["id"]} | config)


def taken(df):
    return [(json.loads(r.payload)["id"], r.ordinal, tuple(r.checkpoint)) for r in df.orderBy("ordinal").collect()]


PAGES = {"": {"items": [{"id": 1}, {"id": 2}], "nextPageToken": "p2"}, "p2": {"items": [{"id": 3}], "nextPageToken": " "}}


def test_resumes_inside_a_page(spark, tmp_path):
    put(tmp_path, PAGES)
    rows = taken(ADAPTERS.acquire(spark, bundle(tmp_path)))
    assert rows == [(1, 0, ("", 1, 1)), (2, 1, ("", 2, 2)), (3, 2, ("p2", 1, 3))]
    for n, (_, _, at) in enumerate(rows):
        again = ADAPTERS.acquire(spark, bundle(tmp_path), dict(zip(("pageToken", "pageOffset", "recordIndex"), at, strict=True)))
        assert taken(again) == rows[n + 1 :]
    for at in ({"pageToken": "p2", "pageOffset": 2, "recordIndex": 4}, {"pageToken": "gone", "pageOffset": 0, "recordIndex": 3}):
        with pytest.raises(Exception, match="ING_CHECKPOINT_OUT_OF_RANGE"):
            ADAPTERS.acquire(spark, bundle(tmp_path), at).collect()


def test_a_stream_goes_on_in_the_middle_of_a_page(spark, tmp_path):
    pages, state, out = tmp_path / "pages", str(tmp_path / "state"), str(tmp_path / "out")

    def run():
        rows = ADAPTERS.acquire(spark, bundle(pages), stream=True)
        rows.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
        return [r[0] for r in taken(spark.read.parquet(out))]

    put(pages, PAGES)
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]
    put(pages, {"p2": {"items": [{"id": 3}, {"id": 4}, {"id": 5}], "nextPageToken": "p3"}, "p3": {"items": []}})
    assert run() == [1, 2, 3, 4, 5]
    put(pages, {"p3": {"items": [{"id": 6}]}})
    assert run() == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize(
    ("pages", "config", "code"),
    [
        ({"": {"items": [{"id": 1}, {"id": 2}, {"id": 3}]}}, {"maxRecords": 2}, "ING_RECORD_LIMIT_EXCEEDED"),
        (PAGES, {"maxPageBytes": 5}, "ING_PAGE_TOO_LARGE"),
        (PAGES, {"maxPages": 1}, "ING_PAGE_LIMIT_EXCEEDED"),
        ({"": {"items": [], "nextPageToken": "p1"}, "p1": {"items": [], "nextPageToken": "p1"}}, {"maxPages": 20}, "ING_PAGE_LIMIT_EXCEEDED"),
        ({"": {"items": {"id": 1}}}, {}, "ING_JSON_ITEMS_INVALID"),
        ({"": {"items": [{"id": 1}, 2]}}, {}, "ING_JSON_RECORD_INVALID"),
        ({"": "{"}, {}, "ING_JSON_INVALID"),
    ],
)
def test_pages_that_are_refused(spark, tmp_path, pages, config, code):
    put(tmp_path, pages)
    with pytest.raises(Exception, match=code):
        ADAPTERS.acquire(spark, bundle(tmp_path, **config)).collect()


def test_configurations_that_are_refused(spark, tmp_path):
    good = bundle(tmp_path)
    for other, code in [
        (Bundle("s", "REST_JSON", "https://x", config=good.config), "ING_GATEWAY_BINDING_REQUIRED"),
        (bundle(tmp_path, accessToken="x"), "ING_RAW_ROUTE_FORBIDDEN"),
        (bundle(tmp_path, identityFields=[]), "ING_IDENTITY_FIELDS_REQUIRED"),
        (bundle(tmp_path, maxPages=0), "ING_ADAPTER_LIMIT_INVALID"),
        (Bundle("s", "FTP", "gateway://b"), "ING_ADAPTER_MODE_UNSUPPORTED"),
        (Bundle("s", "REST_JSON", "gateway://b", "2.0.0", good.config), "ING_COMPAT_ADAPTER_VERSION_UNSUPPORTED"),
    ]:
        with pytest.raises(AcquisitionError, match=code):
            ADAPTERS.acquire(spark, other)


def test_identities_and_pointers(spark, tmp_path):
    import hashlib

    put(tmp_path, {"": {"data": {"rows": [{"id": {"n": " 7 "}}, {"id": {}}, {"id": {"n": "  "}}]}, "next": None}})
    rows = ADAPTERS.acquire(spark, bundle(tmp_path, itemsPointer="/data/rows", nextTokenPointer="/next", identityFields=["id.n"], typeCode="T")).orderBy("ordinal").collect()
    assert rows[0].source_object_id == "native:" + hashlib.sha256("s\x1fT\x1fid.n=7".encode()).hexdigest() and rows[0].error_code is None
    assert [r.error_code for r in rows[1:]] == ["ING_SOURCE_IDENTITY_MISSING"] * 2 and rows[0].provenance == {"bindingRef": "gateway://b", "page": ""}


def test_plug_ins(spark, tmp_path):
    mine = Adapter("own", frozenset({"OWN", "OTHER"}), "1.4.0", "1.2.0", lambda spark, b, checkpoint, stream: spark.range(3))
    adapters = Adapters(mine)
    assert adapters.acquire(spark, Bundle("s", "OTHER", "x", "1.3.9")).count() == 3
    for v in ("1.1.9", "1.4.1", "new"):
        with pytest.raises(AcquisitionError, match="ING_COMPAT_ADAPTER_VERSION_UNSUPPORTED"):
            adapters.resolve(Bundle("s", "OWN", "x", v))
    for a in (Adapter("own", frozenset({"NEW"}), "1.0.0", "1.0.0", mine.open), Adapter("new", frozenset({"OWN"}), "1.0.0", "1.0.0", mine.open)):
        with pytest.raises(AcquisitionError, match="ING_ADAPTER_DUPLICATE"):
            adapters.register(a)
    f = tmp_path / "a.csv"
    f.write_text("id\nA\nB\nC\n")
    csv = Bundle("s", "INTERNAL_MANAGED_CSV", str(f))
    assert [r.payload["id"] for r in ADAPTERS.acquire(spark, csv, {"ordinal": 2}).collect()] == ["C"]
    with pytest.raises(AcquisitionError, match="ING_CHECKPOINT_OUT_OF_RANGE"):
        ADAPTERS.acquire(spark, csv, {"ordinal": 4})


@pytest.mark.parametrize("name", ["acquire_pages", "stream_acquire_pages"])
def test_events_beyond_one_chain(spark, tmp_path, monkeypatch, name):
    """More records than one binding may hold lie in several chains, numbered on."""
    from tidewell.plans import registry, transfer

    monkeypatch.setattr(transfer, "CHAIN", 2)
    spark.range(1000, 5700).selectExpr("id AS event_id", "'view' AS event_type").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r)[:4] for r in registry.queries()[name](spark, str(tmp_path)).collect())
    assert got == [(i, i + 1000, f"p{i // 1000 + 1}", i % 1000 + 1) for i in range(4700)]
