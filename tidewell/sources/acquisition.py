"""Sources as plug-ins: adapters by acquisition mode within a window of versions, and chains of JSON pages as a Spark data source with offsets inside pages."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from importlib import import_module

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.scalar import native_id, path_get
from .delimited import read_delimited


class AcquisitionError(ValueError):
    """A refusal with a stable code and one of the classes TRANSIENT_SOURCE, AUTH_ROUTE, CONFIGURATION, DATA, PROGRAMMING."""

    def __init__(self, code: str, error_class: str = "DATA"):
        super().__init__(code)
        self.code, self.error_class = code, error_class

    def __reduce__(self):
        return AcquisitionError, (self.code, self.error_class)


@dataclass(frozen=True)
class Bundle:
    """What a run is pinned to: a source, how and from where it is read, by which version of the adapter, and its configuration."""

    source_id: str
    mode: str
    binding: str
    version: str = "1.0.0"
    config: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Adapter:
    """A source plug-in: open(spark, bundle, checkpoint, stream) gives the records past the checkpoint, as a table or a stream."""

    adapter_id: str
    modes: frozenset[str]
    current: str
    oldest: str
    open: Callable[[SparkSession, Bundle, dict | None, bool], DataFrame]


class Adapters:
    """Adapters by mode; a mode has one."""

    def __init__(self, *adapters: Adapter):
        self.by_mode: dict[str, Adapter] = {}
        for a in adapters:
            self.register(a)

    def register(self, adapter: Adapter) -> None:
        taken = adapter.modes & self.by_mode.keys()
        if taken or any(a.adapter_id == adapter.adapter_id for a in self.by_mode.values()):
            raise AcquisitionError("ING_ADAPTER_DUPLICATE", "PROGRAMMING")
        if not version(adapter.oldest) <= version(adapter.current):
            raise AcquisitionError("ING_ADAPTER_CONFIG_INVALID", "PROGRAMMING")
        self.by_mode |= dict.fromkeys(adapter.modes, adapter)

    def resolve(self, bundle: Bundle) -> Adapter:
        """The adapter of the bundle's mode, if it still reads the bundle's version."""
        adapter = self.by_mode.get(bundle.mode)
        if adapter is None:
            raise AcquisitionError("ING_ADAPTER_MODE_UNSUPPORTED", "CONFIGURATION")
        if not version(adapter.oldest) <= version(bundle.version) <= version(adapter.current):
            raise AcquisitionError("ING_COMPAT_ADAPTER_VERSION_UNSUPPORTED", "CONFIGURATION")
        return adapter

    def acquire(self, spark: SparkSession, bundle: Bundle, checkpoint: dict | None = None, stream: bool = False) -> DataFrame:
        return self.resolve(bundle).open(spark, bundle, checkpoint, stream)


def version(text: str) -> tuple[int, ...]:
    if not re.fullmatch(r"\d{1,9}\.\d{1,9}\.\d{1,9}", text):
        raise AcquisitionError("ING_COMPAT_ADAPTER_VERSION_UNSUPPORTED", "CONFIGURATION")
    return tuple(map(int, text.split(".")))


#: A port to pages: (binding, page token or "" for the first page) -> the page's bytes, or None if there is no such page.
Gateway = Callable[[str, str], "bytes | None"]


def folder_gateway(root: str) -> Gateway:
    """Pages below a folder on shared storage as Spark's text writer lays them out: binding=<name>/page=<token>/part-*; the first page is page=start."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(root)

    def fetch(binding: str, token: str) -> bytes | None:
        place = f"{base}/binding={binding.removeprefix('gateway://')}/page={token or 'start'}"
        files = sorted(f.path for f in store.get_file_info(fs.FileSelector(place, allow_not_found=True)) if f.base_name.startswith("part-") and f.size)
        if not files:
            return None
        with store.open_input_file(files[0]) as f:
            return f.read()

    return fetch


@dataclass(frozen=True)
class Pages:
    """One chain of pages behind a gateway and the limits on it."""

    gateway: str
    root: str
    binding: str
    items: tuple[str, ...]
    next_token: tuple[str, ...]
    max_bytes: int
    max_pages: int
    max_records: int

    def fetch(self, token: str) -> tuple[list, str]:
        """A page's items, not yet looked at, and the next page's token, or ""."""
        module, _, name = self.gateway.partition(":")
        body = getattr(import_module(module), name)(self.root)(self.binding, token)
        if body is None:
            raise AcquisitionError("ING_CHECKPOINT_OUT_OF_RANGE", "CONFIGURATION")
        if len(body) > self.max_bytes:
            raise AcquisitionError("ING_PAGE_TOO_LARGE")
        try:
            page = json.loads(body)
        except ValueError:
            raise AcquisitionError("ING_JSON_INVALID") from None
        items, after = pointed(page, self.items), pointed(page, self.next_token)
        if not isinstance(items, list):
            raise AcquisitionError("ING_JSON_ITEMS_INVALID")
        return items, after if isinstance(after, str) and after.strip() else ""

    def spans(self, start: dict, end: dict | None = None) -> Iterator[tuple[str, int, int, int, list]]:
        """(token, first place, place after the last, number of the first record, items) of each page from start on, up to end if that is given."""
        token, place, number = start["pageToken"], start["pageOffset"], start["recordIndex"]
        for pages in range(1, 1 << 62):
            if pages > self.max_pages:
                raise AcquisitionError("ING_PAGE_LIMIT_EXCEEDED")
            items, after = self.fetch(token)
            if place > len(items):
                raise AcquisitionError("ING_CHECKPOINT_OUT_OF_RANGE", "CONFIGURATION")
            last = end is not None and token == end["pageToken"] and end["recordIndex"] - number <= len(items) - place
            stop = place + end["recordIndex"] - number if last else len(items)
            if number + stop - place > self.max_records:
                raise AcquisitionError("ING_RECORD_LIMIT_EXCEEDED")
            yield token, place, stop, number, items
            number += stop - place
            if last or not after:
                return
            token, place = after, 0

    def rows(self, token: str, place: int, stop: int, number: int, items: list) -> pa.RecordBatch:
        if not all(isinstance(x, dict) for x in items[place:stop]):
            raise AcquisitionError("ING_JSON_RECORD_INVALID")
        n = stop - place
        text = [json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in items[place:stop]]
        # the checkpoint after each record
        return pa.RecordBatch.from_arrays(
            [pa.array([self.binding] * n, pa.string()), pa.array([token] * n, pa.string()), pa.array(range(place + 1, stop + 1), pa.int32()), pa.array(range(number, number + n), pa.int64()), pa.array(text, pa.string())],
            ["binding", "page_token", "page_offset", "ordinal", "payload"])


def pointed(doc, steps: tuple[str, ...]):
    """What a JSON pointer's steps lead to, or None."""
    for s in steps:
        doc = doc.get(s) if isinstance(doc, dict) else doc[int(s)] if isinstance(doc, list) and s.isdigit() and int(s) < len(doc) else None
    return doc


def pointer(text: str) -> tuple[str, ...]:
    if text and not text.startswith("/"):
        raise AcquisitionError("ING_ADAPTER_CONFIG_INVALID", "CONFIGURATION")
    return tuple(s.replace("~1", "/").replace("~0", "~") for s in text.split("/")[1:])


#: Options with their defaults and bounds, and what no configuration may name.
LIMITS = {"maxPages": (1000, 1, 100_000), "maxRecords": (100_000, 1, 1_000_000), "maxPageBytes": (5_000_000, 1, 50_000_000)}
FORBIDDEN = "url|credential|password|secret|token"
KNOWN = {"itemsPointer": "/items", "nextTokenPointer": "/nextPageToken"}
START = {"pageToken": "", "pageOffset": 0, "recordIndex": 0}
#: Pages of a chain that one task of a stream reads.
TASK_PAGES = 64


class PagedJson(DataSource):
    """Chains of JSON pages: options bindings (a JSON list of gateway://...), gateway (module:function), root, itemsPointer, nextTokenPointer, LIMITS and checkpoint.

    An offset is, for each binding, the page's token, the place in the page and the number of records before: a stream
    that ends in the middle of a page goes on there when the page has grown, and so does a batch from a checkpoint of
    that form. A chain is read by one task in a batch, as each page tells of the next; many bindings are read by many. In
    a stream the driver follows the tokens, one page at a time, and a task reads TASK_PAGES pages.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "binding string, page_token string, page_offset int, ordinal long, payload string"

    def chains(self) -> dict[str, Pages]:
        o = self.options
        limits = {}
        for name, (default, low, high) in LIMITS.items():
            raw = o.get(name, str(default))
            if not re.fullmatch(r"\d{1,9}", raw) or not low <= int(raw) <= high:
                raise AcquisitionError("ING_ADAPTER_LIMIT_INVALID", "CONFIGURATION")
            limits[name] = int(raw)
        items, after = (pointer(o.get(k, d)) for k, d in KNOWN.items())
        bindings = json.loads(o["bindings"])
        if not bindings or not all(isinstance(b, str) and b.startswith("gateway://") for b in bindings):
            raise AcquisitionError("ING_GATEWAY_BINDING_REQUIRED", "CONFIGURATION")
        return {b: Pages(o["gateway"], o["root"], b, items, after, limits["maxPageBytes"], limits["maxPages"], limits["maxRecords"]) for b in bindings}

    def start(self) -> dict:
        given = json.loads(self.options.get("checkpoint", "{}"))
        return {b: START | given.get(b, {}) for b in self.chains()}

    def reader(self, schema) -> DataSourceReader:
        return PagedJsonReader(self.chains(), self.start())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedJsonStream(self.chains(), self.start())


class PagedJsonReader(DataSourceReader):
    def __init__(self, chains: dict[str, Pages], start: dict):
        self.chains, self.start = chains, start

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(b) for b in self.chains]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        chain = self.chains[partition.value]
        for span in chain.spans(self.start[partition.value]):
            yield chain.rows(*span)


class PagedJsonStream(DataSourceStreamReader):
    def __init__(self, chains: dict[str, Pages], start: dict):
        self.chains, self.start = chains, start
        #: where the walk along each chain has come to: a page that has a next one is not fetched again
        self.seen = dict(start)

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        for b, chain in self.chains.items():
            for token, place, stop, number, _ in chain.spans(self.seen[b]):
                self.seen[b] = {"pageToken": token, "pageOffset": stop, "recordIndex": number + stop - place}
        return dict(self.seen)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for b, chain in self.chains.items():
            first, last = start.get(b, START), end.get(b, START)
            if first == last:
                continue
            spans = [span[:4] for span in chain.spans(first, last) if span[1] < span[2]]
            out += [InputPartition((b, spans[i : i + TASK_PAGES])) for i in range(0, len(spans), TASK_PAGES)]
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        b, spans = partition.value
        chain = self.chains[b]
        for token, place, stop, number in spans:
            items, _ = chain.fetch(token)
            if stop > len(items):
                raise AcquisitionError("ING_CHECKPOINT_OUT_OF_RANGE", "CONFIGURATION")
            yield chain.rows(token, place, stop, number, items)


def paged_records(spark: SparkSession, bundle: Bundle, checkpoint: dict | None = None, stream: bool = False) -> DataFrame:
    """(source_object_id, ordinal, payload, provenance, checkpoint, error_code) of a chain of JSON pages; checkpoint is where a reader that has taken the record goes on.

    identityFields (dotted paths) make the id; a record in which one is missing or blank has ING_SOURCE_IDENTITY_MISSING.
    The configuration may name no route or credential.
    """
    c = dict(bundle.config)
    gateway, root = c.pop("gateway", f"{__name__}:folder_gateway"), c.pop("root", "")
    if any(re.search(FORBIDDEN, k.lower()) for k in c if k not in KNOWN):
        raise AcquisitionError("ING_RAW_ROUTE_FORBIDDEN", "CONFIGURATION")
    fields = c.pop("identityFields", None)
    if not fields:
        raise AcquisitionError("ING_IDENTITY_FIELDS_REQUIRED", "CONFIGURATION")
    kind = c.pop("typeCode", "OBJECT")
    spark.dataSource.register(PagedJson)
    options = {k: str(v) for k, v in c.items()} | {"bindings": json.dumps([bundle.binding]), "gateway": gateway, "root": root, "checkpoint": json.dumps({bundle.binding: checkpoint or {}})}
    PagedJson(options).chains()  # refuses bad configurations before anything runs
    rows = (spark.readStream if stream else spark.read).format("paged_json").options(**options).load()
    own = native_id(F.lit(bundle.source_id), F.lit(kind), {f: path_get(F.col("payload"), f) for f in fields})
    at = F.struct(F.col("page_token").alias("pageToken"), F.col("page_offset").alias("pageOffset"), (F.col("ordinal") + 1).alias("recordIndex"))
    provenance = F.create_map(F.lit("bindingRef"), F.col("binding"), F.lit("page"), F.col("page_token"))
    return rows.select(own.alias("source_object_id"), "ordinal", "payload", provenance.alias("provenance"), at.alias("checkpoint"), F.when(own.isNull(), "ING_SOURCE_IDENTITY_MISSING").alias("error_code"))


def managed_rows(spark: SparkSession, bundle: Bundle, checkpoint: dict | None = None, stream: bool = False) -> DataFrame:
    """Rows of a managed delimited file past the checkpoint's ordinal."""
    if stream:
        raise AcquisitionError("ING_ADAPTER_MODE_UNSUPPORTED", "CONFIGURATION")
    rows = read_delimited(spark, bundle.binding, bundle.config.get("csvDelimiter", ","))
    after = (checkpoint or {}).get("ordinal", 0)
    if after and (rows.agg(F.max("ordinal")).first()[0] or 0) < after:
        raise AcquisitionError("ING_CHECKPOINT_OUT_OF_RANGE", "CONFIGURATION")
    return rows.where(F.col("ordinal") > after)


#: The adapters of the library.
ADAPTERS = Adapters(
    Adapter("gateway-rest-json-v1", frozenset({"REST_JSON"}), "1.0.0", "1.0.0", paged_records),
    Adapter("managed-tabular-v1", frozenset({"INTERNAL_MANAGED_CSV"}), "1.0.0", "1.0.0", managed_rows),
)
