"""Sources as DataFrames: assets, sheet cells, paged JSON, XML features, feature layers and their geometries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import buckets
from ..operators.ordered import running
from ..plans.scratch import written


def asset_status(rows: DataFrame, max_rows: int = 100_000, identity: str | None = None) -> DataFrame:
    """(file, n_rows, asset_error) of rows(file, ordinal, error_code): the code of the first bad row, else of too many rows or of an identity that comes twice."""
    first = F.min(F.when(F.col("error_code").isNotNull(), F.struct("ordinal", "error_code")))["error_code"]
    out = rows.groupBy("file").agg(F.count("*").alias("n_rows"), first.alias("bad"))
    twice = F.lit(None).cast("boolean")
    if identity is not None:
        again = rows.groupBy("file", identity).agg(F.count("*").alias("c")).where("c > 1").select("file").distinct().withColumn("again", F.lit(True))
        out, twice = out.join(again, "file", "left"), F.col("again")
    code = F.coalesce("bad", F.when(F.col("n_rows") > max_rows, "ING_MANAGED_TOO_MANY_ROWS"), F.when(twice, "ING_MANAGED_IDENTITY_DUPLICATE"))
    return out.select("file", "n_rows", code.alias("asset_error"))


def release_assets(rows: DataFrame, max_rows: int = 100_000, identity: str | None = None) -> DataFrame:
    """The rows of files without any error: all rows of a file are judged before one is released."""
    good = asset_status(rows, max_rows, identity).where("asset_error is null").select("file")
    return rows.join(good, "file", "left_semi").drop("error_code")


def sheet_records(cells: DataFrame, sheet: str) -> DataFrame:
    """(file, ordinal, payload, error_code) from cells(file, sheet, row, col, cell_type, value): the first row is the header.

    A header with a blank, missing or repeated name is ING_MANAGED_HEADER_INVALID: one row with its ordinal and no
    payload, and none of the file's records.
    """
    own = cells.where(F.col("sheet") == sheet)
    top = own.groupBy("file").agg(F.min("row").alias("top"))
    own = own.join(top, "file")
    header = own.where("row = top").select("file", "top", "col", F.trim("value").alias("name"))
    told = header.groupBy("file", "top").agg(F.count("*").alias("cells"), F.countDistinct(F.nullif("name", F.lit(""))).alias("names")).withColumn("bad", F.col("cells") != F.col("names"))
    body = own.where("row > top").join(told.where("not bad").select("file"), "file", "left_semi").join(header.drop("top"), ["file", "col"])
    code = F.when(F.col("cell_type") == "FORMULA", "ING_MANAGED_FORMULA_FORBIDDEN").when(F.col("cell_type") == "ERROR", "ING_MANAGED_CELL_ERROR")
    value = F.when(F.col("cell_type") != "BLANK", F.col("value"))
    entries = F.array_sort(F.collect_list(F.struct(F.col("name").alias("key"), value.alias("value"))))
    rows = body.groupBy("file", F.col("row").alias("ordinal")).agg(F.map_from_entries(entries).alias("payload"), F.min(code).alias("error_code"))
    refused = told.where("bad").select("file", F.col("top").alias("ordinal"), F.lit(None).cast("map<string,string>").alias("payload"), F.lit("ING_MANAGED_HEADER_INVALID").alias("error_code"))
    return rows.unionByName(refused)


def json_page_records(pages: DataFrame, items: str, next_token: str = "$.nextPageToken", max_bytes: int = 1 << 20, max_pages: int = 1000, max_records: int = 100_000) -> DataFrame:
    """(ordinal, page, item, next_token, error_code): the objects at `items` of pages(page, body), in page order from 0.

    A page that is too large, is no JSON, lacks the array or holds anything but objects is one row with its code. Pages from
    the max_pages-th and records from the max_records-th on have ING_PAGE_LIMIT_EXCEEDED or ING_RECORD_LIMIT_EXCEEDED.
    """
    doc = F.try_parse_json("body")
    token = F.nullif(F.trim(F.try_variant_get(doc, next_token, "string")), F.lit(""))
    found = pages.select("page", F.octet_length("body").alias("bytes"), doc.isNull().alias("broken"), F.try_variant_get(doc, items, "array<variant>").alias("items"), token.alias("next_token"))
    plain = F.exists("items", lambda x: ~F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))
    code = F.when(F.col("bytes") > max_bytes, "ING_PAGE_TOO_LARGE").when(F.col("broken"), "ING_JSON_INVALID").when(F.col("items").isNull(), "ING_JSON_ITEMS_INVALID").when(plain, "ING_JSON_RECORD_INVALID")
    found = found.withColumn("error_code", code)
    # a row for each page: its number and how many records come before it
    counts = found.groupBy("page").agg(F.sum(F.coalesce(F.when(F.col("error_code").isNull(), F.size("items")), F.lit(0))).alias("n"))
    base = running(counts, [], ["page"], {"base": F.col("n"), "page_no": F.lit(1)}).select("page", (F.col("base") - F.col("n")).alias("base"), "page_no")
    found = found.join(base, "page").withColumn("error_code", F.when(F.col("page_no") > max_pages, "ING_PAGE_LIMIT_EXCEEDED").otherwise(F.col("error_code")))
    rows = found.select("page", "base", "next_token", "error_code", F.posexplode_outer(F.when(F.col("error_code").isNull(), F.col("items"))).alias("i", "v"))
    ordinal = F.when(F.col("error_code").isNull(), F.col("base") + F.col("i"))
    over = F.when(ordinal >= max_records, "ING_RECORD_LIMIT_EXCEEDED")
    return rows.select(ordinal.alias("ordinal"), "page", F.to_json("v").alias("item"), "next_token", F.coalesce("error_code", over).alias("error_code")).where("item is not null or error_code is not null")


def page_chain(pages: DataFrame, most: int) -> DataFrame:
    """(page_token, depth, error_code): the pages(page_token, next_token) that follow one another from the null token, at most `most`.

    A blank or missing next token, or one without a page, ends the chain. The page that leads back to one before it has
    ING_PAGE_CYCLE, the last of `most` ING_PAGE_LIMIT_EXCEEDED if another would follow. Of several pages of one token the
    one of the least next token counts.

    Every page holds where a jump leads from it; the chain's begin is doubled by one jump of all its pages, and jumps are
    doubled by a self-join, so that a chain of n pages takes about log2(n) rounds, each an equi-join of narrow rows.
    """
    spark = pages.sparkSession
    kept = lambda df, label: spark.read.schema(df.schema).parquet(written(df, label))
    # "0" is the first page's key, and a token's key is "1" and the token
    key = F.when(F.col("page_token").isNull(), "0").otherwise(F.concat(F.lit("1"), "page_token"))
    step = F.when(F.trim("next_token") != "", F.concat(F.lit("1"), "next_token"))
    links = kept(pages.groupBy(key.alias("p")).agg(F.min(step).alias("n")), "links")
    jumps = links.join(links.select(F.col("p").alias("n")), "n", "left_semi").select("p", "n")
    chain, reach = kept(links.where("p = '0'").select("p", F.lit(0).cast("long").alias("depth")), "chain"), 1
    size = chain.count()
    while size:
        further = chain.join(jumps, "p").select(F.col("n").alias("p"), (F.col("depth") + reach).alias("depth"))
        # a page that is met again lies on a cycle, and keeps its first place
        grown = chain.unionByName(further).where(F.col("depth") < most).groupBy("p").agg(F.min("depth").alias("depth"))
        chain = kept(grown, "chain")
        before, size, reach = size, chain.count(), reach * 2
        if size == before or reach >= most:
            break
        far = jumps.select(F.col("p").alias("n"), F.col("n").alias("far"))
        jumps = kept(jumps.join(far, "n").select("p", F.col("far").alias("n")), "jumps")
    on = chain.join(links, "p").join(chain.select(F.col("p").alias("n"), F.col("depth").alias("then")), "n", "left")
    follows = on.join(links.select(F.col("p").alias("n"), F.lit(True).alias("there")), "n", "left")
    code = F.when(F.col("then") <= F.col("depth"), "ING_PAGE_CYCLE").when((F.col("depth") == most - 1) & F.col("there"), "ING_PAGE_LIMIT_EXCEEDED")
    return follows.select(F.when(F.col("p") != "0", F.substr("p", F.lit(2))).alias("page_token"), F.col("depth").cast("int").alias("depth"), code.alias("error_code"))


_GML_ID = "{http://www.opengis.net/gml}id"


def _features(body: str) -> list[tuple[dict[str, str], str | None, str | None]]:
    """(fields, srsName, gml:id) of each feature of a collection; ValueError for what is no XML or has a DOCTYPE."""
    import xml.etree.ElementTree as ET
    from xml.parsers import expat

    def refuse(*_):
        raise ValueError("ING_XML_DOCTYPE_FORBIDDEN")

    try:
        strict = expat.ParserCreate()
        strict.StartDoctypeDeclHandler = refuse
        strict.Parse(body, True)
        root = ET.fromstring(body)
    except (expat.ExpatError, ET.ParseError) as e:
        raise ValueError("ING_WFS_XML_INVALID") from e
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    members = [e for e in root.iter() if local(e) == "member"] or [e for e in root.iter() if local(e) == "featureMember"]
    out = []
    for m in members:
        for feature in list(m)[:1]:
            srs = next((e.attrib["srsName"] for e in feature.iter() if "srsName" in e.attrib), None)
            out.append(({local(c): "".join(c.itertext()) for c in feature}, srs, feature.attrib.get(_GML_ID) or None))
    return out


def xml_feature_records(docs: DataFrame, axis_order: str, page_size: int | None = None) -> DataFrame:
    """(doc, ordinal, fields, srs_name, gml_id, axis_order, is_last, error_code): the features of collections(doc, body), the first element of each member.

    fields maps the local names of a feature's children to all text in them; of a name that comes twice the last one
    counts. srs_name is the first srsName on the feature or below it. A document that is no XML, or has a DOCTYPE, is
    one row with its code. is_last: the page has fewer features than page_size.
    """
    if axis_order not in ("AUTHORITY", "LON_LAT", "LAT_LON"):
        raise ValueError("ING_WFS_AXIS_ORDER_INVALID")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, body in zip(pdf["doc"], pdf["body"], strict=True):
                try:
                    found = _features(body or "")
                    last = page_size is None or len(found) < page_size
                    rows += [(doc, i, fields, srs, gml, last, None) for i, (fields, srs, gml) in enumerate(found)]
                except ValueError as e:
                    rows.append((doc, None, None, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["doc", "ordinal", "fields", "srs_name", "gml_id", "is_last", "error_code"]).astype({"ordinal": "Int64", "is_last": "boolean"})

    kind = dict(docs.dtypes)["doc"]
    out = docs.select("doc", "body").mapInPandas(run, f"doc {kind}, ordinal long, fields map<string,string>, srs_name string, gml_id string, is_last boolean, error_code string")
    return out.withColumn("axis_order", F.lit(axis_order))


#: The geometry types of feature layers.
GEOMETRY_TYPES = ("GEOMETRY", "POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON", "GEOMETRYCOLLECTION")


def layer_violations(contents: DataFrame, geometry_columns: DataFrame, systems: DataFrame, columns: DataFrame, max_layers: int = 64, max_columns: int = 256) -> DataFrame:
    """(table_name, error_code): why feature tables are no layers of layer_inventory(), and ING_LAYER_LIMIT_EXCEEDED with a null name if there are too many."""
    a = contents.where("data_type = 'features'").select("table_name", "srs_id")
    g = geometry_columns.select("table_name", F.col("srs_id").alias("g_srs"), "geometry_column", "geometry_type", "z", "m")
    s = systems.select("srs_id", "organization", "organization_id")
    per = columns.join(g.select("table_name", "geometry_column"), "table_name").groupBy("table_name").agg(
        F.count_if(F.col("pk") & (F.col("type") == "INTEGER")).alias("keys"), F.count_if(F.col("column_name") == F.col("geometry_column")).alias("geoms"), F.count("*").alias("n")
    )
    both = a.join(g, "table_name", "left").join(s, "srs_id", "left").join(per, "table_name", "left")
    code = (
        F.when(F.col("g_srs").isNull() | (F.col("g_srs") != F.col("srs_id")), "ING_LAYER_SRS_MISMATCH")
        .when(~F.coalesce((F.col("organization") == "EPSG") & F.col("organization_id").between(1, 999999), F.lit(False)), "ING_LAYER_SRS_UNSUPPORTED")
        .when((F.col("z") != 0) | (F.col("m") != 0) | ~F.upper("geometry_type").isin(*GEOMETRY_TYPES), "ING_LAYER_GEOMETRY_UNSUPPORTED")
        .when(F.coalesce("keys", F.lit(0)) != 1, "ING_LAYER_KEY_INVALID").when(F.coalesce("geoms", F.lit(0)) != 1, "ING_LAYER_GEOMETRY_MISSING").when(F.col("n") > max_columns, "ING_LAYER_TOO_MANY_COLUMNS")
    )
    many = a.agg(F.count("*").alias("c")).where(F.col("c") > max_layers).select(F.lit(None).cast("string").alias("table_name"), F.lit("ING_LAYER_LIMIT_EXCEEDED").alias("error_code"))
    return both.select("table_name", code.alias("error_code")).where("error_code is not null").unionByName(many)


def layer_inventory(contents: DataFrame, geometry_columns: DataFrame, systems: DataFrame, columns: DataFrame) -> DataFrame:
    """Feature layers whose geometry column and reference system agree, with one integer key and their geometry column present."""
    a = contents.where("data_type = 'features'").select("table_name", "srs_id")
    g = geometry_columns.where("z = 0 and m = 0").where(F.upper("geometry_type").isin(*GEOMETRY_TYPES)).select("table_name", "srs_id", "geometry_column", "geometry_type")
    s = systems.where("organization = 'EPSG' and organization_id between 1 and 999999").select("srs_id", "organization_id")
    both = a.join(g, ["table_name", "srs_id"]).join(s, "srs_id")
    per = columns.join(both.select("table_name", "geometry_column"), "table_name").groupBy("table_name").agg(
        F.count_if(F.col("pk") & (F.col("type") == "INTEGER")).alias("keys"), F.count_if(F.col("column_name") == F.col("geometry_column")).alias("geoms"), F.count("*").alias("n")
    )
    return both.join(per.where("keys = 1 and geoms = 1 and n <= 256"), "table_name").select("table_name", "organization_id", "geometry_column", "geometry_type", F.col("n").alias("column_count"))


def layer_features(
    features: DataFrame, key: str, columns: list[str], doubles: list[str], max_rows: int, texts: list[str] = (), max_cell: int = 32_767, blobs: list[str] = (), provenance: dict[str, str] | None = None
) -> DataFrame:
    """Declared columns with error_code; more than max_rows rows, a non-finite number, a long text or a blob beside the geometry is an error.

    provenance: constants (layer, sourceCrs, srsId, geometryColumn, contentHash) that each row carries with its featureId, as a map.
    """
    rows = features.select(key, *columns, *blobs)
    odd, long, blob = F.lit(False), F.lit(False), F.lit(False)
    for c in doubles:
        odd = odd | F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
    for c in texts:
        long = long | F.coalesce(F.length(c) > max_cell, F.lit(False))
    for c in blobs:
        blob = blob | F.col(c).isNotNull()
    total = rows.agg(F.count("*").alias("__n"))
    code = F.when(F.col("__n") > max_rows, "ING_LAYER_TOO_MANY_ROWS").when(F.coalesce(odd, F.lit(False)), "ING_NUMBER_NOT_FINITE").when(long, "ING_LAYER_TEXT_TOO_LONG").when(blob, "ING_LAYER_BLOB_FORBIDDEN")
    out = rows.crossJoin(F.broadcast(total)).withColumn("error_code", code).drop("__n", *blobs)  # one row
    if provenance is None:
        return out
    pairs = [x for k, v in provenance.items() for x in (F.lit(k), F.lit(v))]
    return out.withColumn("provenance", F.create_map(*pairs, F.lit("featureId"), F.col(key).cast("string")))


_TYPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}


class _Wkb:
    """Two-dimensional well-known binary of one blob; any defect raises ValueError."""

    def __init__(self, blob: bytes, srs: int):
        if len(blob) < 8 or blob[:2] != b"GP" or blob[2] != 0:
            raise ValueError("header")
        flags, order = blob[3], "<" if blob[3] & 1 else ">"
        if flags & 0xF0 or flags >> 1 & 7 > 1 or int(np.frombuffer(blob, order + "i4", 1, 4)[0]) != srs:
            raise ValueError("header")
        self.at, self.blob, self.left = 8 + 32 * (flags >> 1 & 7), blob, 100_000
        if self.at > 8 and not np.isfinite(np.frombuffer(blob, order + "f8", 4, 8)).all():
            raise ValueError("envelope")

    def numbers(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.blob, kind, n, self.at)
        self.at += out.nbytes
        return out

    def points(self, order: str, n: int) -> list:
        self.left -= n
        if self.left < 0 or n < 1:
            raise ValueError("budget")
        xy = self.numbers(order + "f8", 2 * n)
        if not np.isfinite(xy).all():
            raise ValueError("number")
        return xy.reshape(n, 2).tolist()

    def read(self, depth: int = 0, only: int | None = None) -> dict:
        if depth > 16 or self.at >= len(self.blob):
            raise ValueError("depth")
        order = {0: ">", 1: "<"}[self.blob[self.at]]
        self.at += 1
        kind = int(self.numbers(order + "u4", 1)[0])
        if kind not in _TYPES or only is not None and kind != only:
            raise ValueError("type")
        if kind == 1:
            return {"type": "Point", "coordinates": self.points(order, 1)[0]}
        n = int(self.numbers(order + "u4", 1)[0])
        if kind == 2:
            return {"type": "LineString", "coordinates": self.points(order, n)}
        if n < 1 or n > self.left:
            raise ValueError("count")
        if kind == 3:
            return {"type": "Polygon", "coordinates": [self.points(order, int(self.numbers(order + "u4", 1)[0])) for _ in range(n)]}
        parts = [self.read(depth + 1, kind - 3 if kind < 7 else None) for _ in range(n)]
        return {"type": _TYPES[kind], "geometries": parts} if kind == 7 else {"type": _TYPES[kind], "coordinates": [p["coordinates"] for p in parts]}


def geometry_to_geojson(df: DataFrame, key: str, blob: str, srs_id: int) -> DataFrame:
    """(key, geojson, error_code) of a table of geometry blobs, in one pass over its batches."""
    import json

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for b in pdf[blob]:
                try:
                    w = _Wkb(bytes(b), srs_id)
                    g = w.read()
                    if w.at != len(w.blob):
                        raise ValueError("trailing")
                    out.append((json.dumps(g), None))
                except (ValueError, KeyError, TypeError, IndexError):
                    out.append((None, "ING_GEOMETRY_INVALID"))
            yield pd.DataFrame({key: pdf[key], "geojson": [o[0] for o in out], "error_code": [o[1] for o in out]})

    kind = dict(df.dtypes)[key]
    return df.select(key, blob).mapInPandas(run, f"{key} {kind}, geojson string, error_code string")


def asset_integrity(assets: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, state) of assets(path, content) against manifest(path, byte_length, hash): EXACT, MISMATCH or UNAPPROVED."""
    both = assets.select("path", F.octet_length("content").alias("n"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("h")).join(manifest, "path", "left")
    same = (F.col("n") == F.col("byte_length")) & (F.col("h") == F.col("hash"))
    return both.select("path", F.when(F.col("hash").isNull(), "UNAPPROVED").when(same, "EXACT").otherwise("MISMATCH").alias("state"))


ZONE = "zone string, source_id string, idempotency_key string, content string, content_hash string"


def write_zone(df: DataFrame, path: str) -> DataFrame:
    """Append one object for each idempotency key of df(zone, source_id, idempotency_key, content) that is not below path yet, by zone and bucket of the key, and read the zone back.

    A key is an object once over all zones and sources; of several in a batch the one of the least zone, source and
    content counts. What is there is looked up in the buckets of the batch's keys alone.
    """
    rows = df.select("zone", F.col("source_id").cast("string").alias("source_id"), "idempotency_key", "content")
    held = buckets.held_rows(rows, path, ZONE, "idempotency_key").select("idempotency_key")
    one = rows.groupBy("idempotency_key").agg(F.min(F.struct("zone", "source_id", "content")).alias("x")).select("x.zone", "x.source_id", "idempotency_key", "x.content")
    new = one.join(held, "idempotency_key", "left_anti").withColumn("content_hash", F.concat(F.lit("sha256:"), F.sha2("content", 256)))
    buckets.append(new, path, "idempotency_key", "zone")
    return buckets.held_at(df.sparkSession, path, ZONE)
