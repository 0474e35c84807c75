"""Scalar functions of intake: identities, hashes, codes, texts and times as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

US = "\u001f"
#: What Unicode counts as white space without the no-break spaces, for a regular expression.
BLANK = r"[\t-\r\x1c-\x20  -  -    　]"


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip_ws(c) == "")


def content_hash(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def _fields(fields: dict[str, Column]) -> list[Column]:
    return [F.concat(F.lit(f"{name}="), strip_ws(c)) for name, c in fields.items()]


def managed_row_id(source: Column, asset_hash: Column, sheet: Column, ordinal: Column) -> Column:
    return F.concat(F.lit("managed:"), F.sha2(F.concat_ws(US, source, F.lit("ROW"), asset_hash, sheet, ordinal.cast("string")), 256))


def managed_key_id(source: Column, fields: dict[str, Column]) -> Column:
    """Null where a key field is null or blank."""
    missing = reduce(lambda a, b: a | b, [is_blank(c) for c in fields.values()])
    return F.when(~missing, F.concat(F.lit("managed:"), F.sha2(F.concat_ws(US, source, F.lit("KEY"), *_fields(fields)), 256)))


def native_id(source: Column, type_code: Column, fields: dict[str, Column]) -> Column:
    missing = reduce(lambda a, b: a | b, [is_blank(c) for c in fields.values()])
    return F.when(~missing, F.concat(F.lit("native:"), F.sha2(F.concat_ws(US, source, type_code, *_fields(fields)), 256)))


def layer_feature_id(source: Column, layer: Column, fields: dict[str, Column]) -> Column:
    """Every part goes in with its length, so that no two key sets run together."""
    parts = [source, layer] + [x for name, c in fields.items() for x in (F.lit(name), strip_ws(c))]
    return F.concat(F.lit("managed-gpkg:"), F.sha2(F.concat(F.lit("GPKG1"), *(F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts)), 256))


def safe_code(c: Column, fallback: str) -> Column:
    return F.when(c.rlike("^(ING_[A-Z0-9_]{1,76}|[A-Z0-9_]{1,80})$"), c).otherwise(fallback)


def iso_micros(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_duration_seconds(c: Column) -> Column:
    """Whole seconds of PnDTnHnMnS within 60 to 2678400; null otherwise."""
    number = lambda unit, part: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(c, part, 1), F.lit("")), F.lit("999999999")).cast("long"), F.lit(0)) * unit
    total = number(86400, r"^P(\d+)D") + number(3600, r"T(?:\d+M)?(\d+)H") + number(60, r"T(?:\d+H)?(\d+)M") + number(1, r"T(?:\d+H)?(?:\d+M)?(\d+)S$")
    ok = c.rlike(r"^P(?=\d|T\d)(\d{1,5}D)?(T(?=\d)(\d{1,6}H)?(\d{1,7}M)?(\d{1,8}S)?)?$")
    return F.when(ok & total.between(60, 2678400), total)


def backoff_seconds(attempt: Column, key: Column) -> Column:
    """5 * 2^min(attempt - 1, 7) seconds, at most 900, and a jitter below a fifth of that from the key's hash."""
    base = F.least(F.lit(900), F.lit(5) * F.pow(F.lit(2), F.least(attempt - 1, F.lit(7))).cast("int"))
    return base + F.pmod(F.xxhash64(key, attempt), base / 5 + 1).cast("int")


def version_parts(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{1,9}\.\d{1,9}\.\d{1,9}$"), F.transform(F.split(c, r"\."), lambda x: x.cast("int")))


def version_within(c: Column, oldest: Column, current: Column) -> Column:
    v = version_parts(c)
    return (v >= version_parts(oldest)) & (v <= version_parts(current))


def path_get(json: Column, path: str) -> Column:
    """Value at a dotted path as text; null where a level is missing or no object."""
    return F.get_json_object(json, "$." + path)


def canonical_json(doc: Column) -> Column:
    """A JSON text with the keys of every object sorted and nothing between its signs; null if it is none."""
    return F.to_json(F.try_parse_json(doc))


def quoted(c: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(c))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def canonical_fingerprint(doc: Column, depth: int = 4) -> Column:
    """canonical_json with the elements of arrays sorted by their texts too, down to `depth` levels of nesting; deeper ones keep their order."""

    def text(v: Column, left: int) -> Column:
        if not left:
            return F.to_json(v)
        kind = F.schema_of_variant(v)
        parts = F.array_sort(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: text(x, left - 1)))
        fields = F.try_variant_get(v, "$", "map<string,variant>")
        named = F.transform(F.array_sort(F.map_keys(fields)), lambda k: F.concat(quoted(k), F.lit(":"), F.coalesce(text(fields[k], left - 1), F.lit("null"))))
        return F.when(kind.startswith("ARRAY"), F.concat(F.lit("["), F.array_join(parts, ",", "null"), F.lit("]"))).when(
            kind.startswith("OBJECT"), F.concat(F.lit("{"), F.array_join(named, ","), F.lit("}"))
        ).otherwise(F.to_json(v))

    return text(F.try_parse_json(doc), depth)


def any_value_equals(doc: Column, ref: Column) -> Column:
    """Whether a text value anywhere in a JSON text, at any depth, equals ref; keys do not count. False for what is no JSON."""
    return F.coalesce(F.array_contains(text_values(doc), quoted(ref)), F.lit(False))


def text_values(doc: Column) -> Column:
    """All text values of a JSON text at any depth, as JSON strings."""
    told = F.regexp_extract_all(F.to_json(F.try_parse_json(doc)), F.lit(r'"(?:[^"\\]|\\.)*":?'), F.lit(0))
    return F.filter(told, lambda t: ~t.endswith(":"))


def retry_after_seconds(header: Column, now: Column) -> Column:
    """What a Retry-After header gives: positive seconds, or an RFC 1123 date less `now`; null for anything else."""
    text = strip_ws(header)
    seconds = F.when(text.rlike("^[0-9]{1,18}$"), text.cast("long"))
    months = F.map_from_arrays(F.array(*map(F.lit, "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split())), F.array(*(F.lit(f"{i:02d}") for i in range(1, 13))))
    part = lambda i: F.regexp_extract(text, r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), ([0-9]{1,2}) ([A-Z][a-z]{2}) ([0-9]{4}) ([0-9]{2}:[0-9]{2}:[0-9]{2}) GMT$", i)
    at = F.try_to_timestamp(F.concat(part(3), F.lit("-"), F.try_element_at(months, part(2)), F.lit("-"), F.lpad(part(1), 2, "0"), F.lit("T"), part(4), F.lit("Z")))
    wait = F.coalesce(seconds, F.unix_seconds(at) - F.unix_seconds(now))
    return F.when(wait > 0, wait)


def jittered_after(now: Column, attempt: Column, key: Column) -> Column:
    return now + F.make_dt_interval(secs=backoff_seconds(attempt, key).cast("double"))
