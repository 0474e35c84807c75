"""Rules on configurations: bindings, versions, ranges, labels, identities and pinned contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import canonical_json, content_hash, iso_duration_seconds, version_parts, version_within

#: The access labels.
LABELS = ("OPEN", "ANONYMOUS", "PERSONAL", "SENSITIVE", "RESTRICTED")
#: The ranges of a synchronisation policy, in seconds, counts and days.
SYNC_BOUNDS = {"poll": (60, 2678400), "timeout": (1, 300), "retries": (0, 100), "backoff": (1, 86400), "retention": (30, 3650)}

#: The ranges of a published synchronisation profile, by their paths below it.
PUBLISHED_BOUNDS = {
    "operationalPolicy.misfireToleranceSeconds": (1, 86400),
    "operationalPolicy.sourceTimeoutSeconds": (1, 300),
    "operationalPolicy.maxRetryAttempts": (0, 100),
    "retryBackoffSeconds": (1, 86400),
    "operationalPolicy.maxRetryElapsedSeconds": (1, 86400),
    "operationalPolicy.incidentDedupWindowSeconds": (1, 86400),
    "operationalPolicy.operationalRetentionDays": (30, 3650),
}
#: The classes of visibility of operational data.
VISIBILITY = ("PUBLIC_OPERATIONAL", "TENANT_OPERATIONAL", "RESTRICTED_OPERATIONAL", "SECURITY_SENSITIVE")


def exact_bindings(refs: DataFrame, bindings: DataFrame, historical: bool = False) -> DataFrame:
    """(ref, state) over refs(ref) and bindings(ref, status): EXACT, UNBOUND, UNUSED, AMBIGUOUS (several bindings) or INACTIVE.

    A binding must be ACTIVE; a historical reading takes DEPRECATED and RETIRED ones too.
    """
    usable = ["ACTIVE", "DEPRECATED", "RETIRED"] if historical else ["ACTIVE"]
    bound = bindings.groupBy("ref").agg(F.count("*").alias("n"), F.min(F.col("status").isin(usable)).alias("ok"))
    both = refs.select("ref").distinct().withColumn("r", F.lit(1)).join(bound, "ref", "full")
    state = F.when(F.col("n").isNull(), "UNBOUND").when(F.col("r").isNull(), "UNUSED").when(F.col("n") > 1, "AMBIGUOUS").when(~F.coalesce("ok", F.lit(False)), "INACTIVE").otherwise("EXACT")
    return both.select("ref", state.alias("state"))


def binding_count_valid(bindings: DataFrame, least: int = 1, most: int = 32) -> DataFrame:
    """One row: bindings, valid (their number lies within bounds)."""
    return bindings.agg(F.count("*").alias("bindings")).withColumn("valid", F.col("bindings").between(least, most))


def version_window(adapter: Column, version: Column, expected: str, oldest: str, current: str) -> Column:
    """Error code of an adapter's id and version, null inside the window."""
    return (
        F.when(adapter != expected, "ING_ADAPTER_ID_MISMATCH").when(version_parts(version).isNull(), "ING_ADAPTER_VERSION_INVALID")
        .when(~version_within(version, F.lit(oldest), F.lit(current)), "ING_ADAPTER_VERSION_UNSUPPORTED")
    )


def policy_violations(values: dict[str, Column], once: Column | None = None, bounds: dict[str, tuple[int, int]] = SYNC_BOUNDS) -> Column:
    """Names of the values outside their ranges; a policy that runs once must have no poll interval, any other one needs it."""
    bad = {k: ~c.between(*bounds[k]) for k, c in values.items()}
    if once is not None and "poll" in values:
        bad["poll"] = F.when(once, values["poll"].isNotNull()).otherwise(values["poll"].isNull() | bad["poll"])
    return F.filter(F.array(*(F.when(F.coalesce(b, F.lit(True)), k) for k, b in bad.items())), lambda x: x.isNotNull())


def access_labels(given: Column) -> tuple[Column, Column]:
    """(labels without repeats in their order, error_code); none, or an unknown one, is an error."""
    bad = F.coalesce(F.size(given), F.lit(0)) <= 0
    bad = bad | (F.size(F.array_except(given, F.array(*map(F.lit, LABELS)))) > 0)
    return F.when(~bad, F.array_distinct(given)), F.when(bad, "ING_ACCESS_LABEL_INVALID")


def duplicate_identities(records: DataFrame, asset: str, identity: str) -> DataFrame:
    """Identities that an asset holds more than once, with their number: any of them rejects the asset."""
    return records.groupBy(asset, identity).agg(F.count("*").alias("n")).where("n > 1")


def pinned_contract(doc: Column, flat: str, published: str) -> Column:
    """A contract reference of a snapshot, at its flat path or else at its path in the published bundle."""
    parsed = F.try_parse_json(doc)
    return F.coalesce(F.try_variant_get(parsed, flat, "string"), F.try_variant_get(parsed, published, "string"))


def configuration_hash(doc: Column) -> Column:
    """sha256 over a configuration with sorted keys, without its own checksum."""
    without = F.to_json(F.map_filter(F.try_variant_get(F.try_parse_json(doc), "$", "map<string,variant>"), lambda k, v: k != "checksum"))
    return content_hash(canonical_json(without))


def activation_error(doc: Column, tenant: Column) -> Column:
    """Error code of a published activation for `tenant`, a JSON text; null where it may be taken.

    The first that holds counts: an envelope and bundle of different sources, tenants or versions, or a bundle that is
    not ACTIVE; a checksum that is not the bundle's; an unknown status or mode. A managed source must have no poll
    interval. A polled one needs one of whole seconds in its range, a time zone, all numbers of PUBLISHED_BOUNDS and a
    class of VISIBILITY. Last the references, 1 to 100 of the form id@version, and a positive sequence number. Texts
    that are blank, missing or of another type are as bad as wrong ones, as is what is no JSON.
    """
    v = F.try_parse_json(doc)
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))

    def text(path: str) -> Column:
        return F.when((kind(path) == "STRING"), F.nullif(F.trim(F.try_variant_get(v, path, "string")), F.lit("")))

    def number(path: str) -> Column:
        n = F.try_variant_get(v, path, "double")
        return F.when((kind(path) != "STRING") & (n == F.floor(n)), n.cast("long"))

    def wrong(ok: Column) -> Column:
        return ~F.coalesce(ok, F.lit(False))

    sync, invalid = "$.bundle.syncProfile", "ING_PUBLICATION_INVALID"
    source, version = text("$.sourceId") == text("$.bundle.source.sourceId"), text("$.onboardingVersionId") == text("$.bundle.createdFromOnboardingVersion")
    own = (text("$.tenantId") == tenant) & source & version & (text("$.bundle.status") == "ACTIVE")
    told = text("$.bundle.checksum")
    actual = configuration_hash(F.to_json(F.try_variant_get(v, "$.bundle", "variant")))
    mode, poll = text("$.bundle.source.acquisitionMode"), text(f"{sync}.pollInterval")
    once = mode == "MANAGED"
    shape = poll.rlike(r"^P(?=\d|T\d)(\d+D)?(T(?=\d)(\d+H)?(\d+M)?(\d+(\.\d{1,9})?S)?)?$")
    zone = F.try_to_timestamp(F.concat(F.lit("2020-01-01 00:00:00 "), text(f"{sync}.operationalPolicy.timeZone"))).isNotNull()
    ranges = [number(f"{sync}.{k}").between(*b) for k, b in PUBLISHED_BOUNDS.items()]
    policy = zone & text(f"{sync}.operationalPolicy.operationalVisibilityClass").isin(*VISIBILITY)
    for r in ranges:
        policy = policy & r
    refs = F.try_variant_get(v, "$.bundle.semanticRefs", "array<variant>")
    exact = F.forall(refs, lambda x: (F.schema_of_variant(x) == "STRING") & F.coalesce(F.try_variant_get(x, "$", "string").rlike(r"^[^@\s]+@[^@\s]+$"), F.lit(False)))
    return F.coalesce(
        F.when(wrong(own) | told.isNull(), invalid),
        F.when(wrong((told == actual) & (told == text("$.checksum"))), "ING_PUBLICATION_HASH_MISMATCH"),
        F.when(wrong(text("$.sourceStatus").isin("REGISTERED", "ENABLED", "DISABLED")) | wrong(mode.isin("MANAGED", "PULL")) | ~kind(sync).startswith("OBJECT"), invalid),
        F.when(once & (kind(f"{sync}.pollInterval") != "VOID"), "ING_MANAGED_POLLING_FORBIDDEN"),
        F.when(~once & wrong(shape), invalid),
        F.when(~once & iso_duration_seconds(poll).isNull(), "ING_PUBLICATION_CADENCE_INVALID"),
        F.when(~once & wrong(policy), invalid),
        F.when(wrong(F.size(refs).between(1, 100)), "ING_PREFLIGHT_REFS_REQUIRED"),
        F.when(wrong(exact), "ING_PREFLIGHT_EXACT_REF_REQUIRED"),
        F.when(wrong(number("$.publicationSequence") >= 1), invalid),
    )
