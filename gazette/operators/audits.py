"""Audits of sources, snapshots and staging records: each rule gives the rows that break it, with a severity; no error: passed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions import urls


def _fault(rows: DataFrame, rule: str, key: Column | str, detail: Column | str | None = None, severity: Column | str = "error") -> DataFrame:
    said = F.lit(None).cast("string") if detail is None else (F.col(detail) if isinstance(detail, str) else detail).cast("string")
    of = (F.col(key) if isinstance(key, str) else key).cast("string")
    return rows.select("edition", F.lit(severity).alias("severity") if isinstance(severity, str) else severity.alias("severity"), F.lit(rule).alias("rule"), of.alias("key"), said.alias("detail"))


def _all(*faults: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, faults)


@dataclass(frozen=True, kw_only=True)
class Sources:
    """What an edition's stories have to be: numbers are fixed values of an edition, domains and paths a policy's."""

    sections: int = 15
    stories: int = 150
    items: int = 10
    least_domains: int = 5
    most_share: float
    most_wire: float
    wire: tuple[str, ...]
    discovery: tuple[str, ...]
    generic: tuple[str, ...]
    research_items: int = 10
    research_domains: int = 5


def source_faults(stories: DataFrame, research: DataFrame, policy: Sources, strict: bool = False) -> DataFrame:
    """edition, severity, rule, key, detail over ``stories`` (edition, section, title, url) and ``research`` (edition, title, url).

    Few domains, shares of one domain and of wires, discovery domains and generic paths are warnings, and errors with
    ``strict``; all else is an error. Domains are counted first by section and domain, so that no section is brought together.
    """
    soft = "error" if strict else "warning"
    s = stories.withColumn("domain", urls.domain(F.col("url")))
    by = s.groupBy("edition", "section", "domain").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("domain").isNotNull()
    section = by.groupBy("edition", "section").agg(
        F.sum("n").alias("items"), F.count_if(known).alias("domains"), F.coalesce(F.max(F.when(known, F.col("n"))), F.lit(0)).alias("most"), F.coalesce(F.sum(F.when(F.col("domain").isin(*policy.wire), F.col("n"))), F.lit(0)).alias("wire"),
    )
    edition = section.groupBy("edition").agg(F.sum("items").alias("stories"), F.count(F.lit(1)).alias("sections"))
    again = s.filter(F.col("url").isNotNull()).groupBy("edition", "url").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    missing = F.col("url").isNull() | (F.col("url") == "")
    where = F.coalesce(F.nullif(urls.path(F.col("url")), F.lit("")), F.lit("/"))
    schemed = F.regexp_extract(F.coalesce("url", F.lit("")), "^([A-Za-z][A-Za-z0-9+.-]*)://[^/?#]", 1)
    r = research.withColumn("domain", urls.domain(F.col("url")))
    of = r.groupBy("edition").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("domain").alias("domains"))
    return _all(
        _fault(edition.filter(F.col("stories") != policy.stories), "story_count", F.lit("stories"), "stories"), _fault(edition.filter(F.col("sections") != policy.sections), "section_count", F.lit("sections"), "sections"),
        _fault(again, "duplicate_url", "url", "n"), _fault(section.filter(F.col("items") != policy.items), "section_items", "section", "items"),
        _fault(section.filter(F.col("domains") < policy.least_domains), "few_domains", "section", "domains", soft), _fault(section.filter(F.col("most") / F.col("items") > policy.most_share), "domain_share", "section", "most", soft),
        _fault(section.filter(F.col("wire") / F.col("items") > policy.most_wire), "wire_share", "section", "wire", soft),
        _fault(s.filter(missing | (schemed == "")), "missing_url", "title"), _fault(s.filter(~missing & (schemed != "") & ~F.lower(schemed).isin("http", "https")), "non_http", "url", "title"),
        _fault(s.filter(F.col("domain").isin(*policy.discovery)), "discovery_only", "url", "title", soft), _fault(s.filter(known & where.isin(*policy.generic)), "generic_url", "url", "title", soft),
        _fault(of.filter(F.col("n") != policy.research_items), "research_items", F.lit("research"), "n"), _fault(of.filter(F.col("domains") < policy.research_domains), "research_domains", F.lit("research"), "domains"),
        _fault(r.filter(~known), "research_url", "title"), _fault(r.filter(F.col("domain").isin(*policy.discovery)), "research_discovery", "url", "title"),
    )


#: A snapshot's manifest.
MANIFEST = """edition string, schema_version string, snapshot_status string, selected_files array<string>, selected_count long, target_per_chapter long, minimum_unique_domains long, max_per_domain long, cross_chapter_duplicate_urls array<string>,
fingerprint_algorithm string, selection_fingerprint_sha256 string, chapter_report map<string,struct<selected_count:long,unique_domains:long,domain_counts:map<string,long>,status:string>>"""


@dataclass(frozen=True, kw_only=True)
class Snapshot:
    """What a frozen selection has to be."""

    schema: str
    status: str
    algorithm: str
    chapters: tuple[str, ...]
    target: int = 10
    discovery: tuple[str, ...] = ()
    generic: tuple[str, ...] = ()
    required: tuple[str, ...] = ("chapter", "source", "title", "published", "domain")


def record_url(canonical: Column, url: Column) -> Column:
    return F.trim(F.coalesce(F.nullif(canonical, F.lit("")), url, F.lit("")))


def fingerprints(items: DataFrame) -> DataFrame:
    """edition, fingerprint: the digest of the lines ``chapter|address`` of each edition in the order of pos. An edition is a desk's selection, some dozen rows."""
    line = F.concat_ws("|", F.coalesce("chapter", F.lit("")), record_url(F.col("canonical_url"), F.col("url")))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))), lambda x: x.line)
    return items.groupBy("edition").agg(F.sha2(F.array_join(lines, "\n"), 256).alias("fingerprint"))


def snapshot_faults(manifest: DataFrame, items: DataFrame, contract: Snapshot) -> DataFrame:
    """edition, severity, rule, key, detail over a ``manifest`` (MANIFEST) and its ``items`` (edition, pos, chapter, source, title, published, domain, url, canonical_url).

    Counts, caps, digest and the manifest's own report of each chapter are worked out again and compared.
    """
    m = manifest.join(items.groupBy("edition").agg(F.count(F.lit(1)).alias("there")), "edition", "left").join(fingerprints(items), "edition", "left").withColumn("there", F.coalesce("there", F.lit(0)))
    files, all_ = F.coalesce("selected_files", F.array().cast("array<string>")), contract.target * len(contract.chapters)
    x = items.withColumn("address", record_url(F.col("canonical_url"), F.col("url")))
    host, path = urls.domain(F.col("address")), F.coalesce(F.nullif(F.regexp_replace(urls.path(F.col("address")), "/+$", ""), F.lit("")), F.lit("/"))
    again = x.filter("address <> ''").groupBy("edition", "address").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    missing = [_fault(x.filter(F.coalesce(F.col(c).cast("string"), F.lit("")) == ""), f"missing_{c}", "pos") for c in contract.required]
    by = x.groupBy("edition", "chapter", "domain").agg(F.count(F.lit(1)).alias("n"))
    named = F.coalesce("domain", F.lit("")) != ""
    counted = by.groupBy("edition", "chapter").agg(F.sum("n").alias("rows"), F.count_if(named).alias("domains"), F.coalesce(F.max(F.when(named, F.col("n"))), F.lit(0)).alias("most"), F.array_sort(F.collect_list(F.when(named, F.struct("domain", "n")))).alias("counts"))
    wanted = m.select("edition", F.coalesce("target_per_chapter", F.lit(contract.target)).alias("target"), F.coalesce("minimum_unique_domains", F.lit(5)).alias("least"), F.coalesce("max_per_domain", F.lit(2)).alias("cap"), "chapter_report", F.explode(F.array(*[F.lit(c) for c in contract.chapters])).alias("chapter"))
    c = wanted.join(counted, ["edition", "chapter"], "left").withColumns({"rows": F.coalesce("rows", F.lit(0)), "report": F.col("chapter_report")[F.col("chapter")]})
    whole = c.filter("rows = target")  # other rules of a chapter are told only if it is whole
    differs = lambda a, b: ~a.eqNullSafe(b)
    reported = F.array_sort(F.transform(F.map_entries("report.domain_counts"), lambda e: F.struct(e.key.alias("domain"), e.value.alias("n"))))
    final = x.join(whole.select("edition", "chapter"), ["edition", "chapter"], "left_semi")
    return _all(
        _fault(m.filter(differs(F.col("schema_version"), F.lit(contract.schema))), "schema_version", "edition", "schema_version"), _fault(m.filter(differs(F.col("snapshot_status"), F.lit(contract.status))), "snapshot_status", "edition", "snapshot_status"),
        _fault(m.filter((F.size(files) != len(contract.chapters)) | (F.size(F.array_distinct(files)) != len(contract.chapters))), "selected_files", "edition", F.size(files)),
        _fault(m.filter((F.col("there") != all_) | differs(F.col("selected_count"), F.lit(all_).cast("long"))), "selected_count", "edition", "there"), _fault(m.filter(differs(F.col("target_per_chapter"), F.lit(contract.target).cast("long"))), "target_per_chapter", "edition", "target_per_chapter"),
        _fault(m.filter(F.size(F.coalesce("cross_chapter_duplicate_urls", F.array().cast("array<string>"))) > 0), "cross_chapter_duplicates", "edition"), _fault(m.filter(differs(F.col("fingerprint_algorithm"), F.lit(contract.algorithm))), "fingerprint_algorithm", "edition", "fingerprint_algorithm"),
        _fault(m.filter(differs(F.col("fingerprint"), F.col("selection_fingerprint_sha256"))), "fingerprint", "edition"),
        _fault(x.filter(~urls.is_http(F.col("address"))), "not_absolute", "pos", "address"), _fault(again, "duplicate_url", "address", "n"), *missing,
        _fault(x.filter(~F.coalesce(F.col("chapter").isin(*contract.chapters), F.lit(False))).select("edition", "chapter").distinct(), "unknown_chapter", "chapter"),
        _fault(c.filter("rows <> target"), "chapter_rows", "chapter", "rows"), _fault(whole.filter("domains < least"), "few_domains", "chapter", "domains"), _fault(whole.filter("most > cap"), "domain_cap", "chapter", "most"),
        _fault(whole.filter(differs(F.col("report.selected_count"), F.col("rows"))), "report_count", "chapter", "report.selected_count"), _fault(whole.filter(differs(F.col("report.unique_domains"), F.col("domains"))), "report_domains", "chapter", "report.unique_domains"),
        _fault(whole.filter(differs(reported, F.col("counts"))), "report_domain_counts", "chapter"), _fault(whole.filter(differs(F.col("report.status"), F.lit("PASS"))), "report_status", "chapter", "report.status"),
        _fault(final.filter(host.isin(*contract.discovery)), "discovery_only", "pos", "address"), _fault(final.filter(urls.is_http(F.col("address")) & path.isin(*contract.generic)), "generic_url", "pos", "address"),
    )


@dataclass(frozen=True, kw_only=True)
class Staging:
    """What staging records have to be: fields of a text, statuses of its check, the letters that a text has to have."""

    schema: str
    chapters: tuple[str, ...]
    fields: tuple[str, ...]
    local: tuple[str, ...]
    statuses: tuple[str, ...]
    script: str = "[가-힣]"
    target: int = 10


def staging_faults(records: DataFrame, headers: DataFrame, contract: Staging, require_ready: bool = False, scope: str | None = None) -> DataFrame:
    """edition, severity, rule, key, detail over staging ``records`` and their ``headers`` (edition, schema_version, production_ready).

    A record has edition, chapter, staging_id, final_url, canonical_url, source_url, verification_status,
    image_review_required, factcheck_status and editorial, a map of texts by field. It is ready if it has all fields, local
    ones in local letters, a known check, a verified article and a reviewed image; with ``require_ready`` others are
    errors. Unverified articles are warnings. With ``scope`` only that chapter's records are looked at one by one.
    """
    by = records.groupBy("edition", "chapter").agg(F.count(F.lit(1)).alias("n"))
    all_ = headers.join(records.groupBy("edition").agg(F.count(F.lit(1)).alias("n")), "edition", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    wanted = headers.select("edition", F.explode(F.array(*[F.lit(c) for c in contract.chapters])).alias("chapter")).join(by, ["edition", "chapter"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    r = records if scope is None else records.filter(F.col("chapter") == scope)
    r = r.withColumn("address", F.coalesce(F.nullif("canonical_url", F.lit("")), F.nullif("final_url", F.lit("")), F.nullif("source_url", F.lit("")), F.lit("")))
    said = lambda f: F.trim(F.coalesce(F.col("editorial")[f], F.lit("")))
    fact = F.trim(F.coalesce("factcheck_status", F.lit("")))
    lacking = F.array_compact(F.array(*[F.when(said(f) == "", F.lit(f)) for f in contract.fields], F.when(fact == "", F.lit("factcheck_status"))))
    foreign = F.array_compact(F.array(*[F.when((said(f) != "") & ~said(f).rlike(contract.script), F.lit(f)) for f in contract.local]))
    r = r.withColumns({"missing": lacking, "foreign": foreign, "fact": fact})
    sound = F.coalesce(F.col("verification_status") == "VERIFIED", F.lit(False)) & F.coalesce(~F.col("image_review_required"), F.lit(False))
    r = r.withColumn("ready", (F.size("missing") == 0) & (F.size("foreign") == 0) & F.col("fact").isin(*contract.statuses) & sound)
    again = r.groupBy("edition", "address").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = r.groupBy("edition").agg(F.count(F.lit(1)).alias("n"), F.count_if("ready").alias("ready")).filter("ready <> n")
    faults = [
        _fault(headers.filter(~F.col("schema_version").eqNullSafe(F.lit(contract.schema))), "schema_version", "edition", "schema_version"), _fault(all_.filter(F.col("n") != contract.target * len(contract.chapters)), "record_count", "edition", "n"),
        _fault(wanted.filter(F.col("n") != contract.target), "chapter_records", "chapter", "n"), _fault(headers.filter(~F.col("production_ready").eqNullSafe(F.lit(False))), "production_ready", "edition"),
        _fault(r.filter(~urls.is_http(F.col("address"))), "invalid_url", "staging_id", "address"), _fault(again, "duplicate_url", "address", "n"),
        _fault(r.filter(~F.col("verification_status").eqNullSafe(F.lit("VERIFIED"))), "not_verified", "staging_id", "verification_status", "warning"), _fault(r.filter((F.col("fact") != "") & ~F.col("fact").isin(*contract.statuses)), "factcheck_status", "staging_id", "fact"),
        _fault(r.filter(F.size("foreign") > 0), "foreign_text", "staging_id", F.array_join("foreign", ",")),
    ]
    if scope is not None and scope not in contract.chapters:
        faults.append(_fault(headers, "scope", F.lit(scope)))
    if require_ready:
        faults += [_fault(r.filter("NOT ready"), "not_ready", "staging_id", F.array_join("missing", ",")), _fault(counts, "ready_count", F.lit(scope or "ALL"), "ready")]
    return _all(*faults)
