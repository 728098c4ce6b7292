"""Gates on whole editions: each gives the rows (edition, rule, detail) that break it. No rows: passed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from gazette.functions import urls

ARTICLE = """struct<id:string,link:string,title:string,editorial:struct<fact:string,background:string,why_it_matters:string,checkpoints:array<string>>,fact_check:struct<status:string,body_status:string>,
image:struct<status:string,url:string,content_hash:string,declaration_method:string,source_domain:string,article_domain:string>,research:struct<evidence_type:string,study_design:string,clinical_meaning:string,limitations:string,exact_source_url:string>>"""
EDITION = f"""edition string, version string, date string, trends_source string, story_files array<string>, chapters array<struct<id:string,name:string,articles:array<{ARTICLE}>>>, top5 array<struct<id:string,link:string,title:string,chapter_id:string>>,
weather struct<location:string,temp_current:double,temp_min:double,temp_max:double,condition:string,precipitation_prob:double,source:string>, market map<string,string>, next_signals array<string>, trends array<string>, lines array<string>,
videos array<struct<url:string,channel:string>>, integrity_hash string, manifest_fingerprint string"""
STORY = "edition string, bundle int, url string, title string, freshness_note string"
MANIFEST = "edition string, edition_date string, timezone string, source_sha string, canonical_status string, production_fingerprint string, counts map<string,int>, manifest_sha256 string"
SOURCE = "registry string, id string, name string, domains array<string>, tier int, access array<string>, roles array<string>, topics array<string>"
PLACEHOLDER = r"(?i)(^|[^\p{L}\p{N}_])(undefined|null|tbd|todo|placeholder)([^\p{L}\p{N}_]|$)"


@dataclass(frozen=True)
class Contract:
    """Fixed values of an edition; each can be replaced."""

    chapters: int = 15
    articles: int = 10
    top5: int = 5
    research: str = "vision-research-watch"
    research_domains: int = 5
    relay: str = "news.google.com"
    place: str = "인천 서구 검단"
    statuses: tuple[str, ...] = ("VERIFIED_OFFICIAL", "VERIFIED_PRIMARY", "VERIFIED_MULTI_SOURCE", "PARTIAL", "UNVERIFIED", "ACCESS_BLOCKED", "CONFLICT")
    bodies: tuple[str, ...] = ("VALIDATED", "EVENT_MISMATCH", "NO_QUALIFIED_BODY", "HTTP_403", "HTTP_404", "HTTP_429", "TIMEOUT", "NON_HTML", "NETWORK_ERROR", "PARSE_ERROR", "COLLECTOR_ERROR")
    strict: str = "1.1.0"
    trends: tuple[int, int] = (0, 20)
    trends_source: str = "Google Trends KR official RSS"
    trends_withheld: str = "WITHHELD_INSUFFICIENT_RELIABLE_TERMS"
    opinion: str = r"^\[?(사설|칼럼|기고|오피니언|opinion|editorial|column)\]?"
    market: tuple[str, ...] = ("kospi", "usd_krw")
    videos: int = 10
    channels: int = 4
    signals: int = 3
    lines: int = 3
    bundles: int = 5
    bundle_size: int = 30
    timezone: str = "Asia/Seoul"


def _told(rows: DataFrame, *rules: tuple[str, Column, Column | None]) -> DataFrame:
    """All rules over the same rows in one pass: (name, condition that breaks it, detail)."""
    each = [F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(name).alias("rule"), (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))).alias("detail"))) for name, broken, detail in rules]
    return rows.select("edition", F.explode(F.array_compact(F.array(*each))).alias("x")).select("edition", "x.rule", "x.detail")


def articles_of(editions: DataFrame, contract: Contract) -> DataFrame:
    """edition, strict, chapter, is_research, a: the articles of editions, one to a row."""
    c = editions.select("edition", (F.col("version") == contract.strict).alias("strict"), F.explode("chapters").alias("c"))
    return c.select("edition", F.coalesce("strict", F.lit(False)).alias("strict"), F.col("c.id").alias("chapter"), (F.col("c.id") == contract.research).alias("is_research"), F.explode("c.articles").alias("a"))


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def _of_host(url: Column, host: str) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^https?://([^/?#]*)", 1).endswith(host), F.lit(False))


def edition_faults(editions: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """The rules on chapters, articles, texts, statuses, pictures, research, weather, TOP5, market, signals, trends, lines, videos and digest."""
    e, k = editions, contract
    chapters = e.select("edition", F.explode("chapters").alias("c")).select("edition", "c.id", "c.name", F.size("c.articles").alias("n"))
    vision = F.col("id") == k.research
    counts = e.select("edition").join(chapters.groupBy("edition").agg(F.count_if(~vision).alias("general"), F.count_if(vision).alias("vision"), F.coalesce(F.sum(F.when(~vision, F.col("n"))), F.lit(0)).alias("articles")), "edition", "left").na.fill(0)
    out = [
        _told(counts, ("general_chapters", F.col("general") != k.chapters, F.col("general")), ("research_chapters", F.col("vision") > 1, F.col("vision")), ("general_articles", F.col("articles") != k.chapters * k.articles, F.col("articles"))),
        _told(chapters, ("chapter_articles", F.col("n") != k.articles, F.concat_ws(":", "name", "n"))),
    ]
    a = articles_of(e, k)
    for name in ("id", "link", "title"):
        same = a.select("edition", F.col(f"a.{name}").alias("v")).filter(~_blank(F.col("v"))).groupBy("edition", "v").count()
        out.append(_told(same, (f"duplicate_{name}", F.col("count") > 1, F.col("v"))))
    x, strict = F.col("a"), F.col("strict")
    short = lambda c: F.length(F.coalesce(F.trim(c), F.lit(""))) < 10
    title, image = x["title"], x["image"]
    provenance, null = image["status"] == "VERIFIED_PROVENANCE", image["status"] == "EXPLICIT_NULL"
    research = [(f"research_{f}", F.col("is_research") & _blank(x["research"][f]), title) for f in ("evidence_type", "study_design", "clinical_meaning", "limitations", "exact_source_url")]
    out.append(_told(
        a, *[(f"missing_{n}", _blank(x[n]), title) for n in ("id", "link", "title")], ("relay_url", _of_host(x["link"], k.relay), x["link"]), ("fact_incomplete", short(x["editorial"]["fact"]), title), ("background_incomplete", short(x["editorial"]["background"]), title),
        ("why_incomplete", short(x["editorial"]["why_it_matters"]), title), ("checkpoints_incomplete", F.coalesce(F.size(x["editorial"]["checkpoints"]), F.lit(0)) < 2, title), ("fact_check_missing", x["fact_check"].isNull(), title),
        ("fact_check_status", x["fact_check"].isNotNull() & ~F.coalesce(x["fact_check"]["status"].isin(*k.statuses), F.lit(False)), F.concat_ws(":", x["fact_check"]["status"], title)),
        ("body_status", strict & x["fact_check"].isNotNull() & ~F.coalesce(x["fact_check"]["body_status"].isin(*k.bodies), F.lit(False)), F.concat_ws(":", x["fact_check"]["body_status"], title)), ("image_missing", image.isNull(), title),
        ("image_status", image.isNotNull() & ~F.coalesce(provenance | null, F.lit(False)), F.concat_ws(":", image["status"], title)), ("image_null_with_url", null & image["url"].isNotNull(), title), ("image_without_url", provenance & _blank(image["url"]), title),
        ("image_without_hash", strict & provenance & ~_blank(image["url"]) & _blank(image["content_hash"]), title), ("image_without_method", strict & provenance & _blank(image["declaration_method"]), title),
        ("image_without_domains", strict & provenance & (_blank(image["source_domain"]) | _blank(image["article_domain"])), title), *research,
    ))
    hashes = a.filter(strict & provenance & ~_blank(image["content_hash"])).groupBy("edition", image["content_hash"].alias("v")).count()
    out.append(_told(hashes, ("duplicate_image_hash", F.col("count") > 1, F.col("v"))))
    hosts = a.filter("is_research").groupBy("edition").agg(F.count_distinct(urls.domain(F.coalesce(F.nullif(x["research"]["exact_source_url"], F.lit("")), x["link"]))).alias("n"))
    out.append(_told(hosts, ("research_domains", F.col("n") < k.research_domains, F.col("n"))))
    top = e.select("edition", (F.col("version") == k.strict).alias("strict"), F.col("top5").alias("t"), F.size("top5").alias("n"), F.size(F.array_distinct(F.transform("top5", lambda t: F.coalesce(t.id, F.lit(""))))).alias("ids"), F.size(F.array_distinct(F.transform("top5", lambda t: t.chapter_id))).alias("of"))
    has = lambda test: F.exists("t", test)
    out.append(_told(
        top, ("top5_count", F.coalesce(F.col("n"), F.lit(0)) != k.top5, F.col("n")), ("top5_ids", (F.col("ids") != F.col("n")) | has(lambda t: _blank(t.id)), None), ("top5_relay", has(lambda t: _of_host(t.link, k.relay)), None), ("top5_opinion", has(lambda t: F.lower(t.title).rlike(k.opinion)), None),
        ("top5_chapters", F.col("strict") & (F.col("n") == k.top5) & (F.col("of") != k.top5), F.col("of")),
    ))
    general = a.filter("NOT is_research")
    for name in ("id", "link"):
        missing = e.select("edition", F.explode("top5").alias("t")).select("edition", F.col(f"t.{name}").alias("v")).join(general.select("edition", x[name].alias("v")).distinct(), ["edition", "v"], "left_anti")
        out.append(_told(missing, (f"top5_foreign_{name}", F.lit(True), F.col("v"))))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    w, n = F.col("weather"), F.size("trends")
    with_research = F.exists("chapters", lambda c: c.id == k.research)
    out.append(_told(
        e, ("weather", ~F.coalesce(w["location"].contains(k.place) & w["temp_current"].isNotNull(), F.lit(False)), None), ("weather_source", with_research & _blank(w["source"]), None),
        ("market", reduce(lambda b, m: b | F.col("market")[m].isNull(), k.market, F.col("market").isNull()), None), ("signals", size("next_signals") < k.signals, size("next_signals")), ("trends_count", ~F.coalesce(n, F.lit(0)).isin(*k.trends), n),
        ("trends_withheld", (F.coalesce(n, F.lit(0)) == k.trends[0]) & ~F.col("trends_source").eqNullSafe(F.lit(k.trends_withheld)), None), ("trends_source", (n == k.trends[1]) & ~F.col("trends_source").eqNullSafe(F.lit(k.trends_source)), None),
        ("summary_lines", size("lines") != k.lines, size("lines")), ("videos", size("videos") < k.videos, size("videos")), ("video_channels", size(F.array_distinct(F.filter(F.transform("videos", lambda v: v.channel), lambda c: ~_blank(c)))) < k.channels, None),
        ("integrity_hash", F.length(F.coalesce("integrity_hash", F.lit(""))) < 32, None),
    ))
    return reduce(DataFrame.unionByName, out)


def bundle_faults(editions: DataFrame, stories: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """The rules on story bundles: their number and size, unique addresses, the same addresses as the edition's, whole and no relays, a note of freshness."""
    k = contract
    sizes = stories.groupBy("edition", "bundle").count()
    out = [_told(sizes, ("bundle_size", F.col("count") != k.bundle_size, F.concat_ws(":", "bundle", "count")))]
    many = editions.select("edition").join(sizes.groupBy("edition").agg(F.count(F.lit(1)).alias("n")), "edition", "left").na.fill(0)
    out.append(_told(many, ("bundles", F.col("n") != k.bundles, F.col("n"))))
    own = articles_of(editions, k).filter("NOT is_research").select("edition", F.col("a.link").alias("url"))
    for name, rows in (("story", stories.select("edition", "url")), ("article", own)):
        out.append(_told(rows.groupBy("edition", "url").count(), (f"duplicate_{name}_url", F.col("count") > 1, F.col("url"))))
    out.append(_told(stories.select("edition", "url").distinct().join(own, ["edition", "url"], "left_anti"), ("story_without_article", F.lit(True), F.col("url"))))
    out.append(_told(own.distinct().join(stories.select("edition", "url"), ["edition", "url"], "left_anti"), ("article_without_story", F.lit(True), F.col("url"))))
    out.append(_told(stories, ("story_url", ~urls.is_http(F.col("url")), F.col("url")), ("story_relay", _of_host(F.col("url"), k.relay), F.col("url")), ("freshness_note", _blank(F.col("freshness_note")), F.col("title"))))
    return reduce(DataFrame.unionByName, out)


def production_fingerprint(editions: DataFrame) -> DataFrame:
    """edition, fingerprint: sha-256 of the edition as JSON, fields in the order of their names, without its manifest's fingerprint."""
    fields = [F.col(c) for c in sorted(editions.columns) if c != "manifest_fingerprint"]
    return editions.select("edition", F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256).alias("fingerprint"))


def manifest_fingerprint(manifests: DataFrame) -> DataFrame:
    """edition, fingerprint: of the manifest without its own; maps in the order of their keys."""
    counts = F.to_json(F.array_sort(F.map_entries("counts")))
    fields = [counts.alias(c) if c == "counts" else F.col(c) for c in sorted(manifests.columns) if c != "manifest_sha256"]
    return manifests.select("edition", F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256).alias("fingerprint"))


def manifest_faults(editions: DataFrame, manifests: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """The rules on manifests: fingerprints recomputed, date, zone, revision and counts."""
    k, m = contract, manifests
    met = m.join(production_fingerprint(editions).withColumnRenamed("fingerprint", "__made"), "edition", "left").join(manifest_fingerprint(m).withColumnRenamed("fingerprint", "__own"), "edition")
    met = met.join(editions.select("edition", "date", F.col("manifest_fingerprint").alias("__said"), "story_files"), "edition", "left")
    n = lambda name: F.col("counts")[name]
    research = n("vision_research_watch").isNotNull()
    more = F.when(research, 1).otherwise(0)
    wrong = lambda name, wanted: (f"count_{name}", ~n(name).eqNullSafe(wanted), n(name))
    files = F.array(*[F.lit(f"stories-{i}.json") for i in range(1, k.bundles + 1)])
    return _told(
        met, ("edition_date", ~F.col("edition_date").eqNullSafe(F.col("date")), F.col("edition_date")), ("timezone", ~F.col("timezone").eqNullSafe(F.lit(k.timezone)), F.col("timezone")), ("source_sha", F.length(F.coalesce("source_sha", F.lit(""))) != 40, F.col("source_sha")),
        ("canonical_status", ~F.col("canonical_status").eqNullSafe(F.lit("CANONICAL_PASS")), F.col("canonical_status")), ("production_fingerprint", ~F.col("production_fingerprint").eqNullSafe(F.col("__made")), None), ("manifest_fingerprint", ~F.col("manifest_sha256").eqNullSafe(F.col("__own")), None),
        ("edition_names_manifest", ~F.col("__said").eqNullSafe(F.col("manifest_sha256")), None), wrong("total_chapters", F.lit(k.chapters) + more), wrong("total_articles", (F.lit(k.chapters) + more) * k.articles), wrong("top5", F.lit(k.top5)), wrong("summary_lines", F.lit(k.lines)),
        ("count_research", research & ~n("vision_research_watch").eqNullSafe(F.lit(k.articles)), n("vision_research_watch")), ("count_videos", F.coalesce(n("youtube"), F.lit(0)) < k.videos, n("youtube")), ("count_trends", ~F.coalesce(n("trends").isin(*k.trends), F.lit(False)), n("trends")),
        ("count_bundles", n("story_bundles").isNotNull() & (n("story_bundles") != k.bundles), n("story_bundles")), ("story_files", n("story_bundles").isNotNull() & ~F.col("story_files").eqNullSafe(files), None),
    )


_TEXTS = "array<struct<path:string,text:string>>"


def texts_of(column: Column, kind: DataType, path: str) -> Column | None:
    """(path, text) of every text within a nested column, as one array: fields of structs, elements of arrays, values of maps. None if it can hold none."""
    if isinstance(kind, StringType):
        return F.array(F.struct(F.lit(path).alias("path"), column.alias("text")))
    if isinstance(kind, StructType):
        found = [x for f in kind.fields if (x := texts_of(column[f.name], f.dataType, f"{path}.{f.name}")) is not None]
        return F.concat(*found) if found else None
    if isinstance(kind, MapType):
        return texts_of(F.map_values(column), ArrayType(kind.valueType), path)
    if isinstance(kind, ArrayType) and texts_of(F.lit(None).cast(kind.elementType), kind.elementType, path) is not None:
        return F.coalesce(F.flatten(F.transform(column, lambda e: texts_of(e, kind.elementType, f"{path}[]"))), F.array().cast(_TEXTS))
    return None


def leaf_faults(documents: DataFrame, pattern: str = PLACEHOLDER) -> DataFrame:
    """The texts anywhere in nested documents (with ``edition``) that have a placeholder: rule is its path, detail its beginning."""
    found = [x for f in documents.schema.fields if (x := texts_of(F.col(f"`{f.name}`"), f.dataType, f".{f.name}")) is not None]
    x = documents.select("edition", F.explode(F.concat(*found)).alias("x")).filter(F.col("x.text").rlike(pattern))
    return x.select("edition", F.concat(F.lit("placeholder"), F.col("x.path")).alias("rule"), F.substring("x.text", 1, 80).alias("detail"))


def contract_faults(editions: DataFrame, stories: DataFrame, manifests: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """The release contract: the rules on editions, bundles and manifests together, whole addresses of articles and videos, weather in full, and no placeholder anywhere."""
    a = articles_of(editions, contract)
    links = _told(a, ("article_url", ~urls.is_http(F.col("a.link")), F.col("a.title")))
    videos = _told(editions.select("edition", F.explode("videos").alias("v")), ("video_url", ~urls.is_http(F.col("v.url")), F.col("v.channel")))
    w = F.col("weather")
    weather = _told(editions, *[(f"weather_{f}", w[f].isNull() | (w[f].cast("string") == ""), None) for f in ("location", "temp_current", "temp_min", "temp_max", "condition", "precipitation_prob")])
    parts = [edition_faults(editions, contract), bundle_faults(editions, stories, contract), manifest_faults(editions, manifests, contract), links, videos, weather, leaf_faults(editions)]
    return reduce(DataFrame.unionByName, parts)


def registry_faults(sources: DataFrame, tiers: dict[int, int], access: dict[str, int], critical: list[str], modes: tuple[str, ...] = ("api", "rss", "web")) -> DataFrame:
    """The rules on a registry of sources: required fields, tiers, ways of access, domains of one owner, unique ids, least numbers by tier and access, critical ids."""
    s = sources.withColumnRenamed("registry", "edition")
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) < 1
    out = [_told(s, ("missing_id", _blank(F.col("id")), F.col("name")), ("missing_name", _blank(F.col("name")), F.col("id")), ("tier", ~F.coalesce(F.col("tier").between(0, 4), F.lit(False)), F.col("id")), *[(f"missing_{c}", none(c), F.col("id")) for c in ("domains", "access", "roles", "topics")], ("access_mode", F.exists("access", lambda m: ~m.isin(*modes)), F.col("id")), ("domain", F.exists("domains", lambda d: ~d.contains(".")), F.col("id")))]
    out.append(_told(s.groupBy("edition", "id").count(), ("duplicate_id", F.col("count") > 1, F.col("id"))))
    owners = s.select("edition", "id", F.explode("domains").alias("d")).groupBy("edition", F.regexp_replace(F.lower("d"), r"^www\.", "").alias("d")).agg(F.count_distinct("id").alias("n"))
    out.append(_told(owners, ("domain_owned_twice", F.col("n") > 1, F.col("d"))))
    registries = s.select("edition").distinct()
    spark = sources.sparkSession
    for name, least, had in (("tier", tiers, s.select("edition", F.col("tier").cast("string").alias("v"))), ("access", access, s.select("edition", F.explode("access").alias("v")))):
        wanted = F.broadcast(spark.createDataFrame([(str(v), n) for v, n in least.items()], "v string, least int"))
        counted = registries.join(wanted, F.lit(True)).join(had.groupBy("edition", "v").count(), ["edition", "v"], "left")
        out.append(_told(counted, (f"few_of_{name}", F.coalesce("count", F.lit(0)) < F.col("least"), F.col("v"))))
    ids = F.broadcast(spark.createDataFrame([(c,) for c in critical], "id string"))
    out.append(_told(registries.join(ids, F.lit(True)).join(s.select("edition", "id"), ["edition", "id"], "left_anti"), ("missing_critical", F.lit(True), F.col("id"))))
    return reduce(DataFrame.unionByName, out)
