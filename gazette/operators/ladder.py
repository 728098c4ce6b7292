"""Reject rules as tables: a ladder of rules, read and checked, and evaluated in one pass; the first that holds gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gazette.functions import checks, lineage, text, urls

#: A rule: its place in the ladder, the reason it gives, the chapter and tiers that it is for (null: all), and tests that all have to hold.
#: A test looks in a field for terms, ``how``: as whole words of the normalised text, within the lower-case text, at its
#: start, as segments of an address's path, or (years_before) for a year that is so many years before the latest one of
#: the field ``published``. Without ``present`` it holds if none is there.
RULES = "place int, reason string, chapter string, least_tier int, most_tier int, tests array<struct<field:string,how:string,terms:array<string>,present:boolean>>"
HOWS = ("words", "contains", "starts", "segments", "years_before")


def checked(rules: DataFrame) -> list[Row]:
    """The rules by place. A rule without place, reason or tests, or with a test that cannot be read, stops the query and is named.

    A policy has some dozen rules; they are read on the driver and become one expression.
    """
    test = lambda t: t.field.isNotNull() & t.how.isin(*HOWS) & (F.size(t.terms) > 0)
    whole = F.col("place").isNotNull() & F.col("reason").isNotNull() & (F.size("tests") > 0) & F.forall("tests", test)
    return checks.must(rules, whole, F.concat(F.lit("not a rule: "), F.to_json(F.struct(*rules.columns)))).orderBy("place", "reason", "chapter").collect()


def read(spark: SparkSession, path: str) -> list[Row]:
    """The rules of JSON files (arrays of rules, or one to a line). Broken input stops the query."""
    return checked(spark.read.schema(RULES).option("mode", "FAILFAST").option("multiLine", True).json(path))


def parse(spark: SparkSession, written: str) -> list[Row]:
    """The rules of a JSON text, as :func:`read`."""
    one = spark.createDataFrame([(written,)], "j string").select(F.explode(F.from_json("j", f"array<struct<{_kind()}>>", {"mode": "FAILFAST"})).alias("r"))
    return checked(one.select("r.*"))


def _kind() -> str:
    head, tests = RULES.split(", tests ")
    return ",".join(x.replace(" ", ":", 1) for x in head.split(", ")) + ",tests:" + tests


def reasons(df: DataFrame, rules: list[Row], fields: dict[str, Column], chapter: str = "chapter", tier: str | None = None, name: str = "reason", normal: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the reason of the first rule that holds, null where none does.

    ``fields`` are the texts that tests name; each is normalised once before the rules look at it, also where a filter asks for the reason; those in ``normal`` are already. A null
    text has no terms. A rule for a chapter holds for no other, and a rule for tiers for no row without one.
    """
    used = {(t.field, t.how) for r in rules for t in r.tests}
    unknown = {f for f, _ in used} - set(fields)
    if unknown:
        raise ValueError(f"rules name fields that are not given: {sorted(unknown)}")
    made = {}
    for field, how in sorted(used):
        low = F.coalesce(fields[field], F.lit("")) if field in normal else F.lower(F.coalesce(fields[field], F.lit("")))
        form = {
            "words": lambda c, done=field in normal: F.concat(F.lit(" "), c if done else text.norm_title(c), F.lit(" ")), "segments": lambda c: F.filter(F.split(F.lower(urls.path(c)), "/"), lambda s: s != ""),
            "years_before": lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"(?<![0-9A-Za-z_])((?:19|20)[0-9]{2})(?![0-9A-Za-z_])"), F.lit(1)), lambda y: y.cast("int")),
        }.get(how, lambda c: c)
        made[f"__{how}_{field}"] = form(low)
    if any(how == "years_before" for _, how in used):
        made["__published"] = F.array_max(F.transform(F.regexp_extract_all(F.coalesce(fields["published"], F.lit("")), F.lit(r"(?<![0-9A-Za-z_])((?:19|20)[0-9]{2})(?![0-9A-Za-z_])"), F.lit(1)), lambda y: y.cast("int")))
    ready = lineage.once(df, made)

    def holds(t: Row) -> Column:
        seen = F.col(f"__{t.how}_{t.field}")
        if t.how == "years_before":
            found = F.coalesce(F.array_min(seen) <= F.col("__published") - int(t.terms[0]), F.lit(False))
        elif t.how == "segments":
            found = F.arrays_overlap(seen, F.array(*[F.lit(x.lower()) for x in t.terms]))
        else:
            found = F.lit(False)
            for term in t.terms:
                if t.how == "words":
                    norm = F.concat(F.lit(" "), text.norm_title(F.lit(term)), F.lit(" "))
                    found = found | ((F.length(norm) > 2) & F.contains(seen, norm))
                else:
                    found = found | (F.startswith(seen, F.lit(term.lower())) if t.how == "starts" else F.contains(seen, F.lit(term.lower())))
        found = F.coalesce(found, F.lit(False))
        return found if t.present is None or t.present else ~found

    first = None
    for r in rules:
        cond = F.lit(True) if r.chapter is None else F.coalesce(F.col(chapter) == r.chapter, F.lit(False))
        for bound, over in ((r.least_tier, True), (r.most_tier, False)):
            if bound is not None:
                of = F.col(tier) if tier else F.lit(None).cast("int")
                cond = cond & F.coalesce(of >= bound if over else of <= bound, F.lit(False))
        for t in r.tests:
            cond = cond & holds(t)
        first = F.when(cond, r.reason) if first is None else first.when(cond, r.reason)
    return ready.withColumn(name, first if first is not None else F.lit(None).cast("string")).drop(*made)


def rejected(df: DataFrame, rules: list[Row], fields: dict[str, Column], most_age: Column, age: str = "age", url: str = "url", chapter: str = "chapter", tier: str | None = "tier", normal: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with reason: that of the first rule, else of the date (missing_date, future_date beyond a day, stale), else of the address."""
    told = reasons(df, rules, fields, chapter, tier, "__rule", normal)
    a = F.col(age)
    late = F.when(a.isNull(), "missing_date").when(a < -1, "future_date").when(a > most_age, "stale")
    return told.withColumn("reason", F.coalesce("__rule", late, urls.reject_reason(F.col(url)))).drop("__rule")


def report(df: DataFrame, chapter: str = "chapter") -> DataFrame:
    """chapter, kept, rejected, reasons: how many rows of each chapter stay, and how often each reason was given, as a map in the order of names."""
    by = df.groupBy(chapter, "reason").agg(F.count(F.lit(1)).alias("n"))
    entries = F.sort_array(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("reason", "n"))))
    return by.groupBy(chapter).agg(
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("kept"), F.coalesce(F.sum(F.when(F.col("reason").isNotNull(), F.col("n"))), F.lit(0)).alias("rejected"), F.map_from_entries(entries).alias("reasons"),
    )
