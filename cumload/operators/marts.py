"""Published totals: measures with their NULL rules, and the six aggregate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumload.plans.domain import LINE


def measured(projects: DataFrame) -> DataFrame:
    """Measures of projects: lines have no MW, and a missing nominal figure falls back to the peak (F1)."""
    counted = F.col("technology") != LINE
    best = F.when(counted, F.coalesce("mw_nominal", "mw_peak"))
    return projects.withColumns({"mw_best": best, "mw": F.when(counted, F.col("mw_nominal")), "peak_fallback": counted & F.col("mw_nominal").isNull() & F.col("mw_peak").isNotNull()})


def figures() -> list[Column]:
    """The additive measures of a cell: sums are 0 where nothing is declared, counts tell the two apart."""
    total = lambda c: F.round(F.coalesce(F.sum(c), F.lit(0.0)), 4)
    return [F.count("*").alias("project_count"), total("mw").alias("mw_nominal"), F.count("mw").alias("mw_count"), total("hectares").alias("hectares"), F.count("hectares").alias("ha_count"), total("mw_best").alias("mw_best"), F.count_if("peak_fallback").alias("mw_peak_fallback_count")]


def area_stats(projects: DataFrame, bridge: DataFrame) -> DataFrame:
    """A project counts in full in each of its places (A1)."""
    return measured(projects).join(bridge, "id").groupBy("nation", "status", "technology").agg(*figures())


def site_stats(projects: DataFrame, bridge: DataFrame, places: DataFrame) -> DataFrame:
    """A project counts once in a site, however many of its places lie there (A3): distinct before sum."""
    pairs = bridge.join(places, "nation").select("id", "province").distinct()
    return measured(projects).join(pairs, "id").groupBy("province", "status", "technology").agg(*figures())


def scope_stats(projects: DataFrame, bridge: DataFrame, places: DataFrame) -> DataFrame:
    """Provinces, and the whole region with each project once, also those without a place (A5). The region is not the sum of the provinces."""
    whole = measured(projects).groupBy("status", "technology").agg(*figures()).withColumn("scope", F.lit("ALL"))
    return site_stats(projects, bridge, places).withColumnRenamed("province", "scope").unionByName(whole)


def status_documents(documents: DataFrame) -> DataFrame:
    """id, published of the document that gives a project its status: the last that decides, else the last."""
    return documents.groupBy("id").agg(F.coalesce(F.max(F.when(F.col("role") != "N", F.col("published"))), F.max("published")).alias("published"))


def month_stats(projects: DataFrame, bridge: DataFrame, places: DataFrame, status_docs: DataFrame) -> DataFrame:
    """Projects by province, month of their status document, and status (A4). ``status_docs``: id, published."""
    latest = status_docs.select("id", F.trunc("published", "MM").alias("month"))
    pairs = bridge.join(places, "nation").select("id", "province").distinct()
    return measured(projects).join(latest, "id").join(pairs, "id").groupBy("province", "month", "status").agg(*figures())


def monthly_events(documents: DataFrame, projects: DataFrame, bridge: DataFrame, places: DataFrame) -> DataFrame:
    """Documents by month, scope, technology and event: each once in a province and once in the region.

    ``documents`` have a row per document and project. A document of two projects counts once per technology: documents
    are named by a hash of their key, and the region's rows need neither the bridge nor the wide key.
    """
    event = F.when((F.col("role") == "R") & (F.col("verdict") == "F"), "refused").when(F.col("role") == "A", "approved").when(F.col("role") == "N", "opened").otherwise("other")
    key = F.struct("id", "part", "supplier", "line", "published", "amount")
    dated = documents.select("id", F.xxhash64(key).alias("document"), F.trunc("published", "MM").alias("month"), event.alias("event")).join(projects.select("id", "technology"), "id")
    sites = bridge.join(places, "nation").groupBy("id").agg(F.collect_set("province").alias("scopes"))
    scopes = F.explode(F.concat(F.array(F.lit("ALL")), F.coalesce("scopes", F.array().cast("array<string>"))))
    each = dated.join(sites, "id", "left").select(scopes.alias("scope"), "month", "technology", "event", "document")
    return each.distinct().groupBy("scope", "month", "technology", "event").agg(F.count("*").alias("document_count"))


def resummed(cells: DataFrame, by: list[str], statuses: list[str], technologies: list[str]) -> DataFrame:
    """Filter cells by status and technology and add them up again (F8, A12, A14): figures are additive."""
    some = cells.where(F.col("status").isin(statuses) & F.col("technology").isin(technologies))
    return some.groupBy(*by).agg(F.sum("project_count").alias("projects"), F.round(F.sum("mw_best"), 4).alias("mw"), F.sum(F.col("mw_count") + F.col("mw_peak_fallback_count")).alias("declared"), F.sum("mw_peak_fallback_count").alias("peak"))


def headline(projects: DataFrame, bridge: DataFrame, places: DataFrame, leaders: int = 2) -> DataFrame:
    """MW in three status groups by province, leading provinces first."""
    pairs = bridge.join(places, "nation").select("id", "province").distinct()
    part = lambda s: F.round(F.coalesce(F.sum(F.when(F.col("status") == s, F.col("mw_best"))), F.lit(0.0)), 4)
    sums = measured(projects).join(pairs, "id").groupBy("province").agg(part("O").alias("open_mw"), part("P").alias("pending_mw"), part("F").alias("final_mw"))
    return sums.orderBy(F.desc("open_mw"), "province").limit(leaders)


def outcomes(projects: DataFrame, by: str, least: int = 10) -> DataFrame:
    """Refused, decided, and their rate where at least ``least`` are decided."""
    counts = projects.groupBy(by).agg(F.count_if(F.col("status") == "P").alias("refused"), F.count_if(F.col("status").isin("P", "F")).alias("decided"))
    return counts.where("decided > 0").withColumn("rate", F.when(F.col("decided") >= least, F.round(F.col("refused") / F.col("decided"), 6)))


def outcome_table(projects: DataFrame, bridge: DataFrame, places: DataFrame, days: DataFrame, least: int = 10) -> DataFrame:
    """Outcomes and median days by province and technology, and of the region.

    A project counts in each of its provinces and once in the region; rows without a decision are left out. ``days``: id, days.
    """
    sites = bridge.join(places, "nation").groupBy("id").agg(F.collect_set("province").alias("provinces"))
    scope = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("scope"))
    own = F.coalesce(F.transform("provinces", lambda p: scope("province", p)), F.array().cast("array<struct<kind:string,scope:string>>"))
    rows = projects.join(sites, "id", "left").join(days, "id", "left").select("status", "days", F.inline(F.concat(F.array(scope("region", F.lit("ALL")), scope("technology", F.col("technology"))), own)))
    keyed = rows.withColumn("_k", F.struct("kind", "scope"))
    return outcomes(keyed, "_k", least).join(sampled_median(keyed.where("days IS NOT NULL"), "_k", least), "_k", "left").select("_k.kind", "_k.scope", "refused", "decided", "rate", F.coalesce("cases", F.lit(0)).cast("long").alias("cases"), "median_days")


def days_to_decision(documents: DataFrame) -> DataFrame:
    """Days from a project's first opening to its first later decision."""
    first = documents.groupBy("id").agg(F.min(F.when(F.col("role") == "N", F.col("published"))).alias("opened"))
    later = documents.join(first, "id").where((F.col("role") != "N") & (F.col("published") > F.col("opened")))
    return later.groupBy("id", "opened").agg(F.min("published").alias("decided")).select("id", F.date_diff("decided", "opened").cast("long").alias("days"))


def sampled_median(days: DataFrame, by: str, least: int = 10) -> DataFrame:
    """Exact median, kept back below ``least`` cases (A17): from the counts of distinct values, which a hot key has no more of than others."""
    values = days.where("days IS NOT NULL").groupBy(by, "days").agg(F.count("*").alias("n"))
    order = Window.partitionBy(by).orderBy("days").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = values.withColumn("upto", F.sum("n").over(order)).withColumn("cases", F.sum("n").over(Window.partitionBy(by)))
    # the two middle cases: the first values that reach them
    low, high = F.floor((F.col("cases") + 1) / 2), F.floor(F.col("cases") / 2) + 1
    picks = upto.groupBy(by, "cases").agg(F.min(F.when(F.col("upto") >= low, F.col("days"))).alias("a"), F.min(F.when(F.col("upto") >= high, F.col("days"))).alias("b"))
    return picks.select(by, "cases", F.when(F.col("cases") >= least, (F.col("a") + F.col("b")) / 2).alias("median_days"))


def dense_months(counts: DataFrame, start: str, end: str) -> DataFrame:
    """(event, month, n) with a row for every month from start to end (A19). ``counts``: event, month, n."""
    months = counts.select("event").distinct().withColumn("month", F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 MONTH"))))
    sums = counts.groupBy("event", "month").agg(F.sum("n").alias("n"))
    return months.join(sums, ["event", "month"], "left").select("event", "month", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def row_peaks(counts: DataFrame) -> DataFrame:
    """Highest month of each event, the earliest of equals."""
    return counts.groupBy("event").agg(F.max("n").alias("peak"), F.max_by("month", F.struct(F.col("n"), -F.unix_date("month"))).alias("month"))


def year_totals(counts: DataFrame) -> DataFrame:
    """Documents by event and year (A20). ``counts``: event, month, n."""
    return counts.groupBy("event", F.year("month").cast("long").alias("year")).agg(F.sum("n").cast("long").alias("n"))


def before_series(documents: DataFrame, start: str) -> DataFrame:
    """Documents before a series starts, and their first year."""
    return documents.where(F.col("published") < F.to_date(F.lit(start))).agg(F.count("*").alias("n"), F.min(F.year("published")).cast("long").alias("first_year"))


def shared_signatures(cells: DataFrame, figures: list[str]) -> DataFrame:
    """Areas with the same set of cells, figures included, and how many others there are (A22). Areas without a twin are left out. ``cells``: area, status, technology, figures."""
    signature = F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("status", "technology", *figures)))), 256)
    of = cells.groupBy("area").agg(signature.alias("signature"))
    sizes = of.groupBy("signature").agg((F.count("*") - 1).alias("others")).where("others > 0")
    return of.join(sizes, "signature").select("area", "others")


def running_totals(projects: DataFrame, bridge: DataFrame) -> DataFrame:
    """Running MW and count of each place's projects by (first_seen, id); lines add nothing.

    In two levels: the sums of each place's months (a few rows) give where a month starts, and only one month's projects
    of a place meet in a window.
    """
    rows = measured(projects).join(bridge, "id").select("nation", "id", "first_seen", F.trunc("first_seen", "MM").alias("month"), F.coalesce("mw_best", F.lit(0.0)).alias("mw"))
    before = Window.partitionBy("nation").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("nation", "month").agg(F.sum("mw").alias("mw"), F.count("*").alias("n")).select(F.col("nation").alias("_nation"), F.col("month").alias("_month"), F.coalesce(F.sum("mw").over(before), F.lit(0.0)).alias("mw_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))
    within = Window.partitionBy("nation", "month").orderBy("first_seen", "id")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.withColumn("own_mw", F.sum("mw").over(upto)).withColumn("own_n", F.row_number().over(within))
    return own.join(starts, F.col("nation").eqNullSafe(F.col("_nation")) & F.col("month").eqNullSafe(F.col("_month"))).select("nation", "id", F.round(F.col("mw_before") + F.col("own_mw"), 4).alias("running_mw"), (F.col("n_before") + F.col("own_n")).cast("long").alias("running_count"))


def quantile_classes(values: DataFrame, classes: int = 5, decimals: int = 0) -> DataFrame:
    """Class of each area's value: thresholds are the sorted positives at floor(n k / classes), strictly rising, below the maximum.

    ``values``: area, value (null: no figure, class -1), and where it is known ``projects``, of which an area without any
    has class 0 and one with some, but no value above 0, -1; without that column a value of 0 has class 0. Thresholds come from the counts of the displayed values: the
    window sees distinct values in ranges, whose sums are one row each.
    """
    rounded = values.withColumn("value", F.round("value", decimals))
    shown = rounded.where("value > 0").groupBy("value").agg(F.count("*").alias("n")).withColumn("range", F.floor(F.log2("value") * 16))
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = shown.groupBy("range").agg(F.sum("n").alias("m"), F.max("value").alias("top")).select(F.col("range").alias("_range"), F.coalesce(F.sum("m").over(whole), F.lit(0)).alias("before"), F.sum("m").over(Window.partitionBy()).alias("total"), F.max("top").over(Window.partitionBy()).alias("most"))
    within = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = shown.withColumn("upto", F.sum("n").over(within)).join(ranges, F.col("range") == F.col("_range")).select("value", (F.col("before") + F.col("upto") - F.col("n")).alias("low"), (F.col("before") + F.col("upto")).alias("high"), "total", "most")
    picks = F.array(*[F.floor(F.col("total") * k / classes) for k in range(1, classes)])
    limits = placed.where(F.exists(picks, lambda i: (i >= F.col("low")) & (i < F.col("high"))) & (F.col("value") < F.col("most"))).agg(F.array_sort(F.collect_set("value")).alias("limits"))
    none = F.when(F.col("projects") <= 0, 0).when(F.coalesce("value", F.lit(0.0)) <= 0, -1) if "projects" in values.columns else F.when(F.col("value").isNull(), -1).when(F.col("value") <= 0, 0)
    # one row of at most classes - 1 limits
    return rounded.crossJoin(F.broadcast(limits)).select("area", "value", none.otherwise(1 + F.size(F.filter("limits", lambda t: t < F.col("value")))).cast("long").alias("class"))
