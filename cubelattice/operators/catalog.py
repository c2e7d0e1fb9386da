"""Catalog, dimension and discovery queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.functions.expr import ancestor_paths, is_descendant, normalize_label, overlap_years, path_depth, pick_locale
from cubelattice.operators import filters as flt
from cubelattice.sources.warehouse import NotFoundError, Warehouse


def name(locale: str):
    return pick_locale(F.col("name_ro"), F.col("name_en"), locale).alias("name")


# contexts


def contexts(wh: Warehouse, locale: str = "ro", level: int | None = None, parent_id: int | None = None, path_prefix: str | None = None) -> DataFrame:
    rows = wh.contexts
    for given, keep in ((level, F.col("level") == level), (parent_id, F.col("parent_id") == parent_id), (path_prefix, flt.text_prefix(F.col("path"), path_prefix or ""))):
        rows = rows if given is None else rows.filter(keep)
    return rows.select("code", name(locale), "level", "path", "children_type")


def contexts_page(wh: Warehouse, limit: int, after: tuple[str, int] | None = None) -> DataFrame:
    """The next contexts by Romanian name, then number; one more than asked for."""
    rows = wh.contexts if after is None else wh.contexts.filter(flt.after([(F.col("name_ro"), after[0], True), (F.col("context_id"), after[1], True)]))
    return rows.orderBy("name_ro", "context_id").limit(limit + 1).select("context_id", "code", "name_ro", "path")


def contexts_tree(wh: Warehouse) -> DataFrame:
    """Contexts as an indented tree, numbered in order of their paths."""
    place = F.row_number().over(Window.orderBy(F.split("path", r"\.")))  # the catalog of contexts, a small table
    return wh.contexts.select(place.alias("place"), F.concat(F.repeat(F.lit("  "), F.col("level")), F.lit("["), "code", F.lit("] "), "name_ro").alias("line"))


def context_ancestors(wh: Warehouse, path: str) -> DataFrame:
    """All contexts above a path, in one join instead of a walk over parents."""
    paths = wh.contexts.filter(F.col("path") == path).select(F.explode(ancestor_paths(F.col("path"))).alias("path"))
    return wh.contexts.join(paths, "path").filter(F.col("path") != path).select("code", "name_ro", "level", "path")


def context_children(wh: Warehouse, context_id: int) -> DataFrame:
    """Child contexts and matrices of a context, told apart by kind."""
    below = wh.contexts.filter(F.col("parent_id") == context_id).select("code", "name_ro", F.lit("context").alias("kind"))
    own = wh.matrices.filter(F.col("context_id") == context_id).select(F.col("matrix_code").alias("code"), "name_ro", F.lit("matrix").alias("kind"))
    return below.unionByName(own)


# matrices


def matrices(wh: Warehouse, locale: str = "ro", search: str | None = None, context_path: str | None = None, periodicity: str | None = None, has_uat: bool | None = None, has_county: bool | None = None, status: str | None = None, context_id: int | None = None) -> DataFrame:
    """The catalog with each matrix's context."""
    rows = wh.matrices.join(wh.contexts.select("context_id", F.col("path").alias("context_path"), F.col("name_ro").alias("context_name")), "context_id", "left")
    conditions = [
        (search, lambda: flt.searched(F.col("name_ro"), F.col("name_en"), search, locale) | flt.contains(F.col("matrix_code"), search)),
        (context_path, lambda: flt.text_prefix(F.col("context_path"), context_path)),
        (periodicity, lambda: F.array_contains("periodicity", periodicity)),
        (has_uat, lambda: F.col("has_uat") == has_uat),
        (has_county, lambda: F.col("has_county") == has_county),
        (status, lambda: F.col("sync_status") == status),
        (context_id, lambda: F.col("context_id") == context_id),
    ]
    for given, condition in conditions:
        rows = rows if given is None else rows.filter(condition())
    return rows.select("matrix_code", name(locale), "context_name", "sync_status", F.array_join("periodicity", ",").alias("periodicities"), "year_from", "year_to", last_update().alias("last_update"))


def last_update():
    """The date of the last update, in either spelling, as text; null where it is no date."""
    return F.coalesce(F.try_to_timestamp("last_update", F.lit("dd-MM-yyyy")), F.try_to_timestamp("last_update", F.lit("yyyy-MM-dd"))).cast("date").cast("string")


def matrices_page(wh: Warehouse, limit: int, by: str = "name", descending: bool = False, after: tuple[str, int] | None = None, offset: int = 0) -> DataFrame:
    """The next matrices by name or lastUpdate, either way, then by number; one more than asked for. A matrix
    without the sort value comes last and is on no later page."""
    value = {"name": F.col("name_ro"), "lastUpdate": last_update()}[by]
    rows = wh.matrices.withColumn("sort_value", value)
    if after is not None:
        rows = rows.filter(flt.after([(F.col("sort_value"), after[0], not descending), (F.col("matrix_id"), after[1], True)]))
    order = F.desc_nulls_last("sort_value") if descending else F.asc_nulls_last("sort_value")
    return rows.orderBy(order, "matrix_id").offset(offset).limit(limit + 1).select("matrix_id", "matrix_code", "sort_value")


def matrix_detail(wh: Warehouse, code: str, locale: str = "ro") -> DataFrame:
    """One row: the matrix with its context, flags, years, facts and dimensions (place, type, label, options)."""
    wh.matrix_id(code)
    own = wh.matrices.filter(F.col("matrix_code") == code)
    above = wh.contexts.select("context_id", F.col("path").alias("context_path"), pick_locale(F.col("name_ro"), F.col("name_en"), locale).alias("context_name"))
    label = pick_locale(F.col("label_ro"), F.col("label_en"), locale)
    dims = wh.dimensions.groupBy("matrix_id").agg(F.sort_array(F.collect_list(F.struct("dim_index", "dimension_type", label.alias("label"), "option_count"))).alias("d"))
    facts = wh.facts(code).agg(F.count("*").alias("row_count"))
    shown = F.transform("d", lambda d: F.concat_ws(":", d["dim_index"].cast("string"), d["dimension_type"], d["label"], d["option_count"].cast("string")))
    rows = own.join(above, "context_id", "left").join(dims, "matrix_id", "left").crossJoin(F.broadcast(facts))  # one row each
    return rows.select(
        "matrix_id", "matrix_code", name(locale), "context_path", "context_name", F.array_join("periodicity", ",").alias("periodicities"), "has_uat", "has_county",
        F.coalesce(F.size("d"), F.lit(0)).alias("dimension_count"), "year_from", "year_to", last_update().alias("last_update"), "sync_status", "row_count",
        F.lit(0).alias("view_count"), F.lit(0).alias("download_count"), F.array_join(F.coalesce(shown, F.array().cast("array<string>")), "; ").alias("dimensions"),
    )


def domains(wh: Warehouse, status: str = "PENDING") -> DataFrame:
    """Matrices of a status per domain, the first three letters of their codes."""
    return wh.matrices.filter(F.col("sync_status") == status).groupBy(F.substring("matrix_code", 1, 3).alias("domain")).agg(F.count("*").alias("matrix_count"))


def dimension_labels(wh: Warehouse, kind: str = "TERRITORIAL") -> DataFrame:
    """How many dimensions of a kind bear each pair of labels."""
    return wh.dimensions.filter(F.col("dimension_type") == kind).groupBy("label_ro", "label_en").agg(F.count("*").alias("matrix_count"))


def search_dimensions(wh: Warehouse, text: str) -> DataFrame:
    """Matrices whose dimensions hold a text anywhere, names of fields included."""
    whole = wh.dimensions.groupBy("matrix_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("dim_index", "label_ro", "label_en", "dimension_type", "type_code")))).alias("body"))
    return wh.matrices.join(whole.filter(flt.contains(F.col("body"), text)), "matrix_id").select("matrix_code", "name_ro")


def find(wh: Warehouse, text: str) -> DataFrame:
    """Contexts and matrices whose code or name holds a text, any case."""
    hit = lambda code: flt.contains(F.col(code), text) | flt.contains(F.col("name_ro"), text)
    above = wh.contexts.filter(hit("code")).select(F.lit("context").alias("kind"), "code", "name_ro")
    return above.unionByName(wh.matrices.filter(hit("matrix_code")).select(F.lit("matrix").alias("kind"), F.col("matrix_code").alias("code"), "name_ro"))


def to_refresh(wh: Warehouse, now: str, stale_only: bool = False, older_than_days: int | None = None) -> DataFrame:
    """Matrices with facts whose last finished sync is old enough; synced and stale ones, or stale ones alone."""
    rows = wh.matrices.filter(F.col("sync_status").isin("STALE") if stale_only else F.col("sync_status").isin("SYNCED", "STALE"))
    synced = wh.tasks.filter("status = 'COMPLETED'").groupBy("matrix_id").agg(F.max("created_at").alias("last_sync_at"))
    rows = rows.join(wh.statistics.select("matrix_id").distinct(), "matrix_id", "left_semi").join(synced, "matrix_id", "left")
    if older_than_days is not None:
        rows = rows.filter(F.to_timestamp("last_sync_at") < F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(older_than_days)))
    return rows.select("matrix_code", "sync_status", "last_sync_at")


def dimensions(wh: Warehouse, code: str, locale: str = "ro") -> DataFrame:
    rows = wh.dimensions.join(wh.matrices.filter(F.col("matrix_code") == code).select("matrix_id"), "matrix_id")
    return rows.select("dim_index", pick_locale(F.col("label_ro"), F.col("label_en"), locale).alias("label"), "dimension_type", "type_code", "option_count")


def dimension_options(wh: Warehouse, code: str) -> DataFrame:
    """Every option of every dimension: the member that it stands for, whatever its kind."""
    own = wh.facts(code)
    dims = wh.dimensions.join(wh.matrices.filter(F.col("matrix_code") == code).select("matrix_id"), "matrix_id")
    used = {
        "TERRITORIAL": own.select("territory_id").distinct().join(wh.territories, "territory_id").select(F.lit("TERRITORIAL").alias("kind"), F.lit(None).cast("string").alias("t"), F.col("code").alias("option_code"), F.col("name").alias("option_name")),
        "TEMPORAL": own.select("time_period_id").distinct().join(wh.time_periods, "time_period_id").select(F.lit("TEMPORAL").alias("kind"), F.lit(None).cast("string").alias("t"), F.col("time_period_id").cast("string").alias("option_code"), F.col("label_ro").alias("option_name")),
        "UNIT_OF_MEASURE": own.select("unit_id").distinct().join(wh.units, "unit_id").select(F.lit("UNIT_OF_MEASURE").alias("kind"), F.lit(None).cast("string").alias("t"), F.col("code").alias("option_code"), F.col("name_ro").alias("option_name")),
        "CLASSIFICATION": own.select(F.explode("class_ids").alias("value_id")).distinct().join(wh.class_values, "value_id").select(F.lit("CLASSIFICATION").alias("kind"), F.col("type_code").alias("t"), F.col("code").alias("option_code"), F.col("name_ro").alias("option_name")),
    }
    options = reduce(DataFrame.unionByName, used.values())
    return dims.join(options, (dims["dimension_type"] == options["kind"]) & dims["type_code"].eqNullSafe(options["t"])).select("dim_index", "dimension_type", "option_code", "option_name")


def matrix_dimension(wh: Warehouse, code: str, dim_index: int) -> DataFrame:
    """The options of one dimension, with its label."""
    known = wh.dimensions.join(wh.matrices.filter(F.col("matrix_code") == code).select("matrix_id"), "matrix_id").filter(F.col("dim_index") == dim_index)
    if known.isEmpty():
        raise NotFoundError(f"no dimension {dim_index} of {code}")
    return dimension_options(wh, code).filter(F.col("dim_index") == dim_index).join(known.select("dim_index", "label_ro"), "dim_index").select("label_ro", "dimension_type", "option_code", "option_name")


def find_options(wh: Warehouse, code: str, text: str) -> DataFrame:
    """Options whose label holds a text, any case."""
    return dimension_options(wh, code).filter(flt.contains(F.col("option_name"), text))


def option_samples(wh: Warehouse, code: str, n: int = 5, last: bool = False) -> DataFrame:
    """The first (or last) options of each dimension, numbered from that end."""
    place = F.row_number().over(Window.partitionBy("dim_index").orderBy(F.desc("option_code") if last else F.asc("option_code")))
    return dimension_options(wh, code).withColumn("place", place).filter(F.col("place") <= n)


# territories and periods


def territories(wh: Warehouse, level: str | None = None, parent_id: int | None = None, path_prefix: str | None = None, search: str | None = None, siruta: str | None = None, label: str | None = None) -> DataFrame:
    """Territories by level, parent, start of the path, name, register number, or a label anywhere in the path."""
    rows = wh.territories
    for given, keep in (
        (level, F.col("level") == level),
        (parent_id, F.col("parent_id") == parent_id),
        (path_prefix, flt.text_prefix(F.col("path"), path_prefix or "")),
        (search, F.upper("name").contains((search or "").upper())),
        (siruta, F.col("siruta_code") == siruta),
        (label, F.array_contains(F.split("path", r"\."), label or "")),
    ):
        rows = rows if given is None else rows.filter(keep)
    return rows.select("code", "name", "level", "path")


def page_by_name(rows: DataFrame, limit: int, last: tuple[str, str] | None = None) -> DataFrame:
    if last is not None:
        rows = rows.filter(flt.after([(F.col("name"), last[0], True), (F.col("code"), last[1], True)]))
    return rows.orderBy("name", "code").limit(limit + 1)


def ancestors(wh: Warehouse, territory_id: int) -> DataFrame:
    paths = wh.territories.filter(F.col("territory_id") == territory_id).select(F.explode(ancestor_paths(F.col("path"))).alias("path"))
    return wh.territories.join(paths, "path").select("code", "name", "level", path_depth(F.col("path")).alias("depth"))


def descendants(wh: Warehouse, territory_id: int, max_depth: int | None = None) -> DataFrame:
    """A territory's subtree in order of depth and name."""
    found = flt.descendants(wh.territories, wh.path_of(territory_id), max_depth)
    return found.select("code", "name", "level", path_depth(F.col("path")).alias("depth")).orderBy("depth", "name", "code")


def children(wh: Warehouse, territory_id: int) -> DataFrame:
    return wh.territories.filter(F.col("parent_id") == territory_id).select("code", "name", "level")


def available_data(wh: Warehouse, territory_id: int, after: str | None = None, limit: int | None = None) -> DataFrame:
    """Matrices with facts of a territory: facts, distinct periods, years; a page in order of code where asked."""
    rows = wh.statistics.filter(F.col("territory_id") == territory_id).join(wh.time_periods.select("time_period_id", "year"), "time_period_id")
    found = rows.groupBy("matrix_id").agg(F.count("*").alias("fact_count"), F.countDistinct("time_period_id").alias("period_count"), F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    named = wh.matrices.select("matrix_id", "matrix_code", "name_ro")
    found = found.join(named if after is None else named.filter(F.col("matrix_code") > after), "matrix_id")
    found = found if limit is None else found.orderBy("matrix_code").limit(limit + 1)
    return found.select("matrix_code", "name_ro", "fact_count", "period_count", "min_year", "max_year")


def time_periods(wh: Warehouse, periodicity: str | None = None, year_from: int | None = None, year_to: int | None = None, matrix: str | None = None) -> DataFrame:
    rows = flt.years(wh.time_periods, year_from, year_to)
    if periodicity is not None:
        rows = rows.filter(F.col("periodicity") == periodicity)
    if matrix is not None:  # an unknown matrix filters nothing
        known = wh.matrices.filter(F.col("matrix_code") == matrix).select("matrix_id").first()
        if known is not None:
            rows = rows.join(wh.statistics.filter(F.col("matrix_id") == known[0]).select("time_period_id"), "time_period_id", "left_semi")
    return rows.select("year", "quarter", "month", "periodicity", F.col("period_start").cast("string").alias("period_start"), F.col("period_end").cast("string").alias("period_end"), "label_ro", "label_en")


# classifications


def class_types(wh: Warehouse, search: str | None = None, hierarchical: bool | None = None) -> DataFrame:
    rows = wh.class_types
    if search is not None:
        rows = rows.filter(flt.contains(F.col("name_ro"), search) | flt.contains(F.col("type_code"), search))
    if hierarchical is not None:
        rows = rows.filter(F.col("is_hierarchical") == hierarchical)
    counts = wh.class_values.groupBy("type_code").agg(F.count("*").alias("value_count"))
    return rows.join(counts, "type_code", "left").select("type_code", "name_ro", "is_hierarchical", F.coalesce("value_count", F.lit(0)).alias("value_count"))


def class_values(wh: Warehouse, type_code: str, search: str | None = None, parent_id: int | None = None, level: int | None = None, roots_only: bool = False) -> DataFrame:
    """Values of a type by name, code or normalised name, parent, level, or roots alone."""
    rows = wh.class_values.filter(F.col("type_code") == type_code).join(wh.class_tree, "value_id", "left")
    if search is not None:
        plain = normalize_label(F.lit(search))
        rows = rows.filter(flt.contains(F.col("name_ro"), search) | flt.contains(F.col("code"), search) | normalize_label(F.col("name_ro")).contains(plain))
    rows = rows if parent_id is None else rows.filter(F.col("parent_id") == parent_id)
    rows = rows if level is None else rows.filter(F.col("level") == level)
    rows = rows.filter("parent_id is null") if roots_only else rows
    return rows.select("code", "name_ro", "sort_order")


def class_value(wh: Warehouse, type_code: str, value_id: int) -> DataFrame:
    """A value, and below it its children where the type is a hierarchy, in their order."""
    rows = wh.class_values.filter(F.col("type_code") == type_code).join(wh.class_tree, "value_id", "left")
    if rows.filter(F.col("value_id") == value_id).isEmpty():
        raise NotFoundError(f"no value {value_id} of {type_code}")
    tall = wh.class_types.filter((F.col("type_code") == type_code) & F.col("is_hierarchical")).select("type_code")
    below = rows.filter(F.col("parent_id") == value_id).join(tall, "type_code", "left_semi").withColumn("kind", F.lit("child"))
    own = rows.filter(F.col("value_id") == value_id).withColumn("kind", F.lit("value"))
    return own.unionByName(below).select("kind", "value_id", "code", "name_ro", "parent_id", "level", "sort_order")


# discovery


def topics(wh: Warehouse, locale: str = "ro", category: str | None = None) -> DataFrame:
    rows = wh.tags if category is None else wh.tags.filter(F.col("category") == category)
    counts = wh.tag_links.groupBy("tag_id").agg(F.countDistinct("matrix_id").alias("matrix_count"))
    return rows.join(counts, "tag_id", "left").select("category", "slug", name(locale), F.coalesce("matrix_count", F.lit(0)).alias("matrix_count"))


def by_territory(wh: Warehouse, territory_id: int, include_children: bool = False, level: str | None = None) -> DataFrame:
    """Matrices with facts of a territory, or of its subtree."""
    root = wh.path_of(territory_id)
    places = wh.territories.filter(is_descendant(F.col("path"), root) if include_children else F.col("territory_id") == territory_id)
    places = places if level is None else places.filter(F.col("level") == level)
    rows = wh.statistics.join(places.select("territory_id"), "territory_id", "left_semi")
    found = rows.groupBy("matrix_id").agg(F.count("*").alias("fact_count"), F.countDistinct("territory_id").alias("territory_count"), F.countDistinct("time_period_id").alias("period_count"))
    return found.join(wh.matrices.select("matrix_id", "matrix_code"), "matrix_id").select("matrix_code", "fact_count", "territory_count", "period_count")


def by_time_range(wh: Warehouse, year_from: int, year_to: int, periodicity: str | None = None) -> DataFrame:
    rows = wh.matrices.withColumn("coverage_years", overlap_years(F.col("year_from"), F.col("year_to"), year_from, year_to))
    if periodicity is not None:
        rows = rows.filter(F.array_contains("periodicity", periodicity))
    return rows.filter("coverage_years > 0").select("matrix_code", "year_from", "year_to", "coverage_years")


def by_breakdowns(wh: Warehouse, territory: bool | None = None, temporal: bool | None = None, type_code: str | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """Matrices by the kinds and number of their dimensions."""
    rows = wh.matrices
    for wanted, kind in ((territory, "TERRITORIAL"), (temporal, "TEMPORAL")):
        if wanted is not None:
            rows = rows.join(wh.dimensions.filter(F.col("dimension_type") == kind).select("matrix_id"), "matrix_id", "left_semi" if wanted else "left_anti")
    if type_code is not None:
        rows = rows.join(wh.dimensions.filter(F.col("type_code") == type_code).select("matrix_id"), "matrix_id", "left_semi")
    counts = wh.dimensions.groupBy("matrix_id").agg(F.count("*").alias("dimension_count"), F.array_join(F.sort_array(F.collect_set("dimension_type")), ",").alias("kinds"))
    rows = rows.join(counts, "matrix_id", "left").withColumn("dimension_count", F.coalesce("dimension_count", F.lit(0)))
    rows = rows if low is None else rows.filter(F.col("dimension_count") >= low)
    rows = rows if high is None else rows.filter(F.col("dimension_count") <= high)
    return rows.select("matrix_code", "dimension_count", "kinds")


def tag_matrices(wh: Warehouse, slug: str) -> DataFrame:
    own = wh.tag_links.join(wh.tags.filter(F.col("slug") == slug).select("tag_id"), "tag_id").select("matrix_id").distinct()
    return wh.matrices.join(own, "matrix_id").select("matrix_code", "name_ro", "sync_status")


def related_tags(wh: Warehouse, slug: str, n: int = 10) -> DataFrame:
    """Tags that share matrices with a tag, most shared first."""
    own = wh.tag_links.join(wh.tags.filter(F.col("slug") == slug).select("tag_id"), "tag_id").select("matrix_id", F.col("tag_id").alias("own"))
    met = own.join(wh.tag_links, "matrix_id").filter("tag_id != own").groupBy("tag_id").agg(F.countDistinct("matrix_id").alias("shared"))
    return met.join(wh.tags, "tag_id").orderBy(F.desc("shared"), "slug").limit(n).select("slug", "category", "shared")
