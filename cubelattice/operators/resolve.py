"""Labels to entities: units, periods, territories, classification values; the mapping cache; matrix metadata.

Everything here works on distinct labels, which are as many as the catalog has entries, and finds or creates in one
pass: known ones are joined, the rest get numbers above the largest known one, in the order of their keys, so a run
that is repeated gives the same numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.functions.expr import append_absent, code_from_label, content_hash, normalize_label
from cubelattice.functions.labels import PERIODICITIES, infer_dimension_type, parse_time_label, period_label_en, period_label_ro, resolve_territory
from cubelattice.functions.unit_names import UNITS


def numbered(rows: DataFrame, known: DataFrame, ident: str, *order: str) -> DataFrame:
    """New rows with numbers above the known ones; catalog-sized, so one window may see them all."""
    top = known.agg(F.coalesce(F.max(ident), F.lit(0)).alias("top"))
    return rows.withColumn("nth", F.row_number().over(Window.orderBy(*order))).crossJoin(F.broadcast(top)).withColumn(ident, (F.col("top") + F.col("nth")).cast("int")).drop("nth", "top")  # one row


# units


def unit_name(label: Column) -> Column:
    """The name in a unit label: what stands after ``UM:``, any case, or the label itself; null if it is empty."""
    t = F.trim(label)
    return F.nullif(F.when(F.lower(F.substring(t, 1, 3)) == "um:", F.trim(F.substring(t, 4, 1000))).otherwise(t), F.lit(""))


def units(labels: DataFrame) -> DataFrame:
    """(label, label_en) -> label, code, symbol, name_ro, name_en, name_normalized. The code and the symbol are the
    dictionary's, else the code is made of the name; an English label given wins over the dictionary's."""
    named = labels.withColumn("name_ro", unit_name(F.col("label"))).filter("name_ro is not null")
    known = labels.sparkSession.createDataFrame(UNITS, "k string, code string, symbol string, english string")
    joined = named.join(F.broadcast(known), F.lower(normalize_label(F.col("name_ro"))) == F.col("k"), "left")  # a fixed dictionary
    return joined.select("label", F.coalesce("code", code_from_label(F.col("name_ro"))).alias("code"), "symbol", "name_ro", F.coalesce("label_en", "english", "name_ro").alias("name_en"), normalize_label(F.col("name_ro")).alias("name_normalized"))


def find_or_create_units(known: DataFrame, labels: DataFrame) -> DataFrame:
    """The unit table (unit_id, code, symbol, name_ro, name_en, patterns) after all labels: new codes are added, and a
    known unit's patterns grow by labels it did not have."""
    found = units(labels).groupBy("code").agg(F.sort_array(F.collect_set("label")).alias("labels"), F.min_by(F.struct("symbol", "name_ro", "name_en"), "label").alias("u"))
    fresh = found.join(known.select("code"), "code", "left_anti").select("code", "u.symbol", "u.name_ro", "u.name_en", F.col("labels").alias("patterns"))
    more = known.join(found.select("code", "labels"), "code", "left")
    grown = F.aggregate(F.coalesce("labels", F.array().cast("array<string>")), F.col("patterns"), append_absent)
    kept = more.select("unit_id", "code", "symbol", "name_ro", "name_en", grown.alias("patterns"))
    return kept.unionByName(numbered(fresh, known, "unit_id", "code"))


# periods


def periods(known: DataFrame, labels: DataFrame) -> DataFrame:
    """(label) -> label, year, quarter, month, periodicity and time_period_id; labels of no period have nulls. New
    periods get numbers; each period counts once, whatever its spellings."""
    keys = ["year", "quarter", "month", "periodicity"]
    parsed = labels.select("label", parse_time_label(F.col("label")).alias("p")).select("label", *[F.col(f"p.{k}").alias(k) for k in keys])
    same = lambda a, b: (F.col(f"{a}.year") == F.col(f"{b}.year")) & F.col(f"{a}.quarter").eqNullSafe(F.col(f"{b}.quarter")) & F.col(f"{a}.month").eqNullSafe(F.col(f"{b}.month")) & (F.col(f"{a}.periodicity") == F.col(f"{b}.periodicity"))
    wanted = parsed.filter("year is not null").select(*keys).distinct()
    fresh = wanted.alias("w").join(known.alias("k"), same("w", "k"), "left_anti")
    every = known.select(*keys, "time_period_id").unionByName(numbered(fresh, known, "time_period_id", *keys))
    return parsed.alias("p").join(every.alias("e"), same("p", "e"), "left").select("p.label", *[F.col(f"p.{k}") for k in keys], "e.time_period_id")


def period_rows(found: DataFrame) -> DataFrame:
    """Periods with their bounds and labels, one row each."""
    rows = found.filter("time_period_id is not null").drop("label").distinct()
    start = F.make_date("year", F.coalesce("month", (F.col("quarter") - 1) * 3 + 1, F.lit(1)), F.lit(1))
    end = F.last_day(F.make_date("year", F.coalesce("month", F.col("quarter") * 3, F.lit(12)), F.lit(1)))
    return rows.withColumns({"period_start": start, "period_end": end, "label_ro": period_label_ro(), "label_en": period_label_en()})


# territories


def territories(known: DataFrame, labels: DataFrame) -> DataFrame:
    """(label) -> label, territory_id, code. A number is looked up as a register number, then as a code; others by
    code. Territories are never created."""
    wanted = labels.select("label", resolve_territory(F.col("label")).alias("c"))
    by_number = known.filter("siruta_code is not null").select(F.col("siruta_code").alias("c"), F.struct("territory_id", "code").alias("n"))
    by_code = known.select(F.col("code").alias("c"), F.struct("territory_id", "code").alias("t"))
    joined = wanted.join(by_number, "c", "left").join(by_code, "c", "left").withColumn("f", F.coalesce("n", "t"))
    return joined.select("label", "f.territory_id", "f.code")


def counties_of(localities: DataFrame, counties: DataFrame) -> DataFrame:
    """(id, path) of both -> locality, county: the county of the longest path that a locality's path starts with, by
    an equal join on the paths above it."""
    parts = F.split("path", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    each = localities.select(F.col("id").alias("locality"), F.explode(above).alias("path"))
    met = each.join(counties.select("path", F.col("id").alias("county")), "path")
    return met.groupBy("locality").agg(F.max_by("county", F.length("path")).alias("county"))


# classification values


def class_values(known: DataFrame, labels: DataFrame) -> DataFrame:
    """The value table (value_id, type_code, code, content_hash, path, parent_id, level, name_ro, sort_order) after
    all labels (type_code, label, parent_label, level, sort_order): a label is known by type and hash of its
    normalised form, and counts once, with its first place. A parent is a value of the same type, known or new."""
    hashed = labels.withColumn("content_hash", content_hash(F.col("label")))
    once = hashed.groupBy("type_code", "content_hash").agg(F.min_by(F.struct("label", "parent_label", "level", "sort_order"), F.struct("sort_order", "label")).alias("f")).select("type_code", "content_hash", "f.*")
    fresh = numbered(once.join(known, ["type_code", "content_hash"], "left_anti"), known, "value_id", "type_code", "sort_order", "content_hash")
    fresh = fresh.withColumns({"code": code_from_label(F.col("label")), "parent_hash": F.when(F.col("parent_label").isNotNull(), content_hash(F.col("parent_label")))})
    own = known.select("type_code", F.col("content_hash").alias("parent_hash"), F.col("value_id").alias("p_id"), F.coalesce("path", "code").alias("p_path"))
    new = fresh.select("type_code", F.col("content_hash").alias("parent_hash"), F.col("value_id").alias("p_id"), F.col("code").alias("p_path"))
    rows = fresh.join(own.unionByName(new), ["type_code", "parent_hash"], "left")
    path = F.when(F.col("p_path").isNull(), F.col("code")).otherwise(F.concat_ws(".", "p_path", "code"))
    added = rows.select("value_id", "type_code", "code", "content_hash", path.alias("path"), F.col("p_id").alias("parent_id"), "level", F.col("label").alias("name_ro"), "sort_order")
    return known.select(*added.columns).unionByName(added)


# the mapping cache


def mapped(labels: DataFrame, cache: DataFrame, found: DataFrame, kind: str, reason: str, now: str) -> DataFrame:
    """(label, hint) -> rows of the cache (see ``catalog_rows``), one per normalised label and hint: a cached target
    wins (EXACT), else what was found for the label counts (label, target; PATTERN), else the label is unresolvable,
    with the reason. Cached labels without target are tried again."""
    wanted = labels.select(normalize_label(F.col("label")).alias("label_normalized"), "label", F.coalesce("hint", F.lit("")).alias("context_hint"))
    wanted = wanted.groupBy("label_normalized", "context_hint").agg(F.min("label").alias("label_original"))
    hits = cache.filter((F.col("context_type") == kind) & F.col("target").isNotNull()).select("label_normalized", "context_hint", F.col("target").alias("hit"))
    computed = found.select(F.col("label").alias("label_original"), F.col("target").cast("string").alias("computed"))
    rows = wanted.join(hits, ["label_normalized", "context_hint"], "left").join(computed, "label_original", "left")
    target = F.coalesce("hit", "computed")
    method = F.when(F.col("hit").isNotNull(), "EXACT").when(F.col("computed").isNotNull(), "PATTERN")
    return rows.select("label_normalized", "label_original", F.lit(kind).alias("context_type"), "context_hint", target.alias("target"), method.alias("method"), F.when(target.isNull(), reason).alias("reason"), F.lit(now).alias("created_at"))


def remembered(cache: DataFrame, rows: DataFrame) -> DataFrame:
    """The cache after new mappings: they replace rows of the same label, kind and hint."""
    keys = ["label_normalized", "context_type", "context_hint"]
    return cache.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


# metadata


def metadata(ro: DataFrame, en: DataFrame) -> DataFrame:
    """Landed matrix responses in two languages (``landing.MATRIX_JSON``, with a column code) -> one row per matrix:
    names, periodicities, years of the time dimension's options, flags, sources paired by place, dimensions with
    type, options and English labels paired by their code."""
    english = en.select("code", F.col("matrixName").alias("en_name"), F.col("surseDeDate").alias("en_sources"), F.col("dimensionsMap").alias("en_dims"))
    rows = ro.join(english, "code", "left")
    flag = lambda field: F.coalesce(F.col(f"details.{field}"), F.lit(0)) > 0
    words = F.transform(F.coalesce("periodicitati", F.array().cast("array<string>")), lambda p: F.lower(p))
    named = F.flatten(F.transform(words, lambda w: F.filter(F.array(*[F.when(w.contains(stem), kind) for kind, stem in PERIODICITIES]), lambda x: x.isNotNull())))
    label = lambda d, i: infer_dimension_type(d["label"], F.transform(d["options"], lambda o: o["label"]), i, F.col("details"))
    english_of = lambda d: F.get(F.transform(F.filter("en_dims", lambda e: e["dimCode"] == d["dimCode"]), lambda e: e["label"]), F.lit(0))
    dims = F.transform(
        "dimensionsMap",
        lambda d, i: F.struct(i.alias("dim_index"), d["label"].alias("label_ro"), english_of(d).alias("label_en"), label(d, i).alias("dimension_type"), F.size(d["options"]).alias("option_count"), F.exists(d["options"], lambda o: o["parentId"].isNotNull()).alias("is_hierarchical"), d["options"].alias("options")),
    )
    sources = F.transform("surseDeDate", lambda x, i: F.struct(x["nume"].alias("name"), F.get(F.transform("en_sources", lambda e: e["nume"]), i).alias("name_en")))
    rows = rows.withColumns({"dimensions": dims, "sources": sources})
    time = F.get(F.filter("dimensions", lambda d: d["dimension_type"] == "TEMPORAL"), F.lit(0))
    years = F.filter(F.transform(time["options"], lambda o: F.regexp_extract(o["label"], "[0-9]{4}", 0).try_cast("int")), lambda y: y.isNotNull())
    return rows.select(
        "code", F.col("matrixName").alias("name_ro"), F.col("en_name").alias("name_en"), named.alias("periodicity"), F.array_min(years).alias("year_from"), F.array_max(years).alias("year_to"),
        flag("nomLoc").alias("has_uat"), flag("nomJud").alias("has_county"), flag("matSiruta").alias("has_siruta"), flag("matCaen1").alias("has_caen1"), flag("matCaen2").alias("has_caen2"),
        F.col("ultimaActualizare").alias("last_update"), "sources", "dimensions",
    )
