"""Catalog entries that the driver's tables give beside the fixed ones of ``catalog_rows``.

Every pair of part type and brand that was sold is a matrix ("product"), with its years, dimensions, context (the type)
and tags (the brand, and some of the fixed tags). Part names are a classification of two levels, part sizes are units, market
segments are indicators, events are sync tasks and chunks, and months and priorities of orders are cached labels. All of it is
lazy, and numbers are made of ranks and keys, so a run that is repeated gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.functions.expr import normalize_label
from cubelattice.functions.labels import period_label_ro

ROOT = 3  # the context of all products
PART_NAME, PART_TOTAL = "PART_NAME", 1000
PRIORITY, PRIORITY_TOTAL = "PRIORITY", 2000
TASK_STATUS = {"purchase": "COMPLETED", "error": "FAILED", "signup": "PENDING"}
CHUNK_STATUS = ("COMPLETED", "FAILED", "EXHAUSTED", "IN_PROGRESS")
STAMP = "yyyy-MM-dd HH:mm:ss"


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def even(x: Column, then: Column, other: Column | None = None) -> Column:
    return F.when(x % 2 == 0, then).otherwise(other if other is not None else F.lit(None))


def types(read) -> DataFrame:
    """(p_type, type_no): part types in order of their names, a few."""
    return read("part").select("p_type").distinct().select("p_type", F.row_number().over(Window.orderBy("p_type")).alias("type_no"))


def products(read) -> DataFrame:
    """(type_no, p_type, brand_no, matrix_id, parts, sizes, names, suppliers, year_from, year_to, last_ship)."""
    part = read("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", F.substring("p_brand", 7, 9).cast("int").alias("brand_no"), "p_size", "p_name")
    sold = read("lineitem").select("l_partkey", "l_suppkey", "l_shipdate").join(part, "l_partkey")
    found = sold.groupBy("p_type", "brand_no").agg(
        F.count_distinct("l_partkey").cast("int").alias("parts"),
        F.count_distinct("p_size").cast("int").alias("sizes"),
        F.count_distinct("p_name").cast("int").alias("names"),
        F.count_distinct("l_suppkey").cast("int").alias("suppliers"),
        F.min(F.year("l_shipdate")).alias("year_from"),
        F.max(F.year("l_shipdate")).alias("year_to"),
        F.max("l_shipdate").alias("last_ship"),
    )
    return found.join(types(read), "p_type").withColumn("matrix_id", (1000 + F.col("type_no") * 100 + F.col("brand_no")).cast("int"))


def contexts(read) -> DataFrame:
    n = F.col("type_no")
    return types(read).select(
        (100 + n).cast("int").alias("context_id"), text(100 + n).alias("code"), text("Produse ", F.col("p_type")).alias("name_ro"), even(n, text("Products ", F.col("p_type"))).alias("name_en"),
        F.lit(1).alias("level"), F.lit(ROOT).alias("parent_id"), text(f"{ROOT}.", 100 + n).alias("path"), F.lit("matrix").alias("children_type"),
    )


def matrices(read) -> DataFrame:
    brand, parts = F.col("brand_no"), F.col("parts")
    status = F.get(F.array(*map(F.lit, ("SYNCED", "STALE", "PENDING", "FAILED"))), parts % 4)
    return products(read).select(
        "matrix_id", text("PRD", F.col("type_no"), F.lpad(brand.cast("string"), 2, "0")).alias("matrix_code"), text("Produse ", F.col("p_type"), " marca ", brand).alias("name_ro"),
        even(brand, text("Products ", F.col("p_type"), " brand ", brand), F.lit("")).alias("name_en"), (100 + F.col("type_no")).cast("int").alias("context_id"), status.alias("sync_status"),
        even(brand, F.array(F.lit("ANNUAL"), F.lit("MONTHLY")), F.array(F.lit("ANNUAL"))).alias("periodicity"), "year_from", "year_to", F.lit(False).alias("has_uat"), (parts % 2 == 0).alias("has_county"),
        F.date_format("last_ship", "dd-MM-yyyy").alias("last_update"),
    )


def dimensions(read) -> DataFrame:
    """Part names and years of every product, suppliers of those by county."""
    rows = products(read)

    def dim(index: int, ro: str, en: str | None, kind: str, type_code: str | None, count: Column) -> Column:
        cells = [F.lit(index), F.lit(ro), F.lit(en).cast("string"), F.lit(kind), F.lit(type_code).cast("string"), count.cast("int")]
        return F.struct(*[c.alias(n) for c, n in zip(cells, ("dim_index", "label_ro", "label_en", "dimension_type", "type_code", "option_count"), strict=True)])

    names = dim(0, "Produse", "Products", "CLASSIFICATION", PART_NAME, F.col("names"))
    years = dim(1, "Ani", None, "TEMPORAL", None, F.col("year_to") - F.col("year_from") + 1)
    places = dim(2, "Judete de livrare", "Counties of delivery", "TERRITORIAL", None, F.col("suppliers"))
    each = F.when(F.col("parts") % 2 == 0, F.array(names, years, places)).otherwise(F.array(names, years))
    return rows.select("matrix_id", F.explode(each).alias("d")).select("matrix_id", "d.*")


def class_types(read) -> DataFrame:
    names = read("part").limit(1).select(F.lit(PART_NAME).alias("type_code"), F.lit("Produse după nume").alias("name_ro"), F.lit("Products by name").alias("name_en"), F.lit(True).alias("is_hierarchical"))
    return names.union(read("orders").limit(1).select(F.lit(PRIORITY), F.lit("Prioritate"), F.lit(""), F.lit(False)))


def part_names(read) -> DataFrame:
    """(value_id, parent_id, level, code, name, sort_order): the total, the nouns (second words), the whole names."""
    found = read("part").select("p_name").distinct().withColumn("noun", F.substring_index("p_name", " ", -1))
    noun = found.select("noun").distinct().select("noun", (PART_TOTAL + F.row_number().over(Window.orderBy("noun"))).alias("noun_id"))
    whole = found.join(noun, "noun").withColumn("nth", F.row_number().over(Window.orderBy("p_name")))
    total = read("part").limit(1).select(F.lit(PART_TOTAL).alias("value_id"), F.lit(None).cast("int").alias("parent_id"), F.lit(0).alias("level"), F.lit("TOTAL").alias("code"), F.lit("Total").alias("name"), F.lit(0).alias("sort_order"))
    middle = noun.select("noun_id", F.lit(PART_TOTAL), F.lit(1), F.upper("noun"), "noun", (F.col("noun_id") - PART_TOTAL).cast("int"))
    lowest = whole.select((PART_TOTAL + 100 + F.col("nth")).cast("int"), "noun_id", F.lit(2), F.upper(F.translate("p_name", " ", "_")), "p_name", F.col("nth"))
    return total.union(middle).union(lowest)


def priorities(read) -> DataFrame:
    """The same of the priorities of orders, a flat type below its total."""
    found = read("orders").select("o_orderpriority").distinct().withColumn("nth", F.row_number().over(Window.orderBy("o_orderpriority")))
    total = read("orders").limit(1).select(F.lit(PRIORITY_TOTAL).alias("value_id"), F.lit(None).cast("int").alias("parent_id"), F.lit(0).alias("level"), F.lit("TOTAL").alias("code"), F.lit("Total").alias("name"), F.lit(0).alias("sort_order"))
    return total.union(found.select((PRIORITY_TOTAL + F.col("nth")).cast("int"), F.lit(PRIORITY_TOTAL), F.lit(1), F.substring("o_orderpriority", 3, 20), "o_orderpriority", "nth"))


def _values(read) -> DataFrame:
    return part_names(read).withColumn("type_code", F.lit(PART_NAME)).union(priorities(read).withColumn("type_code", F.lit(PRIORITY)))


def class_values(read) -> DataFrame:
    return _values(read).select("value_id", "type_code", "code", F.col("name").alias("name_ro"), "sort_order")


def class_tree(read) -> DataFrame:
    return _values(read).select("value_id", "parent_id", "level")


def units(read) -> DataFrame:
    n = F.col("p_size")
    return read("part").select("p_size").distinct().select((100 + n).cast("int").alias("unit_id"), text("MARIME_", n).alias("code"), text("Mărime ", n).alias("name_ro"), even(n, text("Size ", n), F.lit("")).alias("name_en"), text("m", n).alias("symbol"))


def tags(read) -> DataFrame:
    n = F.substring("p_brand", 7, 9).cast("int")
    return read("part").select("p_brand").distinct().select(
        (100 + n).cast("int").alias("tag_id"), text("brand-", n).alias("slug"), text("Marca ", n).alias("name_ro"), even(n, text("Brand ", n)).alias("name_en"), even(n, F.lit("topic"), F.lit("audience")).alias("category")
    )


def tag_links(read) -> DataFrame:
    """A product bears its brand's tag, "orders" where it is a promotion, "quality" where a third of its parts is whole."""
    own = F.array(100 + F.col("brand_no"), F.when(F.col("p_type") == "PROMO", 1), F.when(F.col("parts") % 3 == 0, 4))
    return products(read).select("matrix_id", F.explode(own).alias("tag_id")).filter("tag_id is not null").select("matrix_id", F.col("tag_id").cast("int"))


def _segments(read) -> DataFrame:
    return read("customer").select("c_mktsegment").distinct().withColumn("code", text("share-", F.lower("c_mktsegment")))


def indicators(read) -> DataFrame:
    n = F.length("c_mktsegment")
    return _segments(read).select(F.col("code").alias("indicator_code"), text("Ponderea ", F.col("c_mktsegment")).alias("name_ro"), even(n, text("Share of ", F.col("c_mktsegment"))).alias("name_en"), F.lit("segments").alias("category"), (n != 7).alias("is_active"), F.lit(100.0).alias("multiplier"))


def indicator_parts(read) -> DataFrame:
    each = F.explode(F.array(F.struct(F.lit("numerator").alias("role"), F.col("c_mktsegment").alias("v")), F.struct(F.lit("denominator").alias("role"), F.lit("TOTAL").alias("v")))).alias("x")
    return _segments(read).select(F.col("code").alias("indicator_code"), each).select("indicator_code", "x.role", F.lit("ORD102A").alias("matrix_code"), F.lit("SEGMENT").alias("type_code"), F.col("x.v").alias("value_code"))


def _events(read, *kinds: str) -> DataFrame:
    """Events of some types, each with a product's number and the number k of its properties."""
    rows = read("events").filter(F.col("event_type").isin(*kinds))
    matrix = (1000 + (F.col("event_id") % 6 + 1) * 100 + F.col("event_id") % 25 + 1).cast("int")
    return rows.withColumns({"matrix_id": matrix, "k": F.get_json_object("props", "$.k").cast("int")})


def tasks(read) -> DataFrame:
    k, event = F.col("k"), F.col("event_type")
    status = F.lit(None).cast("string")
    for name, value in TASK_STATUS.items():
        status = F.when(event == name, value).otherwise(status)
    running = (event == "signup") & (k % 2 == 0)  # half of the waiting ones are at work
    status = F.when(running, "RUNNING").otherwise(status)
    return _events(read, *TASK_STATUS).select(
        (1000 + F.col("event_id")).cast("int").alias("task_id"), "matrix_id", status.alias("status"), F.lit(1995).alias("year_from"), F.lit(2001).alias("year_to"), (k % 10).alias("priority"), k.alias("chunks_total"),
        F.when(event == "purchase", k).otherwise(F.floor(k / 2)).cast("int").alias("chunks_completed"), F.when(event == "error", 1).otherwise(0).alias("chunks_failed"), F.floor(F.col("value") * 10).cast("int").alias("rows_inserted"), F.col("user_id").cast("int").alias("rows_updated"),
        F.date_format("ts", STAMP).alias("created_at"), F.when(running, F.date_format(F.col("ts") + F.expr("INTERVAL 20 DAYS"), STAMP)).alias("locked_until"),
    )


def chunks(read) -> DataFrame:
    k = F.col("k")
    status = F.get(F.array(*map(F.lit, CHUNK_STATUS)), k % 4)
    return _events(read, "click", "view").select(
        (1000 + F.col("event_id")).cast("int").alias("chunk_id"), "matrix_id", F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 8).alias("chunk_hash"), status.alias("status"), (k % 4).alias("retry_count"),
        F.when((k % 4 == 1) & (k % 3 > 0), F.date_format(F.col("ts") + F.expr("INTERVAL 20 DAYS"), STAMP)).alias("next_retry_at"), F.when(k % 4 == 1, text("HTTP ", 400 + k)).when(k % 4 == 2, "permanent").alias("error_message"),
        F.when(k % 4 == 0, F.floor(F.col("value") * 100).cast("int")).alias("cells_returned"),
    )


def label_mappings(read) -> DataFrame:
    months = read("orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).distinct().withColumn("quarter", F.lit(None).cast("int"))
    months = months.withColumn("label", period_label_ro())
    none = F.lit(None).cast("string")
    known = months.select(normalize_label(F.col("label")).alias("label_normalized"), F.col("label").alias("label_original"), F.lit("TIME_PERIOD").alias("context_type"), F.lit("").alias("context_hint"), (F.col("year") * 10_000 + 1000 + F.col("month")).cast("string").alias("target"), F.lit("PATTERN").alias("method"), none.alias("reason"), F.lit("2024-01-05 08:00:00").alias("created_at"))
    words = read("orders").select("o_orderpriority").distinct()
    lost = words.select(normalize_label(F.col("o_orderpriority")), "o_orderpriority", F.lit("TERRITORY"), F.lit("ORD101A"), none, none, F.lit("no territory"), text("2024-01-06 08:00:0", F.substring("o_orderpriority", 1, 1)))
    return known.union(lost)


#: Of each catalog table the rows that are derived.
DERIVED: dict[str, Callable] = {
    "class_values": class_values, "class_tree": class_tree, "label_mappings": label_mappings, "class_types": class_types, "units": units, "contexts": contexts, "matrices": matrices, "dimensions": dimensions,
    "tags": tags, "tag_links": tag_links, "indicators": indicators, "indicator_parts": indicator_parts, "tasks": tasks, "chunks": chunks,
}
