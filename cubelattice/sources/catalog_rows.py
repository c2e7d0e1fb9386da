"""Fixed rows of the sample cube's catalog tables. Facts, territories, periods (``overlay``) and most of the catalog
(``derived``) come from the driver's tables."""

from __future__ import annotations

#: value_id, type_code, code, name_ro, sort_order
CLASS_VALUES = [
    (1, "ORDER_STATUS", "TOTAL", "Total", 0),
    (2, "ORDER_STATUS", "F", "Finalizate", 1),
    (3, "ORDER_STATUS", "O", "Deschise", 2),
    (4, "ORDER_STATUS", "P", "Parțiale", 3),
    (11, "SEGMENT", "TOTAL", "Total", 0),
    (12, "SEGMENT", "AUTOMOBILE", "Automobile", 1),
    (13, "SEGMENT", "BUILDING", "Construcții", 2),
    (14, "SEGMENT", "FURNITURE", "Mobilă", 3),
    (15, "SEGMENT", "HOUSEHOLD", "Gospodărie", 4),
    (16, "SEGMENT", "MACHINERY", "Utilaje", 5),
    (21, "RETURN_FLAG", "TOTAL", "Total", 0),
    (22, "RETURN_FLAG", "A", "Acceptate", 1),
    (23, "RETURN_FLAG", "N", "Niciuna", 2),
    (24, "RETURN_FLAG", "R", "Returnate", 3),
    (31, "EVENT_TYPE", "TOTAL", "Total", 0),
    (32, "EVENT_TYPE", "click", "Clic", 1),
    (33, "EVENT_TYPE", "error", "Eroare", 2),
    (34, "EVENT_TYPE", "purchase", "Cumpărare", 3),
    (35, "EVENT_TYPE", "signup", "Înscriere", 4),
    (36, "EVENT_TYPE", "view", "Vizualizare", 5),
]
CLASS_VALUES_SCHEMA = "value_id int, type_code string, code string, name_ro string, sort_order int"

#: value_id, parent_id, level: every type's values lie below its total
CLASS_TREE = [(v, None if code == "TOTAL" else next(x for x, y, c, _, _ in CLASS_VALUES if y == t and c == "TOTAL"), int(code != "TOTAL")) for v, t, code, _, _ in CLASS_VALUES]
CLASS_TREE_SCHEMA = "value_id int, parent_id int, level int"

CLASS_TYPES = [
    ("ORDER_STATUS", "Stare comandă", "Order status", False),
    ("SEGMENT", "Segment de piață", "", False),
    ("RETURN_FLAG", "Retur", "Return flag", False),
    ("EVENT_TYPE", "Tip eveniment", None, True),
]
CLASS_TYPES_SCHEMA = "type_code string, name_ro string, name_en string, is_hierarchical boolean"

UNITS = [(1, "LEI", "Lei", "Lei (currency)", "lei"), (2, "NUMBER", "Număr", "Number", "nr."), (3, "BUCATI", "Bucăți", "Pieces", "buc.")]
UNITS_SCHEMA = "unit_id int, code string, name_ro string, name_en string, symbol string"

CONTEXTS = [
    (1, "1", "Economie", "Economy", 0, None, "1", "context"),
    (2, "2", "Statistică tehnică", "", 0, None, "2", "context"),
    (3, "3", "Produse", "Products", 0, None, "3", "context"),
    (10, "10", "Comerț", "Trade", 1, 1, "1.10", "context"),
    (1010, "1010", "Comenzi", "Orders", 2, 10, "1.10.1010", "matrix"),
    (1020, "1020", "Linii de comandă", None, 2, 10, "1.10.1020", "matrix"),
    (20, "20", "Evenimente", "Events", 1, 2, "2.20", "matrix"),
]
CONTEXTS_SCHEMA = "context_id int, code string, name_ro string, name_en string, level int, parent_id int, path string, children_type string"

MATRICES = [
    (1, "ORD101A", "Valoarea comenzilor", "Order value", 1010, "SYNCED", ["ANNUAL", "MONTHLY"], 1995, 2001, True, True, "15-03-2024"),
    (2, "ORD102A", "Numărul comenzilor", "Number of orders", 1010, "SYNCED", ["ANNUAL"], 1995, 2001, False, True, "01-12-2023"),
    (3, "LIN101A", "Cantitatea livrată", None, 1020, "STALE", ["ANNUAL", "QUARTERLY"], 1995, 2001, False, True, "2024-01-05"),
    (4, "EVT101A", "Valoarea evenimentelor", "", 20, "PENDING", ["MONTHLY"], 2024, 2024, False, False, None),
    (5, "NUL101A", "Valoarea comenzilor cu lipsuri", "Order value with gaps", 1010, "FAILED", ["ANNUAL"], 1995, 2001, False, True, "31-02-2024"),
    (6, "EMP101A", "Fără date", "No data", 20, "PENDING", ["ANNUAL"], None, None, False, False, None),
]
MATRICES_SCHEMA = "matrix_id int, matrix_code string, name_ro string, name_en string, context_id int, sync_status string, periodicity array<string>, year_from int, year_to int, has_uat boolean, has_county boolean, last_update string"

#: matrix_id, dim_index, label_ro, label_en, dimension_type, type_code, option_count
DIMENSIONS = [
    (1, 0, "Stare comandă", "Order status", "CLASSIFICATION", "ORDER_STATUS", 4),
    (1, 1, "Teritorii", "Territories", "TERRITORIAL", None, 33),
    (1, 2, "Ani si luni", "Years and months", "TEMPORAL", None, 87),
    (1, 3, "UM: Lei", "UM: Lei", "UNIT_OF_MEASURE", None, 1),
    (2, 0, "Stare comandă", "Order status", "CLASSIFICATION", "ORDER_STATUS", 4),
    (2, 1, "Segment", "Segment", "CLASSIFICATION", "SEGMENT", 6),
    (2, 2, "Judete", "Counties", "TERRITORIAL", None, 33),
    (2, 3, "Ani", "Years", "TEMPORAL", None, 7),
    (3, 0, "Retur", "Return flag", "CLASSIFICATION", "RETURN_FLAG", 4),
    (3, 1, "Judete", None, "TERRITORIAL", None, 33),
    (3, 2, "Trimestre", "Quarters", "TEMPORAL", None, 35),
    (4, 0, "Tip eveniment", "Event type", "CLASSIFICATION", "EVENT_TYPE", 6),
    (4, 1, "Luni", "Months", "TEMPORAL", None, 1),
    (5, 0, "Judete", "Counties", "TERRITORIAL", None, 25),
    (5, 1, "Ani", "Years", "TEMPORAL", None, 7),
    (6, 0, "Ani", "Years", "TEMPORAL", None, 0),
]
DIMENSIONS_SCHEMA = "matrix_id int, dim_index int, label_ro string, label_en string, dimension_type string, type_code string, option_count int"

TAGS = [
    (1, "orders", "Comenzi", "Orders", "topic"),
    (2, "lineitems", "Linii", "", "topic"),
    (3, "events", "Evenimente", "Events", "topic"),
    (4, "quality", "Calitate", None, "use-case"),
    (5, "unused", "Nefolosit", "Unused", "audience"),
]
TAGS_SCHEMA = "tag_id int, slug string, name_ro string, name_en string, category string"
TAG_LINKS = [(1, 1), (2, 1), (5, 1), (3, 2), (4, 3), (1, 4), (5, 4), (3, 4), (2, 2)]
TAG_LINKS_SCHEMA = "matrix_id int, tag_id int"

#: code, name_ro, name_en, category, is_active, multiplier
INDICATORS = [
    ("avg-order-value", "Valoarea medie a comenzii", "Average order value", "economy", True, 1.0),
    ("open-share", "Ponderea comenzilor deschise", None, "economy", True, 100.0),
    ("lines-and-orders", "Cantități și comenzi", "Quantities and orders", "mixed", True, 1.0),
    ("empty-denominator", "Numitor lipsă", "Missing denominator", "mixed", False, 10.0),
]
INDICATORS_SCHEMA = "indicator_code string, name_ro string, name_en string, category string, is_active boolean, multiplier double"
#: indicator_code, role, matrix_code, type_code, value_code (null: no filter)
INDICATOR_PARTS = [
    ("avg-order-value", "numerator", "ORD101A", "ORDER_STATUS", "TOTAL"),
    ("avg-order-value", "denominator", "ORD102A", None, None),
    ("open-share", "numerator", "ORD101A", "ORDER_STATUS", "O"),
    ("open-share", "denominator", "ORD101A", "ORDER_STATUS", "TOTAL"),
    ("lines-and-orders", "numerator", "LIN101A", "RETURN_FLAG", "TOTAL"),
    ("lines-and-orders", "numerator", "EMP101A", None, None),
    ("lines-and-orders", "denominator", "ORD101A", "ORDER_STATUS", "TOTAL"),
    ("empty-denominator", "numerator", "ORD101A", "ORDER_STATUS", "TOTAL"),
    ("empty-denominator", "denominator", "EMP101A", None, None),
]
INDICATOR_PARTS_SCHEMA = "indicator_code string, role string, matrix_code string, type_code string, value_code string"

#: task_id, matrix_id, status, year_from, year_to, priority, chunks_total, chunks_completed, chunks_failed, rows_inserted, rows_updated, created_at, locked_until
TASKS = [
    (1, 1, "COMPLETED", 1995, 2001, 5, 10, 10, 0, 900, 12, "2024-01-01 08:00:00", None),
    (2, 1, "RUNNING", 1995, 2001, 5, 8, 3, 1, 120, 0, "2024-02-01 08:00:00", "2024-02-10 00:05:00"),
    (3, 2, "FAILED", 1995, 1999, 1, 4, 2, 2, 50, 5, "2024-01-05 09:30:00", None),
    (4, 2, "COMPLETED", 1995, 2001, 1, 4, 4, 0, 80, 0, "2024-01-20 09:30:00", None),
    (5, 3, "PENDING", 1995, 2001, 9, 0, 0, 0, 0, 0, "2024-02-02 10:00:00", None),
    (6, 3, "PLANNING", 1995, 2001, 9, 0, 0, 0, 0, 0, "2024-02-01 10:00:00", "2024-02-09 23:00:00"),
    (7, 4, "CANCELLED", 2024, 2024, 0, 6, 1, 0, 10, 0, "2024-01-15 12:00:00", None),
    (8, 5, "FAILED", 1995, 2001, 2, 3, 0, 3, 0, 0, "2024-01-25 00:00:00", None),
    (9, 6, "PENDING", 2000, 2001, 9, 0, 0, 0, 0, 0, "2024-02-03 10:00:00", None),
]
TASKS_SCHEMA = "task_id int, matrix_id int, status string, year_from int, year_to int, priority int, chunks_total int, chunks_completed int, chunks_failed int, rows_inserted int, rows_updated int, created_at string, locked_until string"
#: chunk_id, matrix_id, chunk_hash, status, retry_count, next_retry_at, error_message, cells_returned
CHUNKS = [
    (1, 1, "a1", "COMPLETED", 0, None, None, 1200),
    (2, 1, "a2", "FAILED", 1, "2024-02-09 23:59:00", "HTTP 429", None),
    (3, 1, "a3", "FAILED", 2, "2024-02-10 00:00:30", "timeout", None),
    (4, 2, "b1", "EXHAUSTED", 3, None, "permanent", None),
    (5, 2, "b2", "COMPLETED", 0, None, None, 800),
    (6, 5, "c1", "FAILED", 0, None, "reset", None),
    (7, 5, "c2", "IN_PROGRESS", 0, None, None, None),
]
CHUNKS_SCHEMA = "chunk_id int, matrix_id int, chunk_hash string, status string, retry_count int, next_retry_at string, error_message string, cells_returned int"

#: The moment that leases and retries are compared with.
NOW = "2024-02-10 00:00:00"

#: query_id, name, matrix_code, territory_path, territory_level, value_ids, year_from, year_to, periodicity
SAVED = [
    (1, "Comenzi pe regiuni", "ORD101A", "W.M1", "NUTS2", [1], 1996, 1999, "ANNUAL"),
    (2, "Retururi", "LIN101A", None, "NATIONAL", [22, 24], None, None, "QUARTERLY"),
    (3, "Tot", "NUL101A", None, None, [], None, None, None),
]
SAVED_SCHEMA = "query_id int, name string, matrix_code string, territory_path string, territory_level string, value_ids array<int>, year_from int, year_to int, periodicity string"

#: label_normalized, label_original, context_type, context_hint, target (null: none), method, reason, created_at
LABEL_MAPPINGS = [
    ("ANUL 1998", "Anul 1998", "TIME_PERIOD", "", "19980000", "PATTERN", None, "2024-01-03 08:00:00"),
    ("ATLANTIDA", "Atlantida", "TERRITORY", "ORD101A", None, None, "no territory", "2024-01-03 08:00:01"),
    ("LUNA BRUMAR 1999", "Luna Brumar 1999", "TIME_PERIOD", "", None, None, "no period", "2024-01-04 08:00:00"),
]
LABEL_MAPPINGS_SCHEMA = "label_normalized string, label_original string, context_type string, context_hint string, target string, method string, reason string, created_at string"

STATIC = {
    "class_values": (CLASS_VALUES, CLASS_VALUES_SCHEMA),
    "class_tree": (CLASS_TREE, CLASS_TREE_SCHEMA),
    "label_mappings": (LABEL_MAPPINGS, LABEL_MAPPINGS_SCHEMA),
    "class_types": (CLASS_TYPES, CLASS_TYPES_SCHEMA),
    "units": (UNITS, UNITS_SCHEMA),
    "contexts": (CONTEXTS, CONTEXTS_SCHEMA),
    "matrices": (MATRICES, MATRICES_SCHEMA),
    "dimensions": (DIMENSIONS, DIMENSIONS_SCHEMA),
    "tags": (TAGS, TAGS_SCHEMA),
    "tag_links": (TAG_LINKS, TAG_LINKS_SCHEMA),
    "indicators": (INDICATORS, INDICATORS_SCHEMA),
    "indicator_parts": (INDICATOR_PARTS, INDICATOR_PARTS_SCHEMA),
    "tasks": (TASKS, TASKS_SCHEMA),
    "chunks": (CHUNKS, CHUNKS_SCHEMA),
    "saved": (SAVED, SAVED_SCHEMA),
}
