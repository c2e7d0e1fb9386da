"""Scalar expressions: rounding, labels, keys, paths, periods. All run inside code generation."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _marked() -> dict[str, str]:
    """Letters with marks, by Unicode's canonical decomposition, and the letters that are left without the marks."""
    found = {}
    for c in map(chr, range(0xC0, 0x2000)):
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if not 0x300 <= ord(x) <= 0x36F)
        if len(plain) == 1 and plain != c and c.upper() == c:  # labels are in upper case before
            found[c] = plain
    return found


MARKED = _marked()


def js_round(x: Column, digits: int = 2) -> Column:
    """Round halves toward positive infinity, as Math.round does; null stays null."""
    k = float(10**digits)
    return F.floor(x * k + 0.5) / k


def pick_locale(ro: Column, en: Column, locale: str) -> Column:
    """The English name where it is asked for and not empty, else the Romanian one."""
    return F.when(F.coalesce(en, F.lit("")) != "", en).otherwise(ro) if locale == "en" else ro


def normalize_label(x: Column, dash_to_space: bool = False) -> Column:
    """Upper case without marks, runs of white space as one space, trimmed; null becomes empty."""
    up = F.translate(F.upper(F.coalesce(x, F.lit(""))), "".join(MARKED), "".join(MARKED.values()))
    up = F.regexp_replace(up, r"[̀-ͯ]", "")
    return F.trim(F.regexp_replace(F.translate(up, "-", " ") if dash_to_space else up, r"\s+", " "))


def blind(x: Column) -> Column:
    """The text under a collation that does not see case and marks, for any letter: comparisons, joins and groups of such
    texts, and searches in them, are blind to both. The text itself stays as it is."""
    return F.collate(x, "UNICODE_CI_AI")


def code_from_label(x: Column) -> Column:
    """A generated code: normalised, spaces as underscores, letters, digits and underscores only, 50 at most."""
    return F.substring(F.regexp_replace(F.translate(normalize_label(x), " ", "_"), "[^0-9A-Z_]", ""), 1, 50)


def content_hash(x: Column) -> Column:
    return F.sha2(normalize_label(x), 256)


def natural_key(matrix: Column, territory: Column, period: Column, unit: Column, class_ids: Column) -> Column:
    """MD5 of matrix:territory:period:unit:ids; missing parts read null, ids sort as strings."""
    ids = F.array_join(F.array_sort(F.transform(class_ids, lambda i: i.cast("string"))), ",")
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", text(matrix), text(territory), text(period), text(unit), ids))


def iso_period(year: Column, quarter: Column, month: Column) -> Column:
    y = year.cast("string")
    return F.when(month.isNotNull(), F.concat(y, F.lit("-"), F.lpad(month.cast("string"), 2, "0"))).when(quarter.isNotNull(), F.concat(y, F.lit("-Q"), quarter.cast("string"))).otherwise(y)


def is_descendant(path: Column, root: str | Column) -> Column:
    """``path`` is ``root`` or lies below it, label by label."""
    root = F.lit(root) if isinstance(root, str) else root
    return (path == root) | path.startswith(F.concat(root, F.lit(".")))


def path_depth(path: Column) -> Column:
    return F.size(F.split(path, r"\."))


def ancestor_paths(path: Column) -> Column:
    """All prefixes of a path, root first, itself last."""
    parts = F.split(path, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))


def percent(part: Column, whole: Column, digits: int = 1, empty: float | None = 0.0) -> Column:
    """part of whole as a percentage; ``empty`` where the whole is 0 or null."""
    return F.when(whole > 0, js_round(part * 100.0 / whole, digits)).otherwise(F.lit(empty).cast("double"))


def overlap_years(start: Column, end: Column, low: int | None, high: int | None) -> Column:
    """Years that a range shares with the asked one; 0 where the range is unknown."""
    low_c, high_c = (F.lit(low) if low is not None else start), (F.lit(high) if high is not None else end)
    return F.when(start.isNull() | end.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(end, high_c) - F.greatest(start, low_c) + 1))


def strength(r: Column) -> Column:
    """Words for a correlation."""
    a = F.abs(r)
    return F.when(a >= 0.7, "strong").when(a >= 0.4, "moderate").when(a >= 0.2, "weak").when(a.isNotNull(), "negligible")


def append_absent(items: Column, item: Column) -> Column:
    """The array with the item at its end, unless it has it."""
    return F.when(F.array_contains(items, item), items).otherwise(F.array_append(items, item))
