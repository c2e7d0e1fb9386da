"""Line deduplication by distinct-site spread.

A line (trimmed of spaces, tabs and returns; blank lines take no part) is boilerplate when it stands on
``sites`` or more distinct sites, here the documents' sources. Exact copies of a text count once, with the
smallest of their sites: copies are left to exact deduplication, so a text is not emptied because it was
copied. For that every line of every different text crosses one shuffle, dealt by line and text. Then each line
hash gets a HyperLogLog sketch of its sites by aggregation: sketches are built per task and merged, so in this second
shuffle a line in a third of all rows is one sketch per task. Estimates clearly away from
the threshold decide at once; lines near it get an exact distinct count of their sites. The margin is over
six standard errors of the sketch, so decisions are those of exact counts. Boilerplate lines are then cut
from every document that has them.

The lines' hashes are stored once, and the sketches, the exact counts and the cuts read that table. A
line's hash is a pair of independent hashes, 96 bits; a row is told by its identifier and the MD5 of its
text, so only rows that repeat both are treated alike. A null text counts as empty, a null site as no site,
a null identifier is one like any other. A document whose lines all go becomes empty. Texts are split
whole, however long; a row's lines must fit in memory. An empty table gives an empty result; other columns,
whatever their names, take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import quoted, table, written

SITES = 10
LG_K = 12
MARGIN = 0.1
BLANK = " \t\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _keyed(rows: DataFrame) -> DataFrame:
    """One row per non-blank line: id, h, site, place, k1, k2."""
    lines = rows.select("id", "h", "site", F.posexplode(split_lines(F.col("text"))).alias("place", "line"))
    lines = lines.select("id", "h", "site", "place", F.trim("line", F.lit(BLANK)).alias("line")).filter("line != ''")
    return lines.select("id", "h", "site", "place", F.xxhash64("line").alias("k1"), F.crc32(F.encode("line", "UTF-8")).alias("k2"))


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(k1, k2) of the lines on at least ``sites`` sites."""
    placed = lines.groupBy("k1", "k2", "h").agg(F.min("site").alias("site"))
    spread = placed.groupBy("k1", "k2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("about"))
    low, high = sites * (1 - MARGIN) - 1, sites * (1 + MARGIN) + 1
    spread = written(spread.filter(F.col("about") >= low))
    near = spread.filter(F.col("about") <= high).select("k1", "k2")
    exact = placed.select("k1", "k2", "site").join(near, ["k1", "k2"], "left_semi").filter("site is not null").distinct()
    exact = exact.groupBy("k1", "k2").count().filter(F.col("count") >= sites).select("k1", "k2")
    return spread.filter(F.col("about") > high).select("k1", "k2").union(exact)


def clean_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", sites: int = SITES) -> DataFrame:
    """One row per input row: identifier, n_lines (not blank), n_removed, clean_text."""
    text = quoted(text_col).cast("string")
    rows = df.select(quoted(id_col).alias("id"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("h"), quoted(site_col).alias("site"), text.alias("text"))
    lines = written(_keyed(rows))
    cut = lines.select("id", "h", "place", "k1", "k2").join(written(boilerplate(lines, sites)), ["k1", "k2"], "left_semi")
    cut = written(cut.groupBy("id", "h").agg(F.collect_set("place").alias("cut")))
    # texts with cuts grow with the corpus, so the plan is the same at every size: a merge join, never a broadcast
    joined = rows.join(cut.hint("merge"), rows["id"].eqNullSafe(cut["id"]) & (rows["h"] == cut["h"]), "left").select(rows["id"], "text", F.coalesce("cut", F.array().cast("array<int>")).alias("cut"))
    split = joined.select("id", split_lines(F.col("text")).alias("lines"), "cut")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("cut"))
    return split.select(
        F.col("id").alias(id_col),
        F.size(F.filter("lines", lambda x: F.trim(x, F.lit(BLANK)) != "")).cast("long").alias("n_lines"),
        F.size("cut").cast("long").alias("n_removed"),
        F.array_join(F.transform(places, lambda p: F.get("lines", p)), "\n").alias("clean_text"),
    )


def op7_lines(spark, sf_dir: str) -> DataFrame:
    found = clean_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.length("clean_text").cast("long").alias("clean_chars"), F.sha2("clean_text", 256).alias("clean_sha256"))


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, source, body, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM docs),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
placed AS (SELECT k, body, min(source) AS source FROM keyed WHERE k <> '' GROUP BY k, body),
wide AS (SELECT k FROM placed GROUP BY k HAVING count(DISTINCT source) >= {SITES}),
marked AS (SELECT *, k IN (SELECT k FROM wide) AS gone FROM keyed),
clean AS (
  SELECT r, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS body
  FROM marked GROUP BY r
)
SELECT doc_id, n_lines, n_removed, length(clean.body) AS clean_chars, sha256(clean.body) AS clean_sha256 FROM docs JOIN clean USING (r)
"""
