"""Which texts stand inside which: an inverted index of q-grams instead of a comparison of all with all.

A text that is looked for (a needle) is posted under one of its q-grams, the one that fewest of the searched texts (hays)
have; a needle with a q-gram that no hay has stands in none. Each hay asks with all its q-grams, so a needle meets
just the hays that have its rarest q-gram, and these pairs are verified. A needle shorter than q is posted as a whole, and hays
ask with their substrings of that length, too. Frequencies, postings and questions are joined by equality on (group, gram),
which Spark broadcasts by measured size and merge-joins beyond, split where a gram is hot.

Where few options meet many long cells, ``near_options`` first drops, where they are read, the cells that no option can match,
and ``match_labels`` compares what is left with each option.
"""

from __future__ import annotations

import re
import sys
from functools import cache, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelattice.functions.expr import normalize_label
from cubelattice.sources.scratch import stored

Q = 3
#: Options, and characters of them all, up to which one expression looks for them; its automaton outgrows RE2's memory far beyond.
FEW, BRIEF = 1000, 4096
#: Options up to which comparing each with all labels costs less than the labels' q-grams.
ONE_BY_ONE = 256
SPACE = r"[\t\n\x0B\f\r ]"  # white space, as normalize_label has it


def grams(text: Column, size: int) -> Column:
    """The different substrings of a length, by overlapping matches; none of a shorter text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def contained(needles: DataFrame, hays: DataFrame, q: int = Q) -> DataFrame:
    """(dim, needle, text) and (dim, hay, text), both stored -> the pairs (needle, hay) of a dimension where the needle's text
    stands in the hay's. Empty needles stand nowhere."""
    longest = hays.agg(F.max(F.length("text"))).first()[0] or 0  # a longer needle stands in none
    own = needles.filter((F.col("text") != "") & (F.length("text") <= longest)).withColumn("size", F.least(F.length("text"), F.lit(q)))
    sizes = sorted(r[0] for r in own.select("size").distinct().collect())  # q lengths at most
    if not sizes:
        return needles.sparkSession.createDataFrame([], "needle long, hay long")
    posted = F.coalesce(*[F.when(F.col("size") == n, grams(F.col("text"), n)) for n in sizes])
    each = own.select("dim", "needle", F.explode(posted).alias("gram"))
    asked = F.array_distinct(F.flatten(F.array(*[grams(F.col("text"), n) for n in sizes])))
    # of the hays' q-grams those that some needle has
    asked = stored(hays.select("dim", "hay", F.explode(asked).alias("gram")).join(stored(each.select("dim", "gram").distinct()), ["dim", "gram"], "left_semi"))
    often = asked.groupBy("dim", "gram").agg(F.count("*").alias("often"))
    each = each.join(often, ["dim", "gram"], "left")
    rarest = each.groupBy("dim", "needle").agg(F.min_by("gram", F.struct("often", "gram")).alias("gram"), F.count_if(F.col("often").isNull()).alias("lacking"))
    posted = stored(rarest.filter("lacking = 0").select("dim", "gram", "needle"))
    met = asked.join(posted, ["dim", "gram"]).select("needle", "hay")
    met = met.join(needles.select("needle", F.col("text").alias("short")), "needle").join(hays.select("hay", F.col("text").alias("long")), "hay")
    return met.filter(F.col("long").contains(F.col("short"))).select("needle", "hay")


@cache
def _uneven() -> str:
    """The characters (but ß) that are several in upper case, which Arrow leaves as they are, and the iota below, a mark
    that becomes a letter."""
    return "[\u0345" + "".join(c for c in map(chr, range(sys.maxunicode + 1)) if len(c.upper()) > 1 and c != "ß") + "]"


def near_options(cells: DataFrame, opts: DataFrame) -> DataFrame:
    """The rows of (.., cell) but for those that surely match no option of (.., label), for ``match_labels`` to look at.

    A cell stays if it has the characters of an option in any spelling, no more characters than the longest option has, or
    one of ``_uneven``. Of more options than ``FEW``, or longer ones, all cells stay."""

    def plain(texts: pa.Array) -> pa.Array:
        """Upper case without any mark, character by character: the same of a text and of its normalised label but for white
        space, if the text has no character of ``_uneven``. It drops more marks than the label does, so more may meet."""
        apart = pc.utf8_normalize(pc.replace_substring(texts, "ß", "SS"), "NFD")
        return pc.utf8_upper(pc.replace_substring_regex(apart, r"\p{M}+", ""))

    found = [r[0] for r in opts.select(normalize_label(F.col("label")).alias("o")).filter("o != ''").distinct().limit(FEW + 1).collect()]
    known = {re.sub(f"{SPACE}+", " ", o) for o in plain(pa.array(found, pa.string())).to_pylist()}
    least = sorted(o for o in known if not any(o != p and p in o for p in known))
    longest = max((len(o.replace(" ", "")) for o in known), default=0)
    if len(found) > FEW or sum(map(len, least)) > BRIEF or longest >= 1000:  # RE2 counts up to 1,000
        return cells
    any_of = "|".join(f"{SPACE}+".join(map(re.escape, o.split(" "))) for o in least) if least else r"[^\x00-\x{10FFFF}]"  # of none, nothing
    more = f"(?:[^{SPACE[1:]}{SPACE}*){{{longest + 1}}}"
    uneven = _uneven()

    @F.arrow_udf("boolean")
    def near(texts: pa.Array) -> pa.Array:
        known = plain(texts)
        held, brief = pc.match_substring_regex(known, any_of), pc.invert(pc.match_substring_regex(known, more))
        return pc.or_(pc.or_(held, brief), pc.match_substring_regex(texts, uneven))

    return cells.filter(near(F.make_valid_utf8("cell")))


def match_labels(cells: DataFrame, opts: DataFrame) -> DataFrame:
    """(dim_index, cell) of the rows -> (dim_index, cell, kind, member_id, ambiguous).

    Only distinct pairs are matched, and pairs and options are stored before. Equal normalised labels come first; for the
    rest, an option inside the label or the label inside an option, the first in option order; an empty label matches
    nothing. ``ambiguous`` counts the options that fitted."""
    wanted = cells.select("dim_index", "cell").distinct().withColumn("n", normalize_label(F.col("cell")))
    # a filter before the storing would go below the distinct and normalise all rows
    wanted = stored(wanted.withColumn("label", F.monotonically_increasing_id())).filter("n != ''")
    opts = stored(opts.select(F.col("dim_index").alias("d"), "offset", "kind", "member_id", normalize_label(F.col("label")).alias("o")).withColumn("option", F.monotonically_increasing_id()))
    exact = wanted.join(opts, (F.col("dim_index") == F.col("d")) & (F.col("n") == F.col("o"))).select("label", "option")
    exact = stored(exact)
    rest = wanted.join(exact.select("label"), "label", "left_anti")
    entries = opts.filter("o != ''")
    if opts.count() <= ONE_BY_ONE:
        held = F.col("n").contains(F.col("o")) | F.col("o").contains(F.col("n"))
        met = [rest.join(F.broadcast(entries), (F.col("dim_index") == F.col("d")) & held).select("label", "option")]
    else:
        rest = stored(rest)
        labels = rest.select(F.col("dim_index").alias("dim"), "label", F.col("n").alias("text"))
        entries = entries.select(F.col("d").alias("dim"), "option", F.col("o").alias("text"))
        inside = contained(entries.withColumnRenamed("option", "needle"), labels.withColumnRenamed("label", "hay")).select(F.col("hay").alias("label"), F.col("needle").alias("option"))
        around = contained(labels.withColumnRenamed("label", "needle"), entries.withColumnRenamed("option", "hay")).select(F.col("needle").alias("label"), F.col("hay").alias("option"))
        met = [inside, around]
    both = reduce(DataFrame.union, met, exact).distinct()
    found = both.join(opts.select("option", "offset", "kind", "member_id"), "option").groupBy("label").agg(F.min_by(F.struct("kind", "member_id"), "offset").alias("m"), F.count("*").alias("ambiguous"))
    return wanted.join(found, "label").select("dim_index", "cell", "m.kind", "m.member_id", "ambiguous")
