"""Licence scan by a positional rare-token index, with DataFrame functions only.

A template is the wording of a licence notice with a mandatory key phrase inside. The index maps each template
word to its postings: the templates that have it in their key phrase, and how far before the word the phrase
starts. Document frequencies of the template words over the whole corpus (one counter per word, so what reaches
the driver is bounded by the templates) give their IDF.

A file's words are read once. Its licence words of highest IDF, down to the floor, are looked up in the index:
the floor is the lowest IDF that the two rarest words of every key phrase reach, so each place of a phrase
holds two looked-up words at least and none is lost. Every looked-up word votes, by its postings, for (template,
start of the phrase); the votes are sorted, and those that two words agree on are intersections of postings by
relative position. The phrase is then verified word by word there. A file's cost follows its own licence words
and not the number of templates.

The score of a place is the share of the template's IDF mass that stands at the right relative places; a
file's score is its best place's, 0 without one (rounded to 6 digits). Null, empty and wordless texts have
no words and no labels. Words of equal IDF are looked up alike. Repeated rows get equal results; an empty table
gives an empty one, and where no file has a template word all labels are empty. Texts are read whole; a row's
words must fit in memory. Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import LOWER, UPPER, lower_ascii, quoted, table

#: Runs of these separate words (A-Z are lower-cased before).
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Fixed values: (label, wording of a notice as words, key phrase, whether it counts for the base columns).
TEMPLATES = [
    ("mit", "released under the mit license", "under the mit license", True),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2", True),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc", True),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "you may not use this file except in compliance with the license", False),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "free of charge to any person obtaining a copy of this software", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms", False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby granted", False),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "will the authors be held liable", False),
    ("gpl", "this work is licensed under the gnu general public license version", "gnu general public license", False),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "terms of the gnu general public license as published", False),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license", False),
    ("agpl", "licensed under the gnu affero general public license version", "gnu affero general public license", False),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license", False),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license", False),
    ("bsl", "distributed under the boost software license version 1 0", "boost software license", False),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain", False),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa", False),
    ("cc-by-nd", "licensed under cc by nd", "cc by nd", False),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0 international", False),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal", False),
    ("reserved", "copyright all rights reserved", "all rights reserved", False),
]


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(lower_ascii(text), GAPS), lambda w: w != "")


def idf(words: DataFrame) -> dict[str, float]:
    """ln((files + 1) / (files with the word + 1)) of each template word, over all files; ``words`` has a column words."""
    vocabulary = sorted({w for _, notice, _, _ in TEMPLATES for w in notice.split()})
    hits = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    found = words.select(F.explode(F.concat(F.array(F.lit("")), hits)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    rows = found.select("w", "n").collect()  # at most one row per template word, and "" for the number of files
    n = {r["w"]: r["n"] for r in rows}
    logs = found.sparkSession.createDataFrame([(w, n.get("", 0), n.get(w, 0)) for w in vocabulary], "w string, files long, n long")
    return {r["w"]: r["idf"] for r in logs.select("w", F.log((F.col("files") + 1) / (F.col("n") + 1)).alias("idf")).collect()}


def index(weights: dict[str, float]) -> dict[str, list[tuple[int, int]]]:
    """Postings (template, place in its key phrase) of every word at or above the floor."""
    phrases = [phrase.split() for _, _, phrase, _ in TEMPLATES]
    floor = min(sorted(weights[w] for w in p)[-2] for p in phrases)
    found: dict[str, list[tuple[int, int]]] = {}
    for t, p in enumerate(phrases):
        for k, w in enumerate(p):
            if weights[w] >= floor:
                found.setdefault(w, []).append((t, k))
    return found


def _pair(template: Column, start: Column) -> Column:
    """A vote as one number, which sorts by template and start."""
    return F.shiftleft(template.cast("long"), 32).bitwiseOR(start.cast("long"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: identifier, n_words, n_base, first_word, last_word, base_labels, labels, score and
    places (label, first word) of all verified key phrases; ``keep`` names further columns to carry along."""
    words = df.select(quoted(id_col).alias("id"), words_of(quoted(text_col)).alias("words"), *[quoted(c).alias(f"own_{k}") for k, c in enumerate(keep)])
    weights = idf(words)
    postings = index(weights)
    own = [f"own_{k}" for k in range(len(keep))]
    looked_up = sorted(postings)
    hits = words.select("id", "words", F.filter(F.transform("words", lambda w, i: F.when(w.isin(looked_up), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull()).alias("hits"), *own)
    table_of = F.create_map(*[c for w in looked_up for c in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for t, k in postings[w]]))])
    given = F.flatten(F.transform("hits", lambda h: F.transform(F.filter(F.element_at(table_of, h["w"]), lambda p: p["k"] <= h["i"]), lambda p: _pair(p["t"], h["i"] - p["k"]))))
    votes = hits.select("id", "words", F.when(F.size("hits") > 1, F.array_sort(given)).otherwise(F.array().cast("array<long>")).alias("votes"), *own)
    # sorted, so a vote that equals the one before it stands for a second word
    agreed = F.array_distinct(F.filter("votes", lambda v, n: v == F.get("votes", n - 1)))
    phrases = F.array(*[F.array(*map(F.lit, phrase.split())) for _, _, phrase, _ in TEMPLATES])

    def template(v: Column) -> Column:
        return F.shiftright(v, 32).cast("int")

    def start(v: Column) -> Column:
        return v.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")

    stated = lambda v: F.get(phrases, template(v))
    agreed = votes.select("id", "words", F.when(F.size("votes") > 1, agreed).otherwise(F.array().cast("array<long>")).alias("agreed"), *own)
    found = agreed.select("id", "words", F.filter("agreed", lambda v: F.slice("words", start(v) + 1, F.size(stated(v))) == stated(v)).alias("found"), *own)

    leads, masses = [], []
    for _, notice, phrase, _ in TEMPLATES:
        n, p = notice.split(), phrase.split()
        leads.append(next(k for k in range(len(n)) if n[k : k + len(p)] == p))
        masses.append(reduce(lambda a, w: a + weights[w], n, 0.0))
    notices = F.array(*[F.array(*[F.struct(F.lit(w).alias("w"), F.lit(float(weights[w])).alias("x"), F.lit(k - lead).alias("k")) for k, w in enumerate(notice.split())]) for (_, notice, _, _), lead in zip(TEMPLATES, leads, strict=True)])

    def share(v: Column) -> Column:
        met = F.aggregate(F.get(notices, template(v)), F.lit(0.0), lambda a, x: a + F.when(F.get("words", start(v) + x["k"]) == x["w"], x["x"]).otherwise(0.0))
        mass = F.get(F.array(*map(F.lit, masses)), template(v))
        return F.when(mass > 0, met / mass).otherwise(1.0)

    based = [n for n, t in enumerate(TEMPLATES) if t[3]]
    names = F.array(*[F.lit(label) for label, _, _, _ in TEMPLATES])
    placed = found.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.transform("found", lambda v: F.struct(F.get(names, template(v)).alias("label"), start(v).alias("word"))).alias("places"),
        F.transform(F.filter("found", lambda v: template(v).isin(based)), lambda v: F.struct(F.get(names, template(v)).alias("label"), start(v).alias("word"))).alias("base"),
        F.when(F.size("found") > 0, F.array_max(F.transform("found", share))).alias("best"),
        *own,
    )

    def labels(places: str) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))))

    return placed.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["word"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["word"])).cast("long").alias("last_word"),
        labels("base").alias("base_labels"),
        labels("places").alias("labels"),
        F.round(F.coalesce("best", F.lit(0.0)), 6).alias("score"),
        "places",
        *[F.col(o).alias(c) for o, c in zip(own, keep, strict=True)],
    )


def op8_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("places")


def _oracle() -> str:
    rows = []
    for n, (label, notice, phrase, base) in enumerate(TEMPLATES):
        s, p = notice.split(), phrase.split()
        lead = next(k for k in range(len(s)) if s[k : k + len(p)] == p)
        rows.append(f"({n}, '{label}', {s!r}, {p!r}, {lead}, {str(base).lower()})")
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
  FROM documents
), templates(n, label, sentence, phrase, lead, base) AS (VALUES {", ".join(rows)}),
vocabulary AS (SELECT DISTINCT unnest(sentence) AS w FROM templates),
idf AS (
  SELECT w, ln(((SELECT count(*) FROM docs) + 1) / ((SELECT count(*) FROM docs WHERE list_contains(words, w)) + 1)) AS idf FROM vocabulary
), places AS (
  SELECT r, n, label, base, sentence, lead, words, unnest(list_filter(range(0, len(words)), lambda i: words[i + 1 : i + len(phrase)] = phrase)) AS i
  FROM docs, templates WHERE list_has_all(words, phrase)
), spelled AS (
  SELECT r, n, label, base, i, CASE WHEN i - lead + k >= 1 THEN words[i - lead + k] END AS w, sentence[k] AS wanted
  FROM (SELECT *, unnest(range(1, len(sentence) + 1)) AS k FROM places)
), scored AS (
  SELECT r, n, label, base, i, CASE WHEN sum(idf) > 0 THEN sum(CASE WHEN s.w = wanted THEN idf ELSE 0 END) / sum(idf) ELSE 1 END AS score
  FROM spelled s JOIN idf ON idf.w = wanted GROUP BY r, n, label, base, i
)
SELECT doc_id, len(words)::BIGINT AS n_words,
       coalesce((SELECT count(*) FROM scored s WHERE s.r = d.r AND base), 0) AS n_base,
       (SELECT min(i) FROM scored s WHERE s.r = d.r AND base) AS first_word,
       (SELECT max(i) FROM scored s WHERE s.r = d.r AND base) AS last_word,
       coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM scored s WHERE s.r = d.r AND base), '') AS base_labels,
       coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM scored s WHERE s.r = d.r), '') AS labels,
       round(coalesce((SELECT max(score) FROM scored s WHERE s.r = d.r), 0), 6)::DOUBLE AS score
FROM docs d
"""


ORACLE = _oracle()
