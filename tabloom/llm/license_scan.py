"""License scans by diagonal voting, in DataFrame functions only.

Every place of every text gives the hash of its ``K`` words; a join with the hashes of the templates' places turns each hit into a
vote for (document, template, diagonal), where the diagonal is the place in the text less the place in the template. A copy with
nothing inserted or left out is one full diagonal; an inserted word moves the rest to a neighbouring one. Hits are verified by their words
in the join itself, votes are combined map-side as bit masks of template places, and diagonals of a document and template
that are at most ``slack`` apart are merged. A merged span is verified by its length: one that is longer than
half as much again as its template counts as its best single diagonal.

* A phrase is a template that must be met in full on one diagonal: each such diagonal is one place where its words stand.
* The templates are a bounded table (a few thousand places) and broadcast; the text side is never shuffled, only its votes.
* The row of a document itself travels as one more place, so one scan gives both its length and its votes.
* Words are runs of ASCII digits, letters and non-ASCII characters, A-Z lower-cased.

Defined results: null texts have no words; each row is scanned on its own, whatever ids it shares; a text without a hit has no labels
and score 0; an empty table gives an empty one. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.llm.shared import stash

K = 3
CHUNK = 60
SHARE = (6, 10)  # of a template's places, to give its label
MAX_PLACES = 200_000


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False


#: the words and labels of the contract
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
#: public license texts and notices
NOTICES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    Template(
        "apache-2",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        'obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, '
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3."),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
)
TEMPLATES = PHRASES + NOTICES
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text. ``lower`` maps one character outside A-Z to an ASCII letter, the Kelvin sign; it is replaced by another
    non-ASCII letter first. No other mapping of ``lower`` can make a word equal to an ASCII one."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))


def _gram(words: Column, at: Column) -> list[Column]:
    return [F.get(words, at + j) for j in range(K)]


def slack_of(places: Column) -> Column:
    """How far apart diagonals are merged: an eighth of the template, from 1 to 8."""
    return F.greatest(F.lit(1), F.least(F.lit(8), F.floor(places / 8))).cast("int")


def template_places(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """A row per template place: hash and words of its gram, template, place, number of places, chunk and bit of the place."""
    rows = [(k, t.label, t.phrase, t.text) for k, t in enumerate(templates)]
    table = spark.createDataFrame(rows, "tpl int, label string, phrase boolean, text string").withColumn("w", words_of(F.col("text")))
    table = table.withColumn("places", F.size("w") - (K - 1))
    short = [r["text"] for r in table.where("places < 1").select("text").collect()]
    if short:
        raise ValueError(f"templates need {K} words or more: {short}")
    at = table.select("tpl", "label", "phrase", "w", "places", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("tpos"))
    gram = _gram(F.col("w"), F.col("tpos"))
    out = at.select(
        F.xxhash64(*gram).alias("h"), F.concat_ws(" ", *gram).alias("gram"), "tpl", "label", "phrase", "places", "tpos",
        F.floor(F.col("tpos") / CHUNK).cast("int").alias("chunk"), F.expr(f"shiftleft(1L, tpos % {CHUNK})").alias("bit"),
    )
    n = out.count()
    if n > MAX_PLACES:
        raise ValueError(f"{n} template places; a scan takes at most {MAX_PLACES}")
    return out


def votes(docs: DataFrame, places: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """Votes per (row, template, diagonal, chunk) as a mask of template places; each row has one without template that
    carries its id and number of words."""
    rows = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("n", F.size("w"))
    at = rows.select("row", "id", "n", "w", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("pos"))
    gram = _gram(F.col("w"), F.col("pos"))
    whole = F.col("pos") <= F.col("n") - K
    mark = F.col("pos") == F.col("n")
    hashed = at.withColumn("h0", F.when(whole, F.xxhash64(*gram)))
    hit = hashed.join(F.broadcast(places.withColumnRenamed("h", "_h")), (F.col("h0") == F.col("_h")) & (F.concat_ws(" ", *gram) == F.col("gram")), "left")
    own = F.when(mark, F.col("id"))
    return (
        hit.where(mark | F.col("tpl").isNotNull())
        .select(
            "row", "tpl", "places", "chunk", "bit", (F.col("pos") - F.col("tpos")).alias("diag"),
            own.alias("id"), F.when(mark, F.col("n")).alias("n"),
        )
        .groupBy("row", "tpl", "places", "diag", "chunk")
        .agg(F.bit_or("bit").alias("mask"), F.max("id").alias("id"), F.max("n").alias("n"))
    )


def spans(found: DataFrame) -> DataFrame:
    """Neighbouring diagonals merged: a row per (row, template, region) with its matched places, the same of its best
    diagonal, first and last diagonal, and whether a diagonal is full."""
    one = found.where("tpl is not null").withColumn("v", F.bit_count("mask"))
    along = Window.partitionBy("row", "tpl").orderBy("diag", "chunk")
    new = F.coalesce(F.col("diag") - F.lag("diag").over(along) > slack_of(F.col("places")), F.lit(True))
    one = one.withColumn("new", new.cast("int"))
    one = one.withColumn("region", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    diagonal = one.groupBy("row", "tpl", "places", "region", "diag").agg(F.sum("v").alias("v"))
    whole = diagonal.groupBy("row", "tpl", "places", "region").agg(
        F.max("v").alias("best"), F.min("diag").alias("low"), F.max("diag").alias("high"),
        F.count(F.when(F.col("v") == F.col("places"), 1)).alias("full"),
        F.min(F.when(F.col("v") == F.col("places"), F.col("diag"))).alias("first_full"),
        F.max(F.when(F.col("v") == F.col("places"), F.col("diag"))).alias("last_full"),
    )
    union = one.groupBy("row", "tpl", "places", "region", "chunk").agg(F.bit_or("mask").alias("mask"))
    union = union.groupBy("row", "tpl", "places", "region").agg(F.sum(F.bit_count("mask")).alias("union"))
    narrow = F.col("high") - F.col("low") <= F.floor((F.col("places") + K - 1) / 2)
    merged = whole.join(union, ["row", "tpl", "places", "region"])
    return merged.withColumn("matched", F.when(narrow, F.col("union")).otherwise(F.col("best")))


def scan(docs: DataFrame, *, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_words, n_base (places of all phrases), first_word, last_word, base_labels and labels
    (sorted arrays), score (largest share of a template's places that a verified span holds)."""
    spark = docs.sparkSession
    found = stash(votes(docs, template_places(spark, templates), id_col=id_col, text_col=text_col), "lic-votes")
    names = F.create_map(*[x for k, t in enumerate(templates) for x in (F.lit(k), F.lit(t.label))])
    phrase = F.col("tpl").isin([k for k, t in enumerate(templates) if t.phrase])
    enough = F.col("matched") * SHARE[1] >= F.col("places") * SHARE[0]
    label = F.element_at(names, F.col("tpl"))
    count = lambda c: F.when(phrase, F.col(c))
    verified = spans(found).select(
        "row", count("full").alias("full"), count("first_full").alias("first"), count("last_full").alias("last"),
        F.when(phrase & (F.col("full") > 0), label).alias("base"),
        F.when(F.when(phrase, F.col("full") > 0).otherwise(enough), label).alias("label"),
        F.when(phrase, F.when(F.col("full") > 0, 1.0).otherwise(0.0)).otherwise(F.col("matched") / F.col("places")).alias("share"),
        F.lit(None).cast(found.schema["id"].dataType).alias("id"), F.lit(None).cast("int").alias("n"),
    )
    rows = found.where("tpl is null").select(
        "row", *[F.lit(None).cast("bigint").alias(c) for c in ("full", "first", "last")], *[F.lit(None).cast("string").alias(c) for c in ("base", "label")],
        F.lit(None).cast("double").alias("share"), "id", "n",
    )
    out = verified.unionByName(rows).groupBy("row").agg(
        F.max("id").alias(id_col), F.max("n").cast("bigint").alias("n_words"), F.coalesce(F.sum("full"), F.lit(0)).cast("bigint").alias("n_base"),
        F.min("first").cast("bigint").alias("first_word"), F.max("last").cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set("base")).alias("base_labels"), F.array_sort(F.collect_set("label")).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    return out.drop("row")
