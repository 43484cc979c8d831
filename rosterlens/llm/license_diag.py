"""Licence scan by diagonal voting.

All rolling k-word hashes of a text meet the positions of those hashes in licence
templates; each meeting votes for the diagonal (text position - template position).
Neighbouring diagonals of one template merge, so that a few inserted or missing words
don't split a passage. A merged span is verified: of its meetings the longest chain that
goes forward both in the text and in the template must cover enough of the template, so
the template's words in another order are no passage of it. Only the templates' own grams
can meet anything, so a task keeps the text grams that lie in that fixed set before rows
leave it; the join is with a table of a few hundred rows, broadcast (its size is that of
TEMPLATES, not of the data).

Null texts count as empty: no words, no labels, score 0. Repeated rows get a row each, a
null doc_id stays null. Other columns, whatever their names, are not read; an empty table
gives no rows. Texts of any length are scanned whole, in memory proportional to the
longest; of spans of one label the best covered gives the score.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import Words, slices
from .store import materialise, table

# Phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notice texts of public licences, (label, text).
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means"),
)

_SCAN = "doc_id long, row long, n_words long, n_base long, first_word long, last_word long, base array<string>, hits array<struct<pos:int,gram:long>>"


def _hashes(text: str, k: int | None = None) -> np.ndarray:
    (_, _, data, off), *_ = slices(pa.array([text]))
    w = Words(data, off)
    return w.grams(k or len(w.hash))[1]


def template_table(spark: SparkSession, k: int, templates=TEMPLATES) -> DataFrame:
    """(template, label, t_grams, tpos, gram) of every k-gram of every template."""
    rows = []
    for i, (label, text) in enumerate(templates):
        grams = _hashes(text, k).view(np.int64)
        rows += [(i, label, len(grams), p, int(g)) for p, g in enumerate(grams)]
    return spark.createDataFrame(rows, "template int, label string, t_grams int, tpos int, gram long")


def scan(docs: DataFrame, k: int = 3, templates=TEMPLATES) -> DataFrame:
    """Words, base phrases and template grams of each text of ``docs(doc_id, text)``; ``row`` is a content hash."""
    known = np.unique(np.concatenate([_hashes(text, k) for _, text in templates]))
    phrases = [(_hashes(p)[0], len(p.split()), label) for p, label in PHRASES.items()]

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base", pa.list_(pa.string())), ("hits", pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64())])))])
        for batch in batches:
            ids = batch.column(0)
            for i, j, data, off in slices(batch.column(1)):
                w = Words(data, off)
                n = j - i
                count, low, high = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
                labels: list[list[str]] = [[] for _ in range(n)]
                doc = w.doc()
                by_size = {size: w.grams(size) for size in {s for _, s, _ in phrases}}
                for h, size, label in phrases:
                    at, g = by_size[size]
                    for p in at[g == h]:
                        d = doc[p]
                        q = p - w.first[d]
                        count[d] += 1
                        low[d] = q if low[d] < 0 else min(low[d], q)
                        high[d] = max(high[d], q)
                        if label not in labels[d]:
                            labels[d].append(label)
                at, g = by_size[k] if k in by_size else w.grams(k)
                near = np.minimum(np.searchsorted(known, g), len(known) - 1)
                at, g = at[known[near] == g], g[known[near] == g]
                d = doc[at] if len(at) else np.zeros(0, np.int64)
                hits = pa.StructArray.from_arrays([pa.array((at - w.first[d]).astype(np.int32)), pa.array(g.view(np.int64))], ["pos", "gram"])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, n), pa.array(w.content()[0].view(np.int64)), pa.array(np.diff(w.first)), pa.array(count), pa.array(low, mask=low < 0), pa.array(high, mask=high < 0), pa.array(labels, pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(np.searchsorted(d, np.arange(n + 1)).astype(np.int32)), hits)],
                    schema=schema,
                )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, _SCAN)


def chain(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of (text position, template position) that ascends strictly in both."""
    ends: list[int] = []  # smallest template position that ends a run of each length
    last: list[int] = []
    before: list[int | None] = []
    hits = sorted(hits, key=lambda h: (h[0], -h[1]))
    for i, (_, t) in enumerate(hits):
        n = bisect_left(ends, t)
        before.append(last[n - 1] if n else None)
        ends[n : n + 1], last[n : n + 1] = [t], [i]
    out, i = [], last[-1] if last else None
    while i is not None:
        out.append(hits[i])
        i = before[i]
    return out[::-1]


def verified(candidates: DataFrame, k: int, least: float) -> DataFrame:
    """Spans of ``candidates(row, label, template, t_grams, hits)`` whose longest chain covers at least ``least`` of the template; first and last are the chain's."""
    schema = pa.schema([("row", pa.int64()), ("label", pa.string()), ("template", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("coverage", pa.float64())])

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                best = chain([(h["pos"], h["tpos"]) for h in r["hits"]])
                if len(best) >= least * r["t_grams"]:
                    rows.append({"row": r["row"], "label": r["label"], "template": r["template"], "first": best[0][0], "last": best[-1][0] + k - 1, "coverage": len(best) / r["t_grams"]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return candidates.select("row", "label", "template", "t_grams", "hits").mapInArrow(run, "row long, label string, template int, first int, last int, coverage double")


def spans(scanned: DataFrame, k: int = 3, templates=TEMPLATES, slack: int = 3, least: float = 0.75) -> DataFrame:
    """Verified licence spans: row, label, template, first, last (words), coverage.

    Votes are counted for each (row, template, diagonal); diagonals of one template that
    lie within ``slack`` of the one before form one span, wherever they lie in the text. A span
    stands if grams met in order make up at least ``least`` of the template's; those that
    meet fewer in any order are left out first.
    """
    votes = (
        scanned.filter(F.size("hits") > 0)
        .select("row", F.explode("hits").alias("hit"))
        .select("row", "hit.pos", "hit.gram")
        .distinct()  # equal texts meet the templates once
        .join(F.broadcast(template_table(scanned.sparkSession, k, templates)), "gram")
        .withColumn("diagonal", F.col("pos") - F.col("tpos"))
    )
    diagonals = votes.groupBy("row", "template", "label", "t_grams", "diagonal").agg(F.collect_set("tpos").alias("met"))
    by = "partition by row, template order by diagonal"
    merged = diagonals.withColumn("far", F.expr(f"coalesce(diagonal - lag(diagonal) over ({by}) > {slack}, true)")).withColumn(
        "island", F.expr(f"sum(cast(far as int)) over ({by} rows between unbounded preceding and current row)")
    )
    met = F.expr("transform(met, t -> struct(diagonal + t as pos, t as tpos))")
    candidates = (
        merged.groupBy("row", "template", "label", "t_grams", "island")
        .agg(F.flatten(F.collect_list(met)).alias("hits"))
        .filter(F.size(F.array_distinct("hits.tpos")) >= least * F.col("t_grams"))
    )
    return verified(candidates, k, least)


def license_scan(docs: DataFrame, k: int = 3) -> DataFrame:
    """One row per text: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    scanned = materialise(scan(docs, k))
    found = spans(scanned, k).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage"))
    out = scanned.drop("hits").join(found, "row", "left")
    none = F.array().cast(T.ArrayType(T.StringType()))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(F.coalesce("coverage", F.lit(0.0)), F.lit(1.0))).alias("score"),
    )


def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
