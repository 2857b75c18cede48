"""License scan with DataFrame functions only.

Texts become words (lower case, letters and digits), words become hashed
5-word shingles. Windows of shingles that overlap by half are MinHashed; every
MinHash is a band of one row, so a window and a template chunk of Jaccard
similarity J collide in one of ``bands`` bands with probability
1 - (1 - J) ** bands. Templates (their chunks of a window class's size) that
collide with some window of a document are retrieved, and a match needs the
exact containment of the template's shingles in the document to reach
``containment``.

A window is twice as long as the chunks of its class and starts every chunk
length, so a chunk's passage lies whole in some window: J is at least
containment * smallest chunk / window, which ``least_collision`` turns into the
guaranteed probability (checked when templates are loaded).

Documents without a single template shingle can't contain a template; they
are told by one array comparison and not windowed. One row holds one document,
nothing is shuffled.

Defined results: null texts and texts of fewer than five words match nothing;
repeated rows match each; a document may match several templates; an empty
table gives an empty result.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScanSettings:
    shingle_words: int = 5
    containment: float = 0.8
    bands: int = 32
    chunks: tuple[int, ...] = (2, 8, 16)  # chunk sizes in shingles; windows are twice as long
    least: float = 0.99  # collision probability that every template must reach
    seed: int = 11


# Notices by which licences are known, as their licensors word them.
TEMPLATES = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."),
    ("LGPL", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
]

NOT_WORD = r"[^\p{L}\p{N}]+"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once: a lambda over one element,
    which no optimizer rule copies into its uses."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def shingles(of_words: Column, n: int) -> Column:
    """The hash of every run of n words, in order."""
    none = F.array().cast("array<bigint>")
    runs = lambda w: F.transform(
        F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(n)])
    )
    return let(of_words, lambda w: F.when(F.size(w) >= n, runs(w)).otherwise(none))


def masks(settings: ScanSettings) -> list[int]:
    """One permutation of the hash space per band: exclusive or with a mask."""
    rng = random.Random(settings.seed)
    return [rng.getrandbits(64) - (1 << 63) for _ in range(settings.bands)]


def bands(window: Column, settings: ScanSettings) -> Column:
    """The band values of a window: each permutation's least hash, told apart
    by the permutation."""
    return F.transform(
        F.lit(masks(settings)), lambda m: F.xxhash64(m, F.array_min(F.transform(window, lambda h: h.bitwiseXOR(m))))
    )


def window_bands(hashes: Column, chunk: int, settings: ScanSettings) -> Column:
    """The band values of all windows of a class, as one array."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(hashes), F.lit(1)), F.lit(chunk))
    return F.flatten(F.transform(starts, lambda s: bands(F.slice(hashes, s, 2 * chunk), settings)))


def chunk_of(n_shingles: int, settings: ScanSettings) -> int:
    """The class of a template: the smallest chunk that holds it, else the
    largest, of which it then has several."""
    return next((c for c in settings.chunks if n_shingles <= c), settings.chunks[-1])


def least_collision(n_shingles: int, settings: ScanSettings) -> float:
    """The least probability that a document with ``containment`` of a
    template in one passage retrieves it."""
    chunk = chunk_of(n_shingles, settings)
    shared = max(1.0, settings.containment * min(n_shingles, chunk))
    return 1 - (1 - shared / (2 * chunk)) ** settings.bands


def load_templates(spark: SparkSession, templates, settings: ScanSettings) -> list[dict]:
    """The templates with their shingles and band values, made by the same
    expressions as the documents'; one row per template, so small."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    frame = spark.createDataFrame(rows, "template int, license string, text string")
    hashed = frame.select("template", "license", shingles(words(F.col("text")), settings.shingle_words).alias("s"))
    out = []
    for row in hashed.orderBy("template").collect():
        if not row["s"]:
            raise ValueError(f"template {row['template']} has fewer than {settings.shingle_words} words")
        n = len(row["s"])
        if least_collision(n, settings) < settings.least:
            raise ValueError(f"template {row['template']} collides too seldom; take more bands")
        out.append({"template": row["template"], "license": row["license"], "hashes": sorted(set(row["s"])),
                    "chunk": chunk_of(n, settings), "order": list(row["s"])})
    parts = []
    for t in out:
        c = t["chunk"]
        starts = [*range(0, max(1, len(t["order"]) - c), c), max(0, len(t["order"]) - c)]
        parts += [(t["template"], t["order"][s : s + c]) for s in sorted(set(starts))]
    chunks = spark.createDataFrame(parts, "template int, part array<bigint>")
    found = chunks.select("template", bands(F.col("part"), settings).alias("b")).collect()
    for t in out:
        t["bands"] = sorted({b for r in found if r["template"] == t["template"] for b in r["b"]})
    return out


def _long_array(values: list[int]) -> Column:
    return F.lit(values).cast("array<bigint>")


def scan(docs: DataFrame, templates=TEMPLATES, settings: ScanSettings = ScanSettings()) -> DataFrame:
    """doc_id, template (its number), license, n_shared and containment of
    every match."""
    loaded = load_templates(docs.sparkSession, templates, settings)
    every = _long_array(sorted({h for t in loaded for h in t["hashes"]}))
    known = F.array(*[
        F.struct(
            F.lit(t["template"]).alias("template"), F.lit(t["license"]).alias("license"),
            _long_array(t["hashes"]).alias("hashes"), _long_array(t["bands"]).alias("bands"), F.lit(t["chunk"]).alias("chunk"),
        )
        for t in loaded
    ])
    match = "array<struct<template:int,license:string,n_shared:int,containment:double>>"

    def verified(hashes: Column, t: Column) -> Column:
        return let(
            F.size(F.array_intersect(t["hashes"], hashes)),
            lambda n: F.struct(
                t["template"].alias("template"), t["license"].alias("license"), n.alias("n_shared"),
                (n / F.size(t["hashes"])).alias("containment"),
            ),
        )

    def retrieved_by(chunk: int, hashes: Column) -> Column:
        return let(
            window_bands(hashes, chunk, settings),
            lambda b: F.filter(known, lambda t: (t["chunk"] == chunk) & F.arrays_overlap(t["bands"], b)),
        )

    def matches(hashes: Column) -> Column:
        retrieved = F.concat(*[retrieved_by(c, hashes) for c in sorted({t["chunk"] for t in loaded})])
        return F.filter(
            F.transform(retrieved, lambda t: verified(hashes, t)), lambda m: m["containment"] >= settings.containment
        )

    found = let(
        shingles(words(F.col("text")), settings.shingle_words),
        lambda s: F.when(F.arrays_overlap(s, every), matches(s)).otherwise(F.array().cast(match)),
    )
    return docs.where("text is not null").select("doc_id", F.inline(found))


def sql(templates=TEMPLATES) -> str:
    """DuckDB SQL for ``scan`` by exact containment alone."""
    quoted = [(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(templates)]
    values = ",\n  ".join(f"({i}, '{name}', '{text}')" for i, name, text in quoted)
    split = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    grams = """select distinct {key}, array_to_string(w[i : i + 4], ' ') as g
  from (select {key}, w, unnest(range(1, len(w) - 3)) as i from {source} where len(w) >= 5)"""
    return f"""
with t as (select template, license, {split} as w from (values
  {values}) as v(template, license, text)),
d as (select row_number() over () as rid, doc_id, {split} as w from documents where text is not null),
tg as ({grams.format(key="template", source="t")}),
dg as ({grams.format(key="rid", source="d")}),
n as (select template, count(*) as n from tg group by template),
shared as (select rid, template, count(*) as s from tg join dg using (g) group by rid, template)
select doc_id, cast(template as integer) as template, license, cast(s as integer) as n_shared,
  round(s / n, 6) as containment
from shared join n using (template) join t using (template) join d using (rid) where s / n >= 0.8
"""
