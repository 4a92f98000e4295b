"""License notices in texts: MinHash bands over overlapping windows, then exact containment.

Words are lower-cased runs of letters and digits. Every ``WINDOW`` = 7 consecutive words, that is
three 5-word shingles, are a window; a MinHash per band takes the least of three hashes. Templates
are cut alike, so each of their windows has the same bands as a verbatim window: it collides
with probability 1, in every band. A copy that keeps 0.8 of a template's shingles keeps three
shingles in a row somewhere (one changed word costs four or five neighbouring shingles), hence at
least one verbatim window: no match is lost by the bands. More bands find windows that share one
or two shingles only, with probability 1 - (1 - J) ** BANDS, as start points of edited copies.

Documents whose bands meet no template's bands are done. For the others the windows are joined
with the template windows on (band, value); each meeting proposes a place, and the share of the
template's shingles found there is computed exactly; places of at least 0.8 are matches. Words
put into a copy move its tail away by any distance, so the template's shingles are also followed
through the whole text: a shortest stretch that holds 0.8 of them is a match, overlapping
stretches are one, and the containment is that of the whole of it. All of it is DataFrame functions.

Templates of five or six words are shorter than a window; for them a last band holds windows of
five words, that is single shingles.

Cases: null texts and texts under five words match nothing; a license with several templates reports its best; overlapping matches
of one template count as one place per start. Repeated rows give repeated results.
"""

from pyspark.sql import functions as F

from panelloom.llm.common import computed, small_rows

SHINGLE = 5
WINDOW = 7
BANDS = 3
CONTAINMENT = 0.8
MOST_TEMPLATES = 2000

# fixed values: public notices by licence
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("MIT", "Licensed under the MIT License. See LICENSE"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)


def _words(text):
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), "")


def _prepared(df, text):
    """Add ``__h`` (shingle hashes) and ``__b``: per band the least hash of every window."""
    words = computed(df, "__w", _words(F.col(text))).filter(F.size("__w") >= SHINGLE)
    hashed = computed(words, "__h", F.expr(
        f"transform(sequence(1, size(__w) - {SHINGLE - 1}), i -> xxhash64(slice(__w, i, {SHINGLE})))"))
    span = WINDOW - SHINGLE + 1
    count = f"greatest(size(__h) - {span - 1}, 1)"
    bands = []
    for b in range(BANDS):
        own = "__h[i + {k}]" if b == 0 else f"xxhash64(__h[i + {{k}}], {b})"
        # past the end of a short text there is nothing; least() skips nulls, xxhash64 does not
        cells = [f"if(i + {k} < size(__h), {own.format(k=k)}, null)" if k else own.format(k=k) for k in range(span)]
        bands.append(f"transform(sequence(0, {count} - 1), i -> least({', '.join(cells)}))")
    return computed(hashed, "__b", F.expr(f"array({', '.join(bands)}, __h)"))


def template_windows(spark, templates=TEMPLATES):
    """(license, hs: shingle hashes, band, value, offset) of every window of every template."""
    frame = spark.createDataFrame(list(templates), "license string, template string").distinct()
    return _prepared(frame, "template").select(
        "license", F.array_distinct("__h").alias("hs"), F.size("__h").alias("length"),
        F.posexplode("__b").alias("band", "values")).select(
        "license", "hs", "length", "band", F.posexplode("values").alias("offset", "value")).filter(
        # the last band is for templates shorter than a window
        (F.col("band") == BANDS) == (F.col("length") < WINDOW - SHINGLE + 1))


def _runs(hits, size):
    """SQL: (s, e, c) of the stretches of ``hits`` (i: position, k: number of the shingle, from 1).

    For every end the shortest stretch starts at the ``need``-th latest of the shingles' last
    positions; where that start moves on, the stretch holds no shorter one.
    """
    need = f"cast(ceil({CONTAINMENT} * {size} - 1e-6) as int)"
    step = ("element_at(transform(array(transform(acc.last, (y, j) -> if(j + 1 = x.k, x.i, y))), l -> "
            f"struct(l as last, sort_array(l, false)[{need} - 1] as s)), 1)")
    joined = ("if(size(acc.out) > 0 and try_element_at(acc.out, -1).e >= z.s, "
              "concat(slice(acc.out, 1, size(acc.out) - 1), array(struct(try_element_at(acc.out, -1).s as s, x.i as e))), "
              "concat(acc.out, array(struct(z.s as s, x.i as e))))")
    moved = ("element_at(transform(array(" + step + "), z -> struct(z.last as last, greatest(z.s, acc.prev) as prev, "
             f"if(z.s > acc.prev, {joined}, acc.out) as out)), 1)")
    spans = (f"aggregate({hits}, struct(array_repeat(-1, {size}) as last, -1 as prev, "
             f"cast(array() as array<struct<s:int,e:int>>) as out), (acc, x) -> {moved}, acc -> acc.out)")
    share = f"size(array_distinct(transform(filter({hits}, h -> h.i between r.s and r.e), h -> h.k))) / {size}"
    return (f"if(size({hits}) >= {need}, transform({spans}, r -> struct(r.s as s, r.e as e, {share} as c)), "
            "cast(array() as array<struct<s:int,e:int,c:double>>))")


def scan(df, text="text", keys=("doc_id",), templates=TEMPLATES):
    """Matches: ``keys``, ``license``, ``start`` (word), ``containment``, one row per place."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates")
    windows = template_windows(df.sparkSession, templates)
    rows = small_rows(windows.select("license", "hs", "length", "band", "offset", "value"), MOST_TEMPLATES * 1000)
    table = df.sparkSession.createDataFrame(rows, windows.select("license", "hs", "length", "band", "offset", "value").schema)
    known = F.array(*[F.array(*[F.lit(v) for v in sorted({r["value"] for r in rows if r["band"] == b})]).cast("array<bigint>")
                      for b in range(BANDS + 1)])
    frame = df.select(*[f"`{k}`" for k in keys], F.col(text).alias("__text")).withColumn("__row", F.monotonically_increasing_id())
    meets = F.lit(False)
    for b in range(BANDS + 1):
        meets = meets | F.arrays_overlap(F.col("__b")[b], known[b])
    near = _prepared(frame, "__text").filter(meets).select(*[f"`{k}`" for k in keys], "__row", "__h", F.posexplode("__b").alias("band", "values"))
    inside = near.withColumn("__k", known).select(
        *[f"`{k}`" for k in keys], "__row", "__h", "band",
        F.inline(F.expr("filter(transform(values, (v, i) -> struct(i as at, v as value)), "
                        "x -> array_contains(__k[band], x.value))")))
    placed = inside.join(F.broadcast(table), ["band", "value"]).withColumn("start", F.col("at") - F.col("offset"))
    one = placed.groupBy("__row", "license", "hs").agg(
        *[F.first(f"`{k}`").alias(k) for k in keys], F.first("__h").alias("__h"), F.first("length").alias("length"),
        F.collect_set("start").alias("starts"))
    near = one.withColumn("near", F.expr(
        "filter(transform(starts, s -> struct(s as start, size(array_intersect(slice(__h, greatest(s, 0) + 1, "
        "length + least(s, 0) + 2), hs)) / size(hs) as containment)), x -> x.containment >= " + str(CONTAINMENT) + ")"))
    hits = computed(near, "hits", F.expr(
        "filter(transform(__h, (v, i) -> struct(i as i, array_position(hs, v) as k)), x -> x.k > 0)")).drop("__h")
    runs = computed(hits, "runs", F.expr(_runs("hits", "size(hs)")))
    meet = "r.s <= x.start + length + 2 and r.e >= x.start"
    found = runs.select(*[f"`{k}`" for k in keys], "license", F.inline(F.expr(
        "concat(transform(near, x -> struct(x.start as start, greatest(x.containment, coalesce(array_max(transform("
        f"filter(runs, r -> {meet}), r -> r.c)), 0.0D)) as containment)), "
        f"transform(filter(runs, r -> not exists(near, x -> {meet})), r -> struct(r.s as start, r.c as containment)))")))
    return found.select(*[f"`{k}`" for k in keys], "license", F.greatest("start", F.lit(0)).alias("start"), "containment")
