"""License scans: MinHash bands over text windows retrieve templates, shingles verify them.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased. A
window is six words, two five-word shingles, and windows start at every second word of a
document and at every word of a template; so any stretch of a template that a document
repeats has windows in common with it, and one shared shingle gives a similarity of a third
at least. Each of ``BANDS`` = 40 bands is one universal minimum, so a window with two equal
shingles collides for certain, one of a five-word template in it with
``1 - (1/2)**40``, and one that shares a single shingle of three with ``1 - (2/3)**40``, all
but one in ten million.

Retrieved templates are verified by containment: at least ``percent`` of the distinct
shingles of the template lie in the words around the window, and so do all phrases it needs
(version, lesser or affero, nc or sa), which tell it from notices that differ in a word. Of the
templates verified at a window the best contained counts, of those the one with more shingles.
Only DataFrame functions are used; documents are not shuffled, only the windows that retrieve a
template are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eocube.llm.tables import ascii_lower

SHINGLE_WORDS = 5
WINDOW_WORDS = 6
STRIDE = 2
BANDS = 40
BROADCAST_WORDS = 200_000

# Notices by license, with the phrases (lower-case words) that tell them from other licenses.
_NAMED = {
    "Apache-1.1": ("the Apache Software License, Version 1.1", "the Apache License, Version 1.1"),
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache License v2.0", "the Apache 2.0 License", "version 2.0 of the Apache License"),
    "MIT": ("the MIT License", "an MIT license", "a MIT license", "the Expat License"),
    "ISC": ("the ISC License", "an ISC license"),
    "BSD": ("the BSD License", "a BSD license"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-clause BSD license", "the two-clause BSD license", "the Simplified BSD License", "a 2-clause BSD license"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-clause BSD license", "the three-clause BSD license", "the New BSD License", "the Modified BSD License", "a 3-clause BSD license"),
    "BSD-4-Clause": ("the BSD 4-Clause License", "the 4-clause BSD license", "the Original BSD License"),
    "0BSD": ("the BSD Zero Clause License", "the Zero-Clause BSD license"),
    "MPL-1.1": ("the Mozilla Public License, version 1.1", "the Mozilla Public License 1.1"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "the Mozilla Public License, v. 2.0", "the Mozilla Public License v2.0"),
    "EPL-1.0": ("the Eclipse Public License, version 1.0", "the Eclipse Public License 1.0", "the Eclipse Public License v1.0", "the Eclipse Public License - v 1.0"),
    "EPL-2.0": ("the Eclipse Public License, version 2.0", "the Eclipse Public License 2.0", "the Eclipse Public License v2.0", "the Eclipse Public License - v 2.0"),
    "EUPL-1.2": ("the European Union Public Licence, version 1.2", "the European Union Public License, version 1.2", "the EUPL, version 1.2"),
    "BSL-1.0": ("the Boost Software License, Version 1.0", "the Boost Software License 1.0"),
    "Artistic-2.0": ("the Artistic License 2.0", "the Artistic License, version 2.0"),
    "Zlib": ("the zlib License", "the zlib/libpng license"),
    "Unlicense": ("the Unlicense license",),
    "CC0-1.0": ("CC0 1.0", "the CC0 1.0 license", "a CC0 1.0 license", "the Creative Commons Zero v1.0", "the Creative Commons CC0 1.0", "a Creative Commons CC0 1.0"),
    "ODbL-1.0": ("the Open Database License", "the Open Data Commons Open Database License"),
    "GFDL-1.2": ("the GNU Free Documentation License, Version 1.2",),
    "GFDL-1.3": ("the GNU Free Documentation License, Version 1.3",),
}
_GNU = {
    "GPL-1.0": ("", "GPL", "1"), "GPL-2.0": ("", "GPL", "2"), "GPL-3.0": ("", "GPL", "3"),
    "LGPL-2.0": ("Library ", "LGPL", "2"), "LGPL-2.1": ("Lesser ", "LGPL", "2.1"), "LGPL-3.0": ("Lesser ", "LGPL", "3"),
    "AGPL-3.0": ("Affero ", "AGPL", "3"),
}
_CC = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
# a shingle of lead and name has a word of the name: "under the terms of the" would retrieve all
_LEADS = (
    "Licensed under {}", "Released under {}", "Distributed under {}", "Published under {}", "Available under {}",
    "Provided under {}", "the terms of {}", "the conditions of {}",
)
_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution."
)
_FREE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
    "as published by the Free Software Foundation, either version {}"
)
_TEXTS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache license version 2 0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "apache license version 2 0"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-1.0", _FREE.format("", "1, or (at your option) any later version"), "gnu general public license", "version 1 or at your option"),
    ("LGPL-2.0", _FREE.format("Lesser ", "2 of the License"), "gnu lesser general public license", "version 2 of the license"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", f"{_BINARY} THIS SOFTWARE IS PROVIDED BY", "with the distribution this software is provided by"),
    ("BSD-3-Clause", f"{_BINARY} Neither the name of", "with the distribution neither the name"),
    ("BSD-3-Clause", f"{_BINARY} 3. Neither the name of", "with the distribution 3 neither the name"),
    ("BSD-3-Clause", f"{_BINARY} The names of its contributors may not be used to endorse", "with the distribution the names of"),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement", "all advertising materials"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED", "is hereby granted the software is provided"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla public license v 2 0"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1", "mozilla public license version 1 1"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "creative commons attribution 4 0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
)


def _phrase(text: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def _notices() -> list[tuple[str, str, list[str]]]:
    found = [(i, text, list(needs)) for i, text, *needs in _TEXTS]
    names = [(i, name) for i, several in _NAMED.items() for name in several]
    codes = {i: [i] for i in _NAMED}
    for i, (kind, short, v) in _GNU.items():
        long = f"GNU {kind}General Public License"
        names += [
            (i, f"the {long}, version {v}"), (i, f"the {long} v{v}"), (i, f"the {long} {v}"), (i, f"the {long} ({short}) version {v}"),
            (i, f"version {v} of the {long}"), (i, f"the GNU {short} version {v}"), (i, f"the GNU {short} v{v}"),
            (i, f"the {short} version {v}"),
        ]
        found += [
            (i, f"This work is licensed under the {long}, version {v}.", [_phrase(f"{long} version {v}")]),
            (i, f"it under the terms of the {long} version {v} as published by the Free Software Foundation", [_phrase(f"{long} version {v}")]),
        ]
        if i != "GPL-1.0":
            found.append((i, _FREE.format(kind, f"{v} of the License"), [_phrase(long), _phrase(f"version {v} of the license")]))
        number = v if "." in v else v + ".0"
        codes[i] = [f"{short}-{number}", f"{short}-{number}-only", f"{short}-{number}-or-later"]
    for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        words = "-".join(_CC[p] for p in parts.split("-"))
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            i = f"CC-{parts}-{v}"
            long = [words, words.replace("NonC", "Non-C").replace("ShareA", "Share-A"), words.replace("NoDerivatives", "NoDerivs")]
            names += [(i, f"CC {parts} {v}"), (i, f"a CC {parts} {v} license"), (i, f"the CC {parts} {v} license")]
            names += [(i, f"{a} Creative Commons {w} {v}") for w in dict.fromkeys(long) for a in ("a", "the")]
            codes[i] = [i]
    for i, name in names:
        core = name.split(" ", 1)[1] if name.split(" ", 1)[0] in ("the", "a", "an") else name
        found += [(i, lead.format(name), [_phrase(core)]) for lead in _LEADS]
    found += [(i, f"SPDX-License-Identifier: {c}", [_phrase(c)]) for i, several in codes.items() for c in several]
    return [n for n in found if len(_phrase(n[1]).split()) >= SHINGLE_WORDS]


# By SPDX identifier, without the suffixes -only and -or-later; "BSD" is the family, told by its opening.
NOTICES = tuple(_notices())


def notices(spark: SparkSession) -> DataFrame:
    """The built-in templates ``(license_id, text, needs)``."""
    return spark.createDataFrame(list(NOTICES), "license_id string, text string, needs array<string>")


def license_words(text: Column) -> Column:
    found = F.split(ascii_lower(text), "[\\x00-/:-`{-\\x7F]+", -1)
    return F.filter(found, lambda w: w != "")


def shingle(words: Column, at: Column) -> Column:
    """The hash of the five words from a place on; null where they run over the end."""
    five = F.xxhash64(*(F.get(words, at + i) for i in range(SHINGLE_WORDS)))
    return F.when(at + SHINGLE_WORDS <= F.size(words), five)


def shingles(words: Column) -> Column:
    """All distinct shingles; the whole sequence as one where there are fewer words."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0)))
    return F.array_distinct(F.transform(places, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE_WORDS)))))


def band_values(rows: DataFrame, stride: int, *keep: str) -> DataFrame:
    """``(*keep, at, value)``: the minima of every window of ``words``, one row a band."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - SHINGLE_WORDS, F.lit(0)), F.lit(stride))
    windows = rows.where(F.size("words") >= SHINGLE_WORDS).select(*keep, "words", F.explode(starts).alias("at"))
    pairs = windows.select(
        *keep, "at", shingle(F.col("words"), F.col("at")).alias("one"),
        F.coalesce(shingle(F.col("words"), F.col("at") + 1), shingle(F.col("words"), F.col("at"))).alias("two"),
    )
    bands = F.explode(F.array(*(F.lit(k) for k in range(BANDS)))).alias("band")
    low = F.least(F.xxhash64("one", "band"), F.xxhash64("two", "band"))
    return pairs.select(*keep, "at", "one", "two", bands).select(*keep, "at", low.alias("value"))


def license_matches(docs: DataFrame, templates: DataFrame, *, percent: int = 75) -> DataFrame:
    """``(doc_id, license_id, percent, first_word, n_windows)`` of documents ``(doc_id, text)``.

    One row per row of ``docs`` and license found: the best containment in percent, the
    first word of the first window, and the number of verified windows. ``templates`` is
    ``(license_id, text)``, and where wanted ``needs``: phrases of lower-case words with single
    spaces that must lie around the window too. Several templates of one license are
    alternatives; of different licenses the better contained one counts at a window. A template
    with fewer than five words, a null or an empty one matches nothing, as do such
    documents. Rows of ``docs`` that are equal are reported as one; null ids are reported as
    null; other columns are ignored; an empty table gives an empty result; a text of any length is
    read in all its windows. Templates are broadcast when they hold at most
    ``BROADCAST_WORDS`` words and are joined by a shuffle of windows otherwise.
    """
    none = F.array().cast("array<string>")
    needs = F.coalesce("needs", none) if "needs" in templates.columns else none
    known = templates.select("license_id", license_words(F.coalesce("text", F.lit(""))).alias("words"), needs.alias("needs"))
    known = known.where(F.size("words") >= SHINGLE_WORDS).select(
        "license_id", F.xxhash64("words", "needs").alias("template"), "words", "needs", shingles(F.col("words")).alias("must")
    )
    known = known.dropDuplicates(["license_id", "template"])
    n_words, longest = known.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)), F.coalesce(F.max(F.size("words")), F.lit(0))).first()
    values = band_values(known, 1, "license_id", "template").select("license_id", "template", "value").distinct()
    small = n_words <= BROADCAST_WORDS
    if small:
        values = F.broadcast(values)

    rows = docs.select("doc_id", license_words(F.coalesce("text", F.lit(""))).alias("words"))
    rows = rows.select("doc_id", F.xxhash64("words").alias("content"), "words")
    region_start = F.greatest(F.col("at") - longest, F.lit(0))
    region = F.slice("words", region_start + 1, F.lit(2 * longest + WINDOW_WORDS))
    where = ["doc_id", "content", "license_id", "template", "at"]
    if small:
        found = band_values(rows, STRIDE, "doc_id", "content", "words").join(values, "value")
        hits = found.select(*where, region.alias("region")).distinct()
    else:  # the windows move without their texts, which are joined again with the few that hit
        found = band_values(rows, STRIDE, "doc_id", "content").join(values, "value").select(*where).distinct()
        texts = rows.select(F.col("doc_id").alias("_id"), F.col("content").alias("_content"), "words").distinct()
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content"))
        hits = found.join(texts, same).select(*where, region.alias("region"))
    must = known.select("license_id", "template", "must", "needs")
    around = F.concat(F.lit(" "), F.array_join("region", " "), F.lit(" "))
    checked = hits.join(F.broadcast(must) if small else must, ["license_id", "template"])
    checked = checked.where(F.forall("needs", lambda p: F.contains(around, F.concat(F.lit(" "), p, F.lit(" "))))).select(
        "doc_id", "content", "license_id", "at", F.size("must").alias("n_must"),
        F.size(F.array_intersect("must", shingles(F.col("region")))).alias("shared"),
    )
    rank = F.struct(F.col("shared") / F.col("n_must"), "n_must")
    checked = checked.where(100 * F.col("shared") >= percent * F.col("n_must"))
    checked = checked.withColumn("rank", rank).withColumn("best", F.max("rank").over(Window.partitionBy("doc_id", "content", "at")))
    return (
        checked.where(F.col("rank") == F.col("best"))
        .groupBy("doc_id", "content", "license_id")
        .agg(
            F.max(F.floor(100 * F.col("shared") / F.col("n_must")).cast("bigint")).alias("percent"),
            F.min("at").cast("bigint").alias("first_word"), F.countDistinct("at").alias("n_windows"),
        )
        .drop("content")
    )
