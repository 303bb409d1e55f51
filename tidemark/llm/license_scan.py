"""Operator 6: license scans, in DataFrame functions only.

Method. A text's words become five-word shingles, and every two neighbours are a window, besides the first and the last shingle alone.
BANDS MinHash values of a window, one row a band, retrieve texts that have a value of a template's shingle. A single template
shingle amid other words is missed by a band only if both its neighbours hash below it, 1/3, and so by all with
probability 3**-BANDS, 0.00015; at a text's start or end it is a window of its own and always met. Texts that meet a
template are then verified: a template matches where 0.75 or more of its shingles are in the text.

Scale. One pass over the texts, no shuffle; the templates' values are constants. Windows stay in the row of their text, and
only rows that meet a template are verified.

Cases. A null or empty text, or one of fewer than five words, has no shingles and no license. Repeated rows each keep theirs.
Kept columns named like the result's (licenses, n_licenses) are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.folds import let
from tidemark.llm.shared import without

SHINGLE, BANDS = 5, 8
#: Least share of a template's shingles that the text holds.
NUMERATOR, DENOMINATOR = 3, 4
#: Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}


def shingles(text: Column) -> Column:
    """Hashes of five-word shingles of the lower-cased alphanumeric words."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.split(F.regexp_replace(F.coalesce(lowered, F.lit("")), r"^[\x00-\x2F\x3A-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x60\x7B-\x7F]+$", ""), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    n = lambda a: F.greatest(F.size(a) - (SHINGLE - 1), F.lit(0))

    def joined(h: Column) -> Column:
        pair = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
        cut = lambda k: F.slice(h, F.lit(k), n(h))
        return pair(pair(pair(pair(cut(1), cut(2)), cut(3)), cut(4)), cut(5))

    return let(F.transform(words, lambda w: F.xxhash64(w)), joined)


def ranked(s: Column, band: int) -> Column:
    """A band's values of the shingles."""
    return F.transform(s, lambda x: F.xxhash64(x, F.lit(band)))


def band_values(s: Column, band: int) -> Column:
    """A band's MinHash value of each window of two neighbours, and of the first and the last shingle alone."""
    none = F.array(F.lit(None).cast("long"))
    return let(ranked(s, band), lambda v: F.zip_with(F.concat(none, v), v, lambda x, y: F.least(x, y)))  # null counts as absent


def _constants(spark: SparkSession, templates: dict[str, str]) -> tuple[list[tuple[str, list[int]]], list[list[int]]]:
    """Each template's distinct shingles, and each band's values of all templates' shingles."""
    df = spark.createDataFrame(sorted(templates.items()), "name string, text string").withColumn("s", shingles(F.col("text")))
    rows = df.select("name", F.array_distinct("s").alias("s"), *(ranked(F.col("s"), b).alias(f"b{b}") for b in range(BANDS))).collect()  # as many as templates
    return [(r["name"], r["s"]) for r in rows], [sorted({v for r in rows for v in r[f"b{b}"]}) for b in range(BANDS)]


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded into one constant


def scan(docs: DataFrame, keep: list[str], templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """docs(text, ...) to its columns ``keep``, ``licenses`` (names of matched templates, sorted) and ``n_licenses``."""
    known, bands = _constants(docs.sparkSession, templates)
    known = [(name, s) for name, s in known if s]
    keep = without(keep, "licenses", "n_licenses")
    cut = docs.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"]))).withColumn("__shingles", shingles(F.col("text")))
    meets = F.lit(False)
    for b, values in enumerate(bands):
        meets |= F.arrays_overlap(band_values(F.col("__shingles"), b), _longs(values)) if values else F.lit(False)
    names = [F.when(F.size(F.array_intersect("__shingles", _longs(s))) * DENOMINATOR >= NUMERATOR * len(s), F.lit(name)) for name, s in known]
    none = F.array().cast("array<string>")
    matched = F.array_compact(F.array(*names)) if names else none
    found = F.when((F.size("__shingles") > 0) & F.coalesce(meets, F.lit(False)), matched).otherwise(none)
    return cut.select(*(F.col(f"`{c}`") for c in keep), found.alias("licenses")).withColumn("n_licenses", F.size("licenses").cast("long"))
