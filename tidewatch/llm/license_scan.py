"""License texts found by MinHash bands over text windows, in DataFrame operations only.

Texts are lower-cased letter-and-digit words in five-word shingles. Windows hold 16
shingles and begin every 8, so a run of 9 shingles lies whole in one of them. A window has
16 bands of one row each: the least of its shingle hashes under 16 XOR masks that differ
in their leading bits. A template is cut into the same windows, and each of its windows
that holds the Jaccard share J of a text's window meets it with probability
1 - (1 - J)^16: 0.99 at J = 1/4, which five of sixteen shingles exceed. Templates of
fewer than five shingles also use windows of one shingle, whose band is the shingle
itself, so they are always met. A retrieved template matches if at least ``containment``
of its shingles stand in the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, STRIDE, BANDS, MAX_TEMPLATES = 5, 8, 16, 1000
#: License notices as they are published.
TEMPLATES = [
    ("gpl-3-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4-line", "Licensed under CC BY-NC 4.0."),
    ("mit-line", "Released under the MIT License."),
    ("apache-2-line", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                 "in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License, "
              "or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
]
_STRIPPED = r"trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' '))"


def _masks() -> list[int]:
    return [((k << 60) ^ ((k * 0x9E3779B97F4A7C15) & ((1 << 60) - 1))) for k in range(BANDS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _shingled(df: DataFrame) -> DataFrame:
    """Adds w (words), sh (their shingles) and x (the shingles' hashes)."""
    return df.withColumn("w", F.expr(f"split({_STRIPPED}, ' ')")).withColumn("sh", F.expr(
        f"CASE WHEN size(w) >= {SHINGLE} THEN transform(sequence(0, size(w) - {SHINGLE}), i -> "
        + "concat_ws(' ', " + ", ".join(f"w[i + {j}]" for j in range(SHINGLE)) + ")) "
        "ELSE cast(array() AS array<string>) END")).withColumn("x", F.expr("transform(sh, s -> xxhash64(s))"))


def _banded(df: DataFrame) -> DataFrame:
    """Adds bands: the distinct band values of all windows of 16 shingles."""
    least = "array(" + ", ".join(f"array_min(transform(b, h -> h ^ {_signed(m)}L))" for m in _masks()) + ")"
    least = least.replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
    blocks = (f"CASE WHEN size(x) = 0 THEN cast(array() AS array<array<bigint>>) ELSE transform(transform("
              f"sequence(0, (size(x) - 1) div {STRIDE}), i -> slice(x, 1 + i * {STRIDE}, {STRIDE})), b -> {least}) END")
    return df.withColumn("least", F.expr(blocks)).withColumn("bands", F.expr(
        "flatten(transform(least, (a, i) -> zip_with(a, coalesce(get(least, i + 1), a), (p, q) -> least(p, q))))"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, containment: float = 0.8) -> DataFrame:
    """doc_id, template_id, containment, first_word (the place of the first word of the
    first shingle found, from 0): one row for each text and template that match.

    Null, empty and short texts match nothing; repeated rows match each on their own; a
    null doc_id stays; extra columns are ignored. At most ``MAX_TEMPLATES`` templates: they
    travel as literals in the plan. Templates without a shingle are left out."""
    spark: SparkSession = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    # the templates' own shingles and bands by the same expressions, a handful of rows
    rows = _banded(_shingled(spark.createDataFrame(templates or [("", "")], "template_id string, text string"))) \
        .selectExpr("template_id", "array_distinct(sh) AS sh", "array_distinct(bands) AS bands",
                    "array_distinct(x) AS x").collect()
    known = [(r.template_id, r.sh, r.bands, r.x if len(r.sh) < SHINGLE else []) for r in rows if r.sh]

    def longs(values) -> str:
        return "array(" + ", ".join("(-9223372036854775807L - 1L)" if v == -(1 << 63) else f"{v}L" for v in values) + ")" \
            if values else "cast(array() AS array<bigint>)"

    def text(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    if not known:
        return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "'' AS template_id",
                               "0D AS containment", "0L AS first_word").where("false")
    any_band = longs(sorted({v for k in known for v in k[2]}))
    any_one = longs(sorted({v for k in known for v in k[3]}))
    # the row number keeps the filter above these columns: below, it would work each out anew
    wide = _banded(_shingled(docs.select(F.col("doc_id").cast("long"), "text"))).withColumn(
        "row", F.monotonically_increasing_id()).where(
        f"row >= 0 AND (arrays_overlap(bands, {any_band}) OR arrays_overlap(x, {any_one}))")
    tried = ", ".join(
        f"struct({text(t)} AS template_id, array({', '.join(map(text, sh))}) AS sh, "
        f"arrays_overlap(bands, {longs(bands)}) OR arrays_overlap(x, {longs(one)}) AS met)"
        for t, sh, bands, one in known)
    return wide.selectExpr("doc_id", "sh AS own", f"explode(filter(array({tried}), t -> t.met)) AS t").selectExpr(
        "doc_id", "t.template_id AS template_id", "array_intersect(t.sh, own) AS hit", "t.sh AS sh", "own").selectExpr(
        "doc_id", "template_id", "size(hit) / size(sh) AS containment",
        "array_min(transform(hit, h -> array_position(own, h))) - 1 AS first_word").where(
        f"containment >= {containment}")
