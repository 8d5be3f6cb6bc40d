"""Licences of files: headers, licence texts and statements by TF-IDF cosine to templates,
others from the nearest directory."""

from __future__ import annotations

import json
import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dewpoint.llm.common import BROADCAST_ROWS, kept

# Names of licences, by SPDX identifier where there is one.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": [
        "CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "CC BY-SA 4.0",
        "Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "CC0-1.0": ["CC0 1.0 Universal"],
    "GPL-2.0": ["GNU General Public License, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MIT": ["MIT License"],
    "MPL-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"],
}
# How a name is stated.
STATEMENTS = (
    "The {} license",
    "Licensed under the {}",
    "Released under the {}",
    "Distributed under the terms of the {}",
    "This work is licensed under the {}",
    "This file is subject to the terms of the {}",
)
# Passages of the licences themselves and of their file headers.
PASSAGES = {
    "Apache-2.0": [
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal"],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain."
    ],
    "proprietary": ["All rights reserved."],
}
GNU_HEADER = (
    "This program is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU {kind}General Public License as published by the Free Software Foundation; either "
    "version {version} of the License, or (at your option) any later version."
)
GNU = {
    "AGPL-3.0": ("Affero ", "3"),
    "GPL-2.0": ("", "2"),
    "GPL-3.0": ("", "3"),
    "LGPL-2.1": ("Lesser ", "2.1"),
    "LGPL-3.0": ("Lesser ", "3"),
}
# A unit of text without any of these words states no licence.
CUES = (
    "licence|licenced|license|licensed|licenses|spdx|reserved|permission|redistribution|cc|cc0|"
    "unencumbered"
)
# Templates that hold for others too: they count where nothing stronger is found.
WEAK = {"proprietary": 0, "BSD-2-Clause": 1}
STRONG = 2
LICENCE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"


def default_templates() -> list[tuple[str, str]]:
    """Licences and their templates: names as they are stated, identifiers, passages."""
    found = []
    for licence, names in NAMES.items():
        found += [(licence, statement.format(name)) for name in names for statement in STATEMENTS]
        found.append((licence, f"SPDX-License-Identifier: {licence}"))
    for licence, passages in PASSAGES.items():
        found += [(licence, passage) for passage in passages]
    for licence, (kind, version) in GNU.items():
        found.append((licence, GNU_HEADER.format(kind=kind, version=version)))
        found += [(licence, f"SPDX-License-Identifier: {licence}-{x}") for x in ("only", "or-later")]
    return found


class TemplateModel:
    """TF-IDF weights of the templates; tokens of no template weigh as the rarest."""

    def __init__(self, templates: list[tuple[str, str]]):
        split = [
            (licence, Counter(re.findall(r"[a-z0-9]+", text.lower()))) for licence, text in templates
        ]
        seen = Counter(token for _, counts in split for token in counts)
        self.unknown = log(1 + len(templates)) + 1
        self.idf = {t: log((1 + len(templates)) / (1 + n)) + 1 for t, n in sorted(seen.items())}
        self.templates = []
        for licence, counts in split:
            weights = {t: n * self.idf[t] for t, n in sorted(counts.items())}
            self.templates.append(
                {
                    "licence": licence,
                    "strength": WEAK.get(licence, STRONG),
                    "norm": sqrt(sum(w * w for w in weights.values())),
                    "terms": [{"token": t, "weight": w * self.idf[t]} for t, w in weights.items()],
                }
            )


def tokens_of(unit: Column) -> Column:
    return F.array_sort(
        F.filter(F.split(F.lower(unit), "[^a-z0-9]+"), lambda t: F.length(t) > 0)
    )


def best_template(units: Column, model: TemplateModel, least: float) -> Column:
    """For each of an array of texts the nearest template as ``strength, similarity,
    licence``; the strength is -1 where the cosine is below ``least``.

    Both sides are sparse: a text's norm comes from its tokens in sorted order, equal ones
    next to each other; of its tokens those of the templates are counted once, so that the
    products cost the same for texts of any length.
    """
    # Literals as JSON, which is read once.
    idf = F.from_json(F.lit(json.dumps(model.idf)), "map<string, double>")
    templates = F.from_json(
        F.lit(json.dumps(model.templates)),
        "array<struct<licence: string, strength: int, norm: double, "
        "terms: array<struct<token: string, weight: double>>>>",
    )

    def add(state: Column, token: Column) -> Column:
        run = F.when(state["last"] == token, state["run"] + 1).otherwise(F.lit(1.0))
        weight = F.coalesce(F.try_element_at(idf, token), F.lit(model.unknown))
        return F.struct(
            token.alias("last"),
            run.alias("run"),
            (state["sum"] + weight * weight * (2 * run - 1)).alias("sum"),
        )

    def sparse(tokens: Column) -> Column:
        square = F.aggregate(
            tokens,
            F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum")),
            add,
            lambda state: state["sum"],
        )
        known = F.array_intersect(tokens, F.map_keys(idf))
        counts = F.map_from_arrays(
            known,
            F.transform(known, lambda k: F.size(F.filter(tokens, lambda t: t == k)).cast("double")),
        )
        return F.struct(square.alias("square"), counts.alias("counts"))

    def score(unit: Column, template: Column) -> Column:
        product = F.aggregate(
            template["terms"],
            F.lit(0.0),
            lambda sum_, term: sum_
            + term["weight"]
            * F.coalesce(F.try_element_at(unit["counts"], term["token"]), F.lit(0.0)),
        )
        cosine = F.try_divide(product, template["norm"] * F.sqrt(unit["square"]))
        return F.struct(
            F.round(F.coalesce(cosine, F.lit(0.0)), 9).alias("similarity"),
            template["strength"].alias("strength"),
            template["licence"].alias("licence"),
        )

    def ranked(scored: Column) -> Column:
        return F.struct(
            F.when(scored["similarity"] >= least, scored["strength"])
            .otherwise(F.lit(-1))
            .alias("strength"),
            scored["similarity"].alias("similarity"),
            scored["licence"].alias("licence"),
        )

    # A lambda's argument is computed once, an expression in its body at every use.
    vectors = F.transform(F.transform(units, tokens_of), sparse)
    return F.transform(
        vectors,
        lambda unit: F.array_max(
            F.transform(F.transform(templates, lambda t: score(unit, t)), ranked)
        ),
    )


def scan_licences(
    files: DataFrame,
    *,
    path: str = "path",
    text: str = "text",
    templates: list[tuple[str, str]] | None = None,
    least: float = 0.8,
    licence_names: str = LICENCE_NAMES,
) -> DataFrame:
    """``files`` without their text, with ``licence, similarity, origin, licence_directory``.

    A statement is a line, or a block of lines up to one without letters or digits, that
    holds one of ``CUES`` and whose TF-IDF cosine to a template (``licence, text``) is at
    least ``least``. A file's own licence is its nearest one (``origin`` "own"), but those of
    ``WEAK`` only without a stronger one. A licence file is one named like
    ``licence_names`` or one whose first line or block with words is a statement; it
    licenses its directory (the surest, then the last by name, if a directory has several). A
    file without a licence of its own inherits that of its nearest licensed ancestor directory
    (``origin`` "inherited"), else licence and similarity are null and origin "none".

    All lines and blocks of the whole text are looked at. Null or empty texts have no statement, a null
    path no directory; repeated rows are judged alike; an empty table gives no rows.
    Columns of ``files`` with the names of results are replaced.

    Directories, not files, meet their ancestors, and a directory table is small beside
    the files; a directory holding a third of all files costs one row there. It is
    broadcast if it is counted to be small, else joined by a shuffle.
    """
    model = TemplateModel(templates or default_templates())
    results = ["licence", "similarity", "origin", "licence_directory"]
    judged = kept(_own_statements(files.drop(*results), path, text, model, least).drop(text, "_nearest"))
    slim = judged.select(
        F.col(path).alias("_path"), "_directory", "_own", "_opens"
    ).filter(F.col("_own").isNotNull() & F.col("_directory").isNotNull())
    name = F.regexp_extract("_path", "([^/]*)$", 1)
    licensed = (
        slim.filter(F.col("_opens") | F.regexp_like(name, F.lit(licence_names)))
        .groupBy("_directory")
        .agg(F.max("_own").alias("_given"))
        .select(F.col("_directory").alias("_ancestor"), "_given")
    )
    directories = judged.select("_directory").filter("_directory IS NOT NULL").distinct()
    nearest = (
        directories.withColumn("_ancestor", F.explode(ancestors(F.col("_directory"))))
        .join(licensed, "_ancestor")
        .groupBy("_directory")
        .agg(
            F.max_by(
                F.struct("_given.similarity", "_given.licence", "_ancestor"), F.length("_ancestor")
            ).alias("_inherited")
        )
        .withColumnRenamed("_directory", "_of")
    )
    if nearest.count() <= BROADCAST_ROWS:
        nearest = F.broadcast(nearest)
    joined = judged.join(nearest, F.col("_directory") == F.col("_of"), "left")
    own = F.col("_own").isNotNull()
    return joined.select(
        *[c for c in files.columns if c not in (*results, text)],
        F.coalesce("_own.licence", "_inherited.licence").alias("licence"),
        F.coalesce("_own.similarity", "_inherited.similarity").alias("similarity"),
        F.when(own, "own")
        .when(F.col("_inherited").isNotNull(), "inherited")
        .otherwise("none")
        .alias("origin"),
        F.when(~own, F.col("_inherited._ancestor")).alias("licence_directory"),
    )


def _own_statements(
    files: DataFrame, path: str, text: str, model: TemplateModel, least: float
) -> DataFrame:
    cue = F.lit(rf"(?i)(^|[^a-z0-9])({CUES})([^a-z0-9]|$)")
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(content, "\\r\\n|[\\n\\r]")
    end = "(?>\\r\\n|[\\n\\r])"
    blocks = F.split(content, f"{end}[^\\p{{L}}\\p{{N}}\\n\\r]*{end}")
    units = F.array_distinct(F.concat(lines, blocks))
    nearest = F.array_max(
        best_template(F.filter(units, lambda unit: F.regexp_like(unit, cue)), model, least)
    )
    first = [
        F.slice(F.filter(some, lambda unit: F.regexp_like(unit, F.lit(r"\w"))), 1, 1)
        for some in (lines, blocks)
    ]
    opening = F.array_max(
        best_template(
            F.filter(F.concat(*first), lambda unit: F.regexp_like(unit, cue)), model, least
        )
    )
    found = files.withColumn("_nearest", F.when(F.regexp_like(content, cue), nearest)).withColumn(
        "_own", F.when(F.col("_nearest.strength") >= 0, F.col("_nearest"))
    )
    opens = F.when(F.col("_own").isNotNull(), opening["strength"] >= 0)
    return found.withColumn("_opens", F.coalesce(opens, F.lit(False))).withColumn(
        "_directory", F.regexp_replace(F.col(path), "/?[^/]*$", "")
    )


def ancestors(directory: Column) -> Column:
    """The directory itself and those above it, the top ("") last."""
    parts = F.split(directory, "/")
    return F.transform(
        F.sequence(F.size(parts), F.lit(0), F.lit(-1)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )
