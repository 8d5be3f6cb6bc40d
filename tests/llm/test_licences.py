import math
import random
import re
from collections import Counter

import pytest

from dewpoint.llm.licences import CUES, WEAK, default_templates, scan_licences

MIT = """MIT License

Copyright (c) 2019 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD2 = """Copyright (c) 2019, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Copyright 2019 Some Body

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
GPL_FILE = """                    GNU GENERAL PUBLIC LICENSE
                       Version {}

 Copyright (C) Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
"""
GNU_HEADER = """# A program.
# Copyright (C) 2019  Some Body
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU {}General Public License as published by
# the Free Software Foundation, either version {} of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY.
import os
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
int x;
"""
APACHE_FILE = """
                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""
APACHE_HEADER = """// Copyright 2019 Some Body
//
// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0
"""
KNOWN = [
    (MIT, "MIT"),
    (MIT.replace("MIT License\n\n", ""), "MIT"),
    (MIT.replace("\n", "\r\n"), "MIT"),
    (BSD2, "BSD-2-Clause"),
    (BSD3, "BSD-3-Clause"),
    (ISC, "ISC"),
    (GPL_FILE.format("2, June 1991"), "GPL-2.0"),
    (GPL_FILE.format("3, 29 June 2007"), "GPL-3.0"),
    (GPL_FILE.replace("GENERAL", "LESSER GENERAL").format("3, 29 June 2007"), "LGPL-3.0"),
    (GNU_HEADER.format("", "3"), "GPL-3.0"),
    (GNU_HEADER.format("", "2"), "GPL-2.0"),
    (GNU_HEADER.format("Lesser ", "2.1"), "LGPL-2.1"),
    (GNU_HEADER.format("Affero ", "3"), "AGPL-3.0"),
    (MPL, "MPL-2.0"),
    ("Mozilla Public License Version 2.0\n==================================\n", "MPL-2.0"),
    (APACHE_FILE, "Apache-2.0"),
    (APACHE_HEADER, "Apache-2.0"),
    ("# SPDX-License-Identifier: Apache-2.0\nimport os\n", "Apache-2.0"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("Copyright 2019 Some Body. All rights reserved.\n\n" + ISC, "ISC"),
    ("text\n\nAll rights reserved.", "proprietary"),
    ("Text.\n\nReleased under CC BY-SA 4.0", "CC-BY-SA-4.0"),
]
PROSE = [
    None, "", "\n\n", "mit ihr und ohne sie", "She had a licence to drive and permission to stay.",
    "The public library is open to all; a table is reserved for you.",
    "The committee gave permission for redistribution of the funds to all schools.",
    "apache helicopters and the bsd daemon are in the wild", "license " * 5_000,
]


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, f"d{i}/a.txt", t) for i, t in enumerate(texts)], "n int, path string, text string"
    )


def test_licence_files_and_headers(spark):
    found = scan_licences(frame(spark, [t for t, _ in KNOWN])).orderBy("n").collect()
    assert [r.licence for r in found] == [licence for _, licence in KNOWN]
    assert {r.origin for r in found} == {"own"}


def test_every_template_holds_a_cue():
    for _, text in default_templates():
        assert set(CUES.split("|")) & set(re.findall("[a-z0-9]+", text.lower())), text


def test_prose_has_no_licence(spark):
    found = scan_licences(frame(spark, PROSE)).collect()
    assert {(r.licence, r.similarity, r.origin) for r in found} == {(None, None, "none")}


def plain(text, least=0.8):
    """The nearest template of a text's lines and blocks, by dictionaries."""
    templates = [(n, Counter(re.findall("[a-z0-9]+", t.lower()))) for n, t in default_templates()]
    seen = Counter(t for _, counts in templates for t in counts)
    rarest = math.log(1 + len(templates)) + 1

    def vector(counts):
        return {
            t: n * (math.log((1 + len(templates)) / (1 + seen[t])) + 1 if t in seen else rarest)
            for t, n in counts.items()
        }

    def norm(v):
        return math.sqrt(sum(w * w for w in v.values()))

    lines = re.split("\r\n|[\n\r]", text or "")
    blocks, block = [], []
    for line in [*lines, ""]:
        if any(c.isalnum() for c in line):
            block.append(line)
        else:
            blocks.append("\n".join(block))
            block = []
    best = None
    for unit in lines + blocks:
        if not re.search(f"(?i)(^|[^a-z0-9])({CUES})([^a-z0-9]|$)", unit):
            continue
        v = vector(Counter(re.findall("[a-z0-9]+", unit.lower())))
        for name, counts in templates:
            w = vector(counts)
            cosine = sum(x * v.get(t, 0) for t, x in w.items()) / (norm(v) * norm(w))
            if round(cosine, 9) >= least:
                found = (WEAK.get(name, 2), round(cosine, 9), name)
                best = found if best is None else max(best, found)
    return best


def test_nearest_templates_equal_brute_force(spark):
    draw = random.Random(6)
    texts = [t for t, _ in KNOWN] + PROSE[:-1]
    for _ in range(60):  # words lost, doubled and added
        words = re.split("( |\n)", draw.choice(KNOWN)[0])
        for _ in range(draw.randrange(1, 6)):
            at = draw.randrange(len(words))
            words[at : at + 1] = draw.choice([[], [words[at]] * 2, [words[at], " other "]])
        texts.append("".join(words))
    found = scan_licences(frame(spark, texts)).orderBy("n").collect()
    for row, text in zip(found, texts):
        best = plain(text)
        assert row.licence == (best and best[2])
        if best:
            assert row.similarity == pytest.approx(best[1], abs=2e-9)
