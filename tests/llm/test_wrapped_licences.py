"""Licence notices as they stand in files: wrapped, with comment marks, beside other text."""

import textwrap

from tests.llm.test_counts_and_scans import SF
from veldtab.llm import licenses
from veldtab.llm.common import table

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
       "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
       "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
       "subject to the following conditions:")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
       "conditions are met:")
GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
       "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
LGPL = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.")
CODE = "import os\nimport sys\nfor name in sorted(os.listdir(sys.argv[1])):\n    print(name, len(name))"


def forms(notice):
    for width in (45, 72, 80):
        lines = textwrap.wrap(notice, width)
        yield "\n".join(lines)
        yield "\r\n".join(["Copyright (c) 2020 Some Body", "", *lines, "", "More words follow here."])
        yield "/*\n" + "\n".join(" * " + x for x in lines) + "\n */\n" + CODE
        yield "\n".join("# " + x for x in lines) + "\n" + CODE + "\n" + CODE
        yield "Some words.\n\n" + "\n".join("// " + x for x in lines) + "\n//\n// And others.\n"


def test_wrapped_notices(spark):
    docs = table(spark, SF, "documents")
    model = licenses.fit_licences(docs)
    made = [(f, t) for f, n in (("mit", MIT), ("bsd", BSD), ("gpl", GPL), ("lgpl", LGPL)) for t in forms(n)]
    plain = "The driver has a license\nand the apache tribe has a version\nof the software for any person\nto use and modify."
    made.append(("", plain))
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(made)], "doc_id long, text string")
    got = {r.doc_id: (r.families, r.n_licence) for r in licenses.scan_licences(rows, model).collect()}
    assert [got[i] for i in range(len(made))] == [(f, 1 if f else 0) for f, _ in made]


def test_every_confirmed_text_has_a_telling_word():
    told = set(licenses._telling())
    for template in (t for family in licenses.TEMPLATES.values() for t in family):
        pairs = licenses._pairs(licenses._words(template))
        without = [p for p in pairs if not told & set(p.split())]
        assert len(without) < licenses.CONFIRM * len(pairs)


AGPL = GPL.replace("GNU General", "GNU Affero General")
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
       "copyright notice and this permission notice appear in all copies.")
EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which is available at the address below."
FREE = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software."


def test_families_and_held_out_families(spark):
    model = licenses.fit_licences(table(spark, SF, "documents"))
    made = [(f, t) for f, n in (("agpl", AGPL), ("isc", ISC), ("epl", EPL), ("unlicense", FREE)) for t in forms(n)]
    made += [(f, f"// SPDX-License-Identifier: {i}") for f, i in (("mit", "MIT"), ("apache", "Apache-2.0"), ("gpl", "GPL-3.0-or-later"), ("agpl", "AGPL-3.0-or-later"), ("isc", "ISC"),
                                                                   ("epl", "EPL-2.0"), ("mpl", "MPL-2.0"), ("lgpl", "LGPL-2.1-or-later"), ("unlicense", "Unlicense"))]
    # families that are in no template and in no example of the unknown class
    held_out = ["SPDX-License-Identifier: PostgreSQL", "SPDX-License-Identifier: NCSA", "Licensed under the Sleepycat License.", "Released under the PHP License, version 3.01.",
                "Licensed under the Python Software Foundation License Version 2.", "Licensed under the Academic Free License version 3.0"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([t for _, t in made] + held_out)], "doc_id long, text string")
    got = {r.doc_id: r.families for r in licenses.scan_licences(rows, model).collect()}
    assert [(f, got[i]) for i, (f, _) in enumerate(made) if got[i] != f] == []
    assert sum(bool(got[len(made) + i]) for i in range(len(held_out))) == 0


def test_lines_like_a_plain_scorer(spark):
    """Every line by itself: hashed words and pairs, class weights, temperature, share of the templates' pairs."""
    import math
    import re

    import numpy as np
    from pyspark.ml.feature import HashingTF
    from pyspark.sql import functions as F

    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = licenses.fit_licences(docs)
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate([MIT, BSD, "Licensed under the MIT license", "LICENSED UNDER CC BY 4.0\nLicensed under the apache license, version 9", *licenses.OTHERS])],
                                  "doc_id long, text string")
    docs = docs.unionByName(extra)
    matrix, bias = model.regression.coefficientMatrix.toArray(), model.regression.interceptVector.toArray()
    hashing = HashingTF(numFeatures=licenses.FEATURES)
    index = {}
    want = set()
    for r in docs.where(F.lower("text").rlike("licen|redistrib|permission|warrant") | (F.col("doc_id") % 20 == 0)).collect():
        for place, line in enumerate((r.text or "").split("\n")):
            words = [w for w in re.split(r"[\W_]+", line.lower()) if w]
            pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
            for t in words + pairs:
                if t not in index:
                    index[t] = hashing.indexOf(t)
            at = sorted({index[t] for t in words + pairs})
            if not at:
                continue
            raw = (bias + matrix[:, at].sum(axis=1) / math.sqrt(len(at))) / model.temperature
            p = np.exp(raw - raw.max()) / np.exp(raw - raw.max()).sum()
            best = int(p.argmax())
            if best == len(licenses.FAMILIES) or p[best] < licenses.LEAST:
                continue
            family = licenses.FAMILIES[best]
            share = max(len(set(pairs) & set(k)) / len(k) for k in (licenses._pairs(licenses._words(t)) for t in licenses.TEMPLATES[family]))
            if share >= licenses.CONFIRM:
                want.add((r.doc_id, place, family, round(float(p[best]), 6)))
    found = {(r.id, r.place, r.family, round(r.probability, 6)) for r in licenses.licence_paragraphs(docs, model).collect()}
    assert len(want) >= 8 and want <= found
    assert all("\n" in t for t in [r.text for r in docs.collect() if r.doc_id in {f[0] for f in found - want}])
