"""Licence scan by sentence rules, with DataFrame functions only.

A text is cut into sentences twice: with every line feed as an end (a notice on a line of its own), and with line feeds
inside a paragraph as spaces (a notice wrapped over lines).  A normalised sentence (lower case, other than letters and
digits as one space) that is known becomes its identifier; a licence is found if its rule, an ordered list of
identifiers, occurs in that order, with anything between, in one of the two sequences.  Notices with an end inside a
sentence (SPDX lines, GPL, MPL) are listed by the pieces that the cut makes of them; two identifiers joined by a comma
are one step of a rule, the second right after the first (an SPDX tag and its value).

Everything is a projection of the row: no join, no exchange, so a source with any share of the rows is no matter.  Null
and empty texts have no sentence.  Rows are independent of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: sentences of public licences, normalised
SENTENCES = {
    "apache2-ref": "licensed under the apache license version 2 0",
    "apache2-grant": "licensed under the apache license version 2 0 the license",
    "apache2-comply": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is "
                     "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2-spdx": "spdx license identifier apache 2 0",
    "mit-ref": "released under the mit license",
    "mit-ref2": "licensed under the mit license",
    "mit-ref3": "this project is licensed under the mit license",
    "mit-title": "the mit license mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files the software to deal in the software without restriction including without limitation "
                 "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
                 "permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to "
                 "the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-spdx": "spdx license identifier mit",
    "gpl3-ref": "this work is licensed under the gnu general public license version 3",
    "gpl3-ref2": "licensed under the gnu general public license version 3",
    "gpl2-ref": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation either version 3 of the license or at your option "
                "any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation either version 2 of the license or at your "
                 "option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the "
                    "implied warranty of merchantability or fitness for a particular purpose",
    "gpl3-spdx": "spdx license identifier gpl 3 0 or later",
    "gpl2-spdx": "spdx license identifier gpl 2 0 or later",
    "lgpl3-ref": "licensed under the gnu lesser general public license version 3",
    "agpl3-ref": "licensed under the gnu affero general public license version 3",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that "
                 "the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the "
                  "following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                  "following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                "products derived from this software without specific prior written permission",
    "bsd3-spdx": "spdx license identifier bsd 3 clause",
    "bsd2-spdx": "spdx license identifier bsd 2 clause",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                 "granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl2-ref": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mpl2-spdx": "spdx license identifier mpl 2 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-4-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-sa-4-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-nc-4-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-nd-4": "licensed under cc by nd 4 0",
    "cc0": "licensed under cc0 1 0",
    # pieces of notices that the cut parts
    "spdx": "spdx license identifier",
    "spdx-apache2": "apache 2 0",
    "spdx-mit": "mit",
    "spdx-gpl3": "gpl 3 0 or later",
    "spdx-gpl2": "gpl 2 0 or later",
    "spdx-bsd3": "bsd 3 clause",
    "spdx-bsd2": "bsd 2 clause",
    "spdx-mpl2": "mpl 2 0",
    "gpl3-only-spdx": "spdx license identifier gpl 3 0 only",
    "gpl3-plain-spdx": "spdx license identifier gpl 3 0",
    "gpl2-only-spdx": "spdx license identifier gpl 2 0 only",
    "gpl2-plain-spdx": "spdx license identifier gpl 2 0",
    "lgpl3-spdx": "spdx license identifier lgpl 3 0 or later",
    "lgpl3-only-spdx": "spdx license identifier lgpl 3 0 only",
    "lgpl3-plain-spdx": "spdx license identifier lgpl 3 0",
    "agpl3-spdx": "spdx license identifier agpl 3 0 or later",
    "agpl3-only-spdx": "spdx license identifier agpl 3 0 only",
    "agpl3-plain-spdx": "spdx license identifier agpl 3 0",
    "isc-spdx": "spdx license identifier isc",
    "cc0-spdx": "spdx license identifier cc0 1 0",
    "cc-by-4-spdx": "spdx license identifier cc by 4 0",
    "cc-by-sa-4-spdx": "spdx license identifier cc by sa 4 0",
    "unlicense-spdx": "spdx license identifier unlicense",
    "spdx-gpl3-only": "gpl 3 0 only",
    "spdx-gpl3-plain": "gpl 3 0",
    "spdx-gpl2-only": "gpl 2 0 only",
    "spdx-gpl2-plain": "gpl 2 0",
    "spdx-lgpl3": "lgpl 3 0 or later",
    "spdx-lgpl3-only": "lgpl 3 0 only",
    "spdx-lgpl3-plain": "lgpl 3 0",
    "spdx-agpl3": "agpl 3 0 or later",
    "spdx-agpl3-only": "agpl 3 0 only",
    "spdx-agpl3-plain": "agpl 3 0",
    "spdx-isc": "isc",
    "spdx-cc0": "cc0 1 0",
    "spdx-cc-by-4": "cc by 4 0",
    "spdx-cc-by-sa-4": "cc by sa 4 0",
    "spdx-unlicense": "unlicense",
    "gpl-program": "this program is free software",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                 "the free software foundation",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                  "the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                  "the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-either": "either version 3 of the license or at your option any later version",
    "gpl2-either": "either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl2-terms": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2-copy-http": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
}
# fixed values: rules in the order their sentences stand in the licences
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache2-ref",)),
    ("Apache-2.0", ("apache2-grant", "apache2-comply", "apache2-copy")),
    ("Apache-2.0", ("apache2-comply", "apache2-copy", "apache2-as-is")),
    ("MIT", ("mit-ref",)), ("MIT", ("mit-ref2",)), ("MIT", ("mit-ref3",)),
    ("MIT", ("mit-title", "mit-grant")), ("MIT", ("mit-grant", "mit-notice")), ("MIT", ("mit-grant", "mit-as-is")),
    ("GPL-3.0", ("gpl3-ref",)), ("GPL-3.0", ("gpl3-ref2",)),
    ("GPL-3.0", ("gpl-free", "gpl-warranty")),
    ("GPL-2.0", ("gpl2-ref",)), ("GPL-2.0", ("gpl2-free", "gpl-warranty")),
    ("LGPL-3.0", ("lgpl3-ref",)), ("AGPL-3.0", ("agpl3-ref",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-ref", "mpl2-copy")),
    ("CC-BY-4.0", ("cc-by-4",)), ("CC-BY-4.0", ("cc-by-4-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)), ("CC-BY-SA-4.0", ("cc-by-sa-4-long",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)), ("CC-BY-NC-4.0", ("cc-by-nc-4-long",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)), ("CC0-1.0", ("cc0",)), ("Unlicense", ("unlicense",)),
    ("All rights reserved", ("reserved",)),
    *((name, (step,)) for name, value in (
        ("Apache-2.0", "apache2"), ("MIT", "mit"), ("GPL-3.0", "gpl3"), ("GPL-2.0", "gpl2"), ("BSD-3-Clause", "bsd3"),
        ("BSD-2-Clause", "bsd2"), ("MPL-2.0", "mpl2"), ("GPL-3.0", "gpl3-only"), ("GPL-3.0", "gpl3-plain"),
        ("GPL-2.0", "gpl2-only"), ("GPL-2.0", "gpl2-plain"), ("LGPL-3.0", "lgpl3"), ("LGPL-3.0", "lgpl3-only"),
        ("LGPL-3.0", "lgpl3-plain"), ("AGPL-3.0", "agpl3"), ("AGPL-3.0", "agpl3-only"), ("AGPL-3.0", "agpl3-plain"),
        ("ISC", "isc"), ("CC0-1.0", "cc0"), ("CC-BY-4.0", "cc-by-4"), ("CC-BY-SA-4.0", "cc-by-sa-4"),
        ("Unlicense", "unlicense")) for step in (f"spdx,spdx-{value}", f"{value}-spdx")),
    *((f"GPL-{n}.0", ("gpl-program", *terms, "gpl-hope", "gpl-implied")) for n in (3, 2)
      for terms in ((f"gpl{n}-terms",), ("gpl-terms", f"gpl{n}-either"))),
    ("MPL-2.0", ("mpl2-terms", "mpl2-copy")), ("MPL-2.0", ("mpl2-terms", "mpl2-copy-http")),
)
# the longer form of a licence replaces the shorter one it contains
CONTAINS = {"BSD-3-Clause": "BSD-2-Clause"}
# words of every known sentence, with anything between two that normalising makes a space: a text without any of them
# has no known sentence, which saves cutting it
HINT = r"(?i)licen[cs]e|permission|redistribut|warrant|copyright|rights[^a-z0-9]+reserved|obtain|compliance" \
       r"|public[^a-z0-9]+domain|mpl|free[^a-z0-9]+software|apache|gpl|bsd|cc0" \
       r"|(?:^|[^a-z0-9])(?:mit|isc|cc[^a-z0-9]+by)(?:[^a-z0-9]|$)"
END = r"[.!?;:]+\s+|[.!?;:]+$"


def _identifiers(sentences: Column) -> Column:
    """Identifiers of the known sentences, in their order."""
    known = F.create_map(*[F.lit(x) for key, text in SENTENCES.items() for x in (text, key)])
    plain = F.transform(sentences, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    return F.filter(F.transform(plain, lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull())


def _follows(ids: Column, steps: tuple[str, ...]) -> Column:
    """Whether the steps occur in this order."""
    if len(steps) == 1 and "," in steps[0]:
        tag, value = steps[0].split(",")
        return F.exists(F.transform(ids, lambda x, i: (x == value) & (F.get(ids, i - 1) == tag)), lambda x: x)
    wanted = F.array(*[F.lit(s) for s in steps], F.lit(None).cast("string"))
    reached = F.aggregate(ids, F.lit(0), lambda at, x: F.when(x == F.element_at(wanted, at + 1), at + 1).otherwise(at))
    return reached == len(steps)


def licence_scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of known sentences and pieces, and the licences found, sorted."""
    text = F.coalesce("text", F.lit(""))
    paragraphs = F.regexp_replace(F.regexp_replace(text, r"\n[ \t]*\n\s*", ". "), "\n", " ")
    none = F.array().cast("array<string>")
    hinted = text.rlike(HINT)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.when(hinted, _identifiers(F.split(text, END + "|\n"))).otherwise(none).alias("by_line"),
        F.when(hinted, _identifiers(F.split(paragraphs, END))).otherwise(none).alias("by_paragraph"))
    any_ = (F.size("by_line") > 0) | (F.size("by_paragraph") > 0)
    found = F.array_compact(F.array(*[
        F.when(_follows(F.col("by_line"), steps) | _follows(F.col("by_paragraph"), steps), F.lit(name))
        for name, steps in RULES]))
    rows = rows.withColumn("found", F.when(any_, F.array_sort(F.array_distinct(found))).otherwise(none))
    for longer, shorter in CONTAINS.items():
        rows = rows.withColumn("found", F.when(F.array_contains("found", longer), F.array_remove("found", shorter))
                               .otherwise(F.col("found")))
    return rows.select("doc_id", F.greatest(F.size("by_line"), F.size("by_paragraph")).cast("bigint").alias("n_sentences"),
                       F.col("found").alias("licences"))
