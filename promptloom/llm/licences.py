"""Licences by their sentences: known sentences become identifiers, ordered rules recognise licences.

Only column expressions; a document is read once and nothing is shuffled.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _versions(names: tuple[str, ...], number: str) -> tuple[str, ...]:
    """Notices of a licence's names with its version: "version 3", "v3", "v3 0", "3 0" ..."""
    numbers = (number,) if " " in number else (number, f"{number} 0")
    forms = [f"under {name} {mark}{n}" for name in names for n in numbers for mark in ("version ", "v", "v ", "")]
    return tuple(forms + [f"under {names[-1]}v{n}" for n in numbers])


def _creative(short: str, long: str) -> tuple[str, ...]:
    names = (f"cc {short} 4 0", f"creative commons {long} 4 0 international", f"{long} 4 0 international")
    return tuple(f"under {name}{end}" for name in names for end in ("", " license"))


# Sentences of public licences in normal form (lower case, words of letters and digits,
# one space between), by identifier. A notice "licensed under ..." in any usual wording has its own
# normal form, which starts with "under".
SENTENCES: dict[str, tuple[str, ...]] = {
    "mit-title": ("mit license", "the mit license", "the mit license mit"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "mit-keep-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the software",
    ),
    "mit-no-warranty": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "mit-no-liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
        "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ),
    "mit-notice": ("under mit license", "under mit", "mit licensed"),
    "bsd-conditions": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
        "1 redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
        "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd-no-endorsement": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
        "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "bsd-no-warranty": (
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
        "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
        "disclaimed",
    ),
    "bsd-2-notice": ("under bsd 2 clause license", "under 2 clause bsd license", "under simplified bsd license"),
    "bsd-3-notice": ("under bsd 3 clause license", "under 3 clause bsd license", "under new bsd license"),
    "isc-title": ("isc license", "the isc license", "isc license isc"),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "isc-no-warranty": (
        "the software is provided as is and the author disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness",
    ),
    "isc-notice": ("under isc license",),
    "apache-2-notice": (
        "under apache license version 2 0",
        "under apache license 2 0",
        "under apache license version 2 0 the license",
    ),
    "apache-2-compliance": ("you may not use this file except in compliance with the license",),
    "apache-2-copy": ("you may obtain a copy of the license at",),
    "apache-2-no-warranty": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "gpl-title": ("gnu general public license",),
    "gpl-2-notice": (
        *_versions(("gnu general public license", "gnu gpl", "gpl"), "2"),
        "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published "
        "by the free software foundation",
    ),
    "gpl-3-notice": (
        *_versions(("gnu general public license", "gnu gpl", "gpl"), "3"),
        "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published "
        "by the free software foundation",
    ),
    "gpl-free-software": ("this program is free software", "this library is free software", "this file is free software"),
    "gpl-grant": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation",
    ),
    "lgpl-grant": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation",
    ),
    "gnu-2-or-later": ("either version 2 of the license or at your option any later version",),
    "gnu-2-1-or-later": ("either version 2 1 of the license or at your option any later version",),
    "gnu-3-or-later": ("either version 3 of the license or at your option any later version",),
    "gpl-3-or-later": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version",
    ),
    "gpl-2-or-later": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 2 of the license or at your option any later version",
    ),
    "gpl-no-warranty": (
        "this program is distributed in the hope that it will be useful but without any warranty",
        "this library is distributed in the hope that it will be useful but without any warranty",
        "this file is distributed in the hope that it will be useful but without any warranty",
    ),
    "lgpl-2-notice": _versions(("gnu lesser general public license", "gnu lgpl", "lgpl"), "2 1"),
    "lgpl-3-notice": _versions(("gnu lesser general public license", "gnu lgpl", "lgpl"), "3"),
    "lgpl-2-or-later": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation either version 2 1 of the license or at your option any later version",
    ),
    "lgpl-3-or-later": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ),
    "agpl-3-notice": _versions(("gnu affero general public license", "gnu agpl", "agpl"), "3"),
    "agpl-3-or-later": (
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version",
    ),
    # "v. 2.0" ends a line's sentence after "v"; with lines joined its "v." is left out.
    "mpl-2-notice": (
        *_versions(("mozilla public license", "mpl"), "2 0"),
        "this source code form is subject to the terms of the mozilla public license v",
        "this source code form is subject to the terms of the mozilla public license 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    "cc-by-notice": _creative("by", "attribution"),
    "cc-by-sa-notice": _creative("by sa", "attribution sharealike"),
    "cc-by-nc-notice": _creative("by nc", "attribution noncommercial"),
    "cc-by-nc-sa-notice": _creative("by nc sa", "attribution noncommercial sharealike"),
    "cc-by-nd-notice": _creative("by nd", "attribution noderivatives"),
    "cc0-notice": ("under cc0 1 0 universal public domain dedication", "under cc0 1 0 universal", "under cc0 1 0"),
    "unlicense-grant": ("this is free and unencumbered software released into the public domain",),
    "rights-reserved": ("all rights reserved",),
}

# What may follow a notice in its sentence.
ENDINGS = tuple(
    f" see {file}{end}"
    for file in ("the license file", "the license md file", "the license license file", "the license md license md file", "license")
    for end in ("", " for details")
)
SENTENCES = {
    name: forms + tuple(f + end for f in forms if f.startswith("under ") for end in ENDINGS)
    for name, forms in SENTENCES.items()
}

# Licence and the sentences that make it, in this order and next to each other among the known ones.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-grant", "mit-keep-notice", "mit-no-warranty", "mit-no-liability")),
    ("MIT", ("mit-notice",)),
    ("BSD-2-Clause", ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-no-warranty")),
    ("BSD-2-Clause", ("bsd-2-notice",)),
    ("BSD-3-Clause", ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-no-endorsement", "bsd-no-warranty")),
    ("BSD-3-Clause", ("bsd-3-notice",)),
    ("ISC", ("isc-grant", "isc-no-warranty")),
    ("ISC", ("isc-notice",)),
    ("Apache-2.0", ("apache-2-notice",)),
    ("Apache-2.0", ("apache-2-compliance", "apache-2-copy", "apache-2-no-warranty")),
    ("GPL-2.0-only", ("gpl-2-notice",)),
    ("GPL-2.0-or-later", ("gpl-free-software", "gpl-2-or-later", "gpl-no-warranty")),
    ("GPL-2.0-or-later", ("gpl-grant", "gnu-2-or-later")),
    ("GPL-3.0-only", ("gpl-3-notice",)),
    ("GPL-3.0-or-later", ("gpl-free-software", "gpl-3-or-later", "gpl-no-warranty")),
    ("GPL-3.0-or-later", ("gpl-grant", "gnu-3-or-later")),
    ("LGPL-2.1-only", ("lgpl-2-notice",)),
    ("LGPL-2.1-or-later", ("lgpl-2-or-later",)),
    ("LGPL-2.1-or-later", ("lgpl-grant", "gnu-2-1-or-later")),
    ("LGPL-3.0-only", ("lgpl-3-notice",)),
    ("LGPL-3.0-or-later", ("lgpl-3-or-later",)),
    ("LGPL-3.0-or-later", ("lgpl-grant", "gnu-3-or-later")),
    ("AGPL-3.0-only", ("agpl-3-notice",)),
    ("AGPL-3.0-or-later", ("agpl-3-or-later",)),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-notice",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("Unlicense", ("unlicense-grant",)),
)

# Every known sentence has one of these inside a word, so a text without any has none of the sentences.
HINTS = ("licens", "permi", "copyright", "redistribut", "warrant", "under", "software", "liab", "rights", "conditions", "unencumbered")

# Wordings of a notice: "this work is licensed under the", "released under a", "available under the terms of the" ...
NOTICE = "^(?:[a-z0-9 ]+ (?:is|are) )?(?:dual |also |hereby )?(?:licensed|released|distributed|published|provided|made available|available) under (?:the |an? )?(?:terms of (?:the |an? )?)?"
SENTENCE_END = "[.;!?:]+[\\x20\\x09-\\x0D]+"
# Marks that open or close a line of a comment.
_MARKS = "[\\x20\\x09]*(?:[/*#;%!>|-]+|dnl\\x20|rem\\x20)?[\\x20\\x09\\x0D]*"
# A paragraph ends at a line without words, and after a line of copyright.
PARAGRAPH_END = (
    f"\\x0A{_MARKS}\\x0A|(?:copyright[\\x20\\x09]*(?:\\(c\\)|©|[0-9])|(?:\\(c\\)|©)[\\x20\\x09]*[0-9])"
    "(?:[^\\x0A]*[^d.\\x0A\\x0D\\x20\\x09]|[^.\\x0A]*)[\\x20\\x09\\x0D]*\\x0A"
)
# Left out where lines are joined: line ends with the marks after them, and the "v." of "v. 2.0", which ends no sentence.
BLANK = f"[\\x0A\\x0D]{_MARKS}|\\x20v\\.[\\x20\\x09\\x0A\\x0D]+"


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a lower-case text, in order; sentences end at marks and lines."""
    lines = F.regexp_replace(text, SENTENCE_END, "\n")
    words = F.regexp_replace(lines, "[^a-z0-9\\n]+", " ")
    by_sentence = F.create_map(
        *[F.lit(x) for name, forms in SENTENCES.items() for form in forms for x in (form, name)]
    )
    # Looking a sentence up costs more than a look for its hints.
    hinted = F.filter(F.split(words, "\n"), lambda line: line.rlike("|".join(HINTS)))
    normal = F.transform(hinted, lambda line: F.regexp_replace(F.trim(line), NOTICE, "under "))
    return F.filter(F.transform(normal, lambda line: by_sentence[line]), lambda name: name.isNotNull())


def known_sentences(text: Column) -> tuple[Column, Column]:
    """Identifiers with lines as they are, and with the lines of a paragraph joined."""
    lower = lowered(F.coalesce(text, F.lit("")))
    hinted = lower.rlike("|".join(HINTS))
    none = F.array().cast("array<string>")
    joined = F.regexp_replace(F.regexp_replace(lower, PARAGRAPH_END, ".\n"), BLANK, " ")
    return tuple(F.when(hinted, _identifiers(form)).otherwise(none) for form in (lower, joined))


def _sequence(names: Column) -> Column:
    return F.concat(F.lit("|"), F.array_join(names, "|"), F.lit("|"))


def licence_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Licences of every row: doc_id, sentences, joined_sentences, licences, n_known.

    `sentences` are the identifiers of known sentences in order, separated by "|", line by line;
    `joined_sentences` those of the text with the lines of a paragraph joined; `licences` are those whose sentences
    stand next to each other in one of the two, each once, by name in ascending order, separated by ";";
    `n_known` counts the sentences of the first. A null or empty text has none; long texts are read
    whole; repeated rows and null ids are rows like others; an empty table gives an empty one.
    """
    by_line, by_text = known_sentences(F.col(text_column))
    found = docs.select(F.col(id_column).alias("doc_id"), by_line.alias("by_line"), by_text.alias("by_text"))
    named = found.select(
        "doc_id",
        F.array_join("by_line", "|").alias("sentences"),
        F.array_join("by_text", "|").alias("joined_sentences"),
        _sequence(F.col("by_line")).alias("s"),
        _sequence(F.col("by_text")).alias("j"),
        F.size("by_line").cast("bigint").alias("n_known"),
    )
    hits = []
    for licence, names in RULES:
        wanted = f"|{'|'.join(names)}|"
        hits.append(F.when(F.col("s").contains(wanted) | F.col("j").contains(wanted), F.lit(licence)))
    matched = F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))
    any_known = (F.length("s") > 2) | (F.length("j") > 2)
    return named.select(
        "doc_id",
        "sentences",
        "joined_sentences",
        F.when(any_known, F.array_join(matched, ";")).otherwise("").alias("licences"),
        "n_known",
    )
