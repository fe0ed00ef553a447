"""Licence scans by recognising sentences, then rules over their order.

A text is cut into sentences, each is normalised, and those that equal a known licence sentence are
replaced by its identifier. Rules are ordered lists of identifiers: a rule matches where its
identifiers occur one after the other, with anything between them. Rules are tried in their order;
all that match are reported, the first one is the licence of the text.

Sentences end at a full stop, exclamation or question mark before white space, and at blank lines,
so that sentences wrapped over lines are whole. A line without letters and digits, such as one of
comment marks, is blank. Known sentences of ``LONG`` words and more are cut out first, wherever they
stand, the longest first: no cut divides them, and no neighbour without a full stop hides them. Lines
are looked at as well, for notices whose neighbours lack a full stop; sentences found as lines only
come after the others, by name. An ``SPDX-License-Identifier`` line names its licence itself; its
expression stands before all sentences, as ``spdx:...``, and comes first among the licences.

Of the BSD licences only the closest is reported. "All rights reserved" makes a text proprietary only
where no grant follows it, since many licences begin with it.

All of it is SQL functions on the row of a document: no shuffle, no join. Null and empty texts give
no sentences and a null licence. Repeated rows and null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences and their notices, with identifiers.
SENTENCES = (
    ("all_rights", "All rights reserved."),
    ("apache_notice", "Licensed under the Apache License, Version 2.0."),
    ("apache_header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not '
     "use this file except in compliance with the License."),
    ("apache_copy", "You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit_notice", "Released under the MIT License."),
    ("mit_notice", "Licensed under the MIT License."),
    ("mit_title", "The MIT License"),
    ("mit_title", "MIT License"),
    ("mit_grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     'this software and associated documentation files (the "Software"), to deal in the Software '
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
     "to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit_notice_kept", "The above copyright notice and this permission notice shall be included "
     "in all copies or substantial portions of the Software."),
    ("bsd_grant", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met:"),
    ("bsd_notice", "Released under the BSD License."),
    ("bsd_binary", "Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other materials "
     "provided with the distribution."),
    ("bsd_advert", "All advertising materials mentioning features or use of this software must "
     "display the following acknowledgement"),
    ("bsd_endorse", "nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission."),
    ("isc_grant", "Permission to use, copy, modify, and/or distribute this software for any purpose "
     "with or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies."),
    ("zero_bsd_grant", "Permission to use, copy, modify, and/or distribute this software for any "
     "purpose with or without fee is hereby granted."),
    ("postgresql_grant", "Permission to use, copy, modify, and distribute this software and its "
     "documentation for any purpose, without fee, and without a written agreement is hereby "
     "granted, provided that the above copyright notice and this paragraph and the following two "
     "paragraphs appear in all copies."),
    ("zlib_grant", "Permission is granted to anyone to use this software for any purpose, including "
     "commercial applications, and to alter it and redistribute it freely, subject to the following "
     "restrictions:"),
    ("boost_grant", "Permission is hereby granted, free of charge, to any person or organization "
     'obtaining a copy of the software and accompanying documentation covered by this license (the '
     '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to '
     "prepare derivative works of the Software, and to permit third-parties to whom the Software is "
     "furnished to do so, all subject to the following:"),
    ("boost_notice", "Distributed under the Boost Software License, Version 1.0."),
    ("epl2_header", "This program and the accompanying materials are made available under the terms "
     "of the Eclipse Public License 2.0 which is available at "
     "https://www.eclipse.org/legal/epl-2.0/"),
    ("wtfpl_grant", "Everyone is permitted to copy and distribute verbatim or modified copies of "
     "this license document, and changing it is allowed as long as the name is changed."),
    ("ofl_notice", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("cc0_dedication", "To the extent possible under law, the author(s) have dedicated all copyright "
     "and related and neighboring rights to this software to the public domain worldwide."),
    ("gpl2_free", "under the terms of the GNU General Public License as published by the Free "
     "Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl2_only", "under the terms of the GNU General Public License version 2 as published by the "
     "Free Software Foundation."),
    ("lgpl2_free", "under the terms of the GNU Lesser General Public License as published by the "
     "Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
     "version."),
    ("lgpl3_free", "under the terms of the GNU Lesser General Public License as published by the "
     "Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version."),
    ("agpl3_free", "under the terms of the GNU Affero General Public License as published by the "
     "Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version."),
    ("gpl3_title", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("gpl2_title", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("lgpl3_title", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("lgpl2_title", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("agpl3_title", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("apache_title", "Apache License Version 2.0, January 2004"),
    ("mpl_title", "Mozilla Public License Version 2.0"),
    ("epl2_title", "Eclipse Public License - v 2.0"),
    ("boost_title", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("ofl_title", "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"),
    ("artistic2_title", "The Artistic License 2.0"),
    ("cddl_title", "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE Version 1.0 (CDDL-1.0)"),
    ("gpl3_notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl2_notice", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl_free", "This program is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("gpl_warranty", "This program is distributed in the hope that it will be useful, but WITHOUT "
     "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
     "PARTICULAR PURPOSE."),
    ("mpl_header", "This Source Code Form is subject to the terms of the Mozilla Public License, "
     "v. 2.0."),
    ("cc_by_nc_notice", "Licensed under CC BY-NC 4.0."),
    ("cc_by_notice", "Licensed under CC BY 4.0."),
    ("cc_by_sa_notice", "Licensed under CC BY-SA 4.0."),
    ("cc0_notice", "Released under CC0 1.0."),
    ("cc_by_work", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("cc_by_nc_work", "This work is licensed under a Creative Commons Attribution-NonCommercial "
     "4.0 International License."),
    ("public_domain", "This is free and unencumbered software released into the public domain."),
)

# Licences that notices call by name.
NAMED = (
    ("ISC License", "ISC"), ("zlib License", "Zlib"), ("Boost Software License 1.0", "BSL-1.0"),
    ("Mozilla Public License 2.0", "MPL-2.0"), ("Eclipse Public License 2.0", "EPL-2.0"),
    ("Apache License 2.0", "Apache-2.0"), ("BSD 2-Clause License", "BSD-2-Clause"),
    ("BSD 3-Clause License", "BSD-3-Clause"), ("PostgreSQL License", "PostgreSQL"),
    ("GNU General Public License v2.0", "GPL-2.0"), ("GNU General Public License v3.0", "GPL-3.0"),
    ("GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
    ("GNU Lesser General Public License, version 3", "LGPL-3.0"),
    ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    ("GNU Free Documentation License 1.3", "GFDL-1.3"), ("Artistic License 2.0", "Artistic-2.0"),
    ("SIL Open Font License 1.1", "OFL-1.1"), ("European Union Public Licence 1.2", "EUPL-1.2"),
    ("Common Development and Distribution License 1.0", "CDDL-1.0"),
    ("Microsoft Public License", "MS-PL"), ("Python Software Foundation License 2.0", "PSF-2.0"),
    ("Unlicense", "Unlicense"), ("WTFPL", "WTFPL"), ("MIT No Attribution License", "MIT-0"),
    ("Academic Free License 3.0", "AFL-3.0"), ("Open Software License 3.0", "OSL-3.0"),
    ("University of Illinois/NCSA Open Source License", "NCSA"),
    ("Open Data Commons Attribution License 1.0", "ODC-By-1.0"),
    ("Open Database License 1.0", "ODbL-1.0"), ("PHP License 3.01", "PHP-3.01"),
    ("Vim License", "Vim"), ("Server Side Public License 1", "SSPL-1.0"),
    ("Business Source License 1.1", "BUSL-1.1"), ("CeCILL License 2.1", "CECILL-2.1"),
    ("Mulan Permissive Software License v2", "MulanPSL-2.0"),
    ("Blue Oak Model License 1.0.0", "BlueOak-1.0.0"), ("Elastic License 2.0", "Elastic-2.0"),
    ("Open LDAP Public License v2.8", "OLDAP-2.8"),
)
# How a notice says so, and the licences of Creative Commons.
NOTICES = (
    "Released under the {}.", "Licensed under the {}.", "Distributed under the {}.",
    "This work is licensed under the {}.", "This project is licensed under the {}.",
)
COMMONS = (
    ("Attribution", "BY"), ("Attribution-ShareAlike", "BY-SA"), ("Attribution-NoDerivatives", "BY-ND"),
    ("Attribution-NonCommercial", "BY-NC"), ("Attribution-NonCommercial-ShareAlike", "BY-NC-SA"),
    ("Attribution-NonCommercial-NoDerivatives", "BY-NC-ND"),
)
VERSIONS = (("4.0", "4.0 International"), ("3.0", "3.0 Unported"))


def _named_sentences() -> list[tuple[str, str]]:
    """Identifiers ``is:<licence>`` and the sentences of notices that name a licence."""
    out = [(f"is:{name}", how.format(text)) for text, name in NAMED for how in NOTICES]
    for text, short in COMMONS:
        for version, full in VERSIONS:
            name = f"CC-{short}-{version}"
            work = f"This work is licensed under a Creative Commons {text} {full} License."
            out += [(f"is:{name}", work), (f"is:{name}", f"Licensed under CC {short} {version}.")]
    return out


#: Licence and the identifiers that must follow one another, in the order of trial.
RULES = (
    ("MIT", ("mit_grant", "mit_notice_kept")),
    ("MIT", ("mit_title", "mit_grant")),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_warranty")),
    ("GPL-3.0-or-later", ("gpl_free",)),
    ("Apache-2.0", ("apache_header", "apache_copy")),
    ("Apache-2.0", ("apache_header",)),
    ("BSD-4-Clause", ("bsd_grant", "bsd_advert")),
    ("BSD-3-Clause", ("bsd_grant", "bsd_endorse")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_binary")),
    ("BSD", ("bsd_grant",)),
    ("ISC", ("isc_grant",)),
    ("0BSD", ("zero_bsd_grant",)),
    ("PostgreSQL", ("postgresql_grant",)),
    ("Zlib", ("zlib_grant",)),
    ("BSL-1.0", ("boost_grant",)),
    ("BSL-1.0", ("boost_notice",)),
    ("BSL-1.0", ("boost_title",)),
    ("GPL-2.0-or-later", ("gpl2_free",)),
    ("GPL-2.0-only", ("gpl2_only",)),
    ("LGPL-2.1-or-later", ("lgpl2_free",)),
    ("LGPL-3.0-or-later", ("lgpl3_free",)),
    ("AGPL-3.0-or-later", ("agpl3_free",)),
    ("AGPL-3.0", ("agpl3_title",)),
    ("LGPL-3.0", ("lgpl3_title",)),
    ("LGPL-2.1", ("lgpl2_title",)),
    ("GPL-3.0", ("gpl3_title",)),
    ("GPL-2.0", ("gpl2_title",)),
    ("Apache-2.0", ("apache_title",)),
    ("MPL-2.0", ("mpl_title",)),
    ("EPL-2.0", ("epl2_header",)),
    ("EPL-2.0", ("epl2_title",)),
    ("WTFPL", ("wtfpl_grant",)),
    ("OFL-1.1", ("ofl_notice",)),
    ("OFL-1.1", ("ofl_title",)),
    ("Artistic-2.0", ("artistic2_title",)),
    ("CDDL-1.0", ("cddl_title",)),
    ("CC0-1.0", ("cc0_dedication",)),
    ("MPL-2.0", ("mpl_header",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_work",)),
    ("CC-BY-4.0", ("cc_by_work",)),
    ("GPL-3.0", ("gpl3_notice",)),
    ("GPL-2.0", ("gpl2_notice",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_notice",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_notice",)),
    ("CC-BY-4.0", ("cc_by_notice",)),
    ("Apache-2.0", ("apache_notice",)),
    ("MIT", ("mit_notice",)),
    ("BSD", ("bsd_notice",)),
    ("CC0-1.0", ("cc0_notice",)),
    ("Unlicense", ("public_domain",)),
    ("Proprietary", ("all_rights",)),
)

#: Licences of which only the first that matches is reported.
ONE_OF = ("BSD-4-Clause", "BSD-3-Clause", "BSD-2-Clause", "BSD")
RESERVED = "Proprietary"
#: What makes an earlier "All rights reserved" a phrase of the copyright line.
GRANTS = r"[a-z0-9_]*(grant|free|header)"
SPDX = "SPDX-License-Identifier:"
SPDX_EXPRESSION = SPDX + r"[ \t]*([A-Za-z0-9.+-]+( (OR|AND|WITH) [A-Za-z0-9.+-]+)*)"

BY_SENTENCE, BY_LINE = r"[.!?]+\s+|\n\s*\n", r"\n"
#: Words from which a known sentence can be no part of another by chance.
LONG = 12
_BREAK = "\x01"
_OTHER = r"[^\p{L}\p{N}" + _BREAK + r"]+"


def normalised(sentence: str) -> str:
    """A sentence as it is compared: lower case, everything but letters and digits one blank."""
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier; sentences stated above go before those made by rule."""
    made = {normalised(text): name for name, text in _named_sentences()}
    return made | {normalised(text): name for name, text in SENTENCES}


def long_sentences() -> dict[str, str]:
    """Long normalised sentences, the longest first, and the word that stands for each once cut out."""
    known = [s for s in known_sentences() if len(s.split()) >= LONG]
    return {s: f"zq{n}qz" for n, s in enumerate(sorted(known, key=lambda s: (-len(s), s)))}


def known_parts() -> dict[str, str]:
    """What a part of a text may equal, and its identifier."""
    known = known_sentences()
    return known | {word: known[s] for s, word in long_sentences().items()}


def _long_apart(text: Column) -> Column:
    """A text in lower case with the words of its long known sentences between breaks."""
    plain = out = F.regexp_replace(F.lower(text), r"\n[^\p{L}\p{N}\n\x01]+(?=\n)", "\n")
    may_hold = F.lit(False)
    rare: set[str] = set()
    for sentence, word in long_sentences().items():
        words = sentence.split()
        pattern = r"[^\p{L}\p{N}\x01]++".join(words)
        pattern = rf"(?<![\p{{L}}\p{{N}}]){pattern}(?![\p{{L}}\p{{N}}])"
        out = F.regexp_replace(out, pattern, _BREAK + word + _BREAK)
        rare.add(max(words, key=len))
    # Texts without the longest word of any sentence are told without patterns.
    for longest in sorted(rare):
        may_hold = may_hold | F.lower(text).contains(longest)
    return F.when(may_hold, out).otherwise(plain)


def _parts(text: Column, boundary: str) -> Column:
    """Normalised parts of a text between boundaries."""
    marked = F.regexp_replace(F.lower(text), boundary, _BREAK)
    plain = F.regexp_replace(marked, _OTHER, " ")
    return F.transform(F.split(plain, _BREAK), lambda s: F.trim(s))


def _identified(parts: Column) -> Column:
    known = known_parts()
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.transform(F.filter(parts, lambda s: s.isin(*known)), lambda s: names[s])


def rule_pattern(names: tuple[str, ...]) -> str:
    """A pattern over identifiers written as ``,a,b,``."""
    return "," + ",(.*,)?".join(names) + ","


def _matches(joined: Column) -> list[Column]:
    """The licences whose rules match, in order; null for each that does not."""
    rules = [(name, joined.rlike(rule_pattern(names))) for name, names in RULES if name != RESERVED]
    one = F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in rules if name in ONE_OF])
    out, placed = [], False
    for name, hit in rules:
        if name not in ONE_OF:
            out.append(F.when(hit, F.lit(name)))
        elif not placed:
            out.append(one)
            placed = True
    return out


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licenses, license`` for every document.

    ``sentence_ids`` and ``licenses`` are joined by commas; ``license`` is null where no rule
    matches.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spdx = F.when(
        text.contains(SPDX), F.regexp_extract_all(text, F.lit(SPDX_EXPRESSION), 1)
    ).otherwise(F.array().cast("array<string>"))
    # A generator is computed once; a projection would be put into both uses of it.
    apart = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), spdx.alias("spdx"),
        F.explode(F.array(_long_apart(text))).alias("apart"),
    )
    found = apart.select(
        "doc_id", "spdx",
        _identified(_parts(F.col("apart"), BY_SENTENCE)).alias("in_sentences"),
        _identified(_parts(F.col("apart"), BY_LINE)).alias("in_lines"),
    ).select(
        "doc_id", "spdx",
        F.concat(
            "in_sentences", F.array_sort(F.array_except("in_lines", "in_sentences"))
        ).alias("ids"),
    )
    ids = F.array_join("ids", ",")
    ruled = found.withColumn("joined", F.concat(F.lit(","), ids, F.lit(",")))
    named = F.transform(
        F.filter("ids", lambda i: i.startswith("is:")), lambda i: F.substring(i, 4, 100)
    )
    behind_grants = F.regexp_replace("joined", f"^.*,{GRANTS},", ",")
    reserved = F.when(behind_grants.contains(",all_rights,"), F.lit(RESERVED))
    ruled = ruled.withColumn("matched", F.array_distinct(F.concat(
        "spdx", F.array_compact(F.array(*_matches(F.col("joined")))), named,
        F.array_compact(F.array(reserved)),
    )))
    marked = F.concat(F.transform("spdx", lambda i: F.concat(F.lit("spdx:"), i)), F.col("ids"))
    return ruled.select(
        "doc_id",
        F.size(marked).cast("long").alias("n_sentences"),
        F.array_join(marked, ",").alias("sentence_ids"),
        F.array_join("matched", ",").alias("licenses"),
        F.get("matched", 0).alias("license"),
    )


def oracle() -> str:
    """The same scan in SQL, from the same tables of sentences and rules.

    Words of long sentences are told by ASCII letters and digits here.
    """
    names = ", ".join(f"'{k}': '{v}'" for k, v in known_parts().items())
    between = r"[^a-z0-9\x01]+"
    # Each twice, since what stands between two neighbours can only be taken once.
    cuts = ", ".join(
        f"'{max(sentence.split(), key=len)}#(^|[^a-z0-9]){between.join(sentence.split())}([^a-z0-9]|$)#{word}'"
        for sentence, word in long_sentences().items() for _ in range(2)
    )
    rules = [(name, f"regexp_matches(joined, '{rule_pattern(ids)}')") for name, ids in RULES]
    one = "CASE " + " ".join(f"WHEN {hit} THEN '{n}'" for n, hit in rules if n in ONE_OF) + " END"
    first = next(name for name, _ in rules if name in ONE_OF)
    matches = ", ".join(
        one if name == first else f"CASE WHEN {hit} THEN '{name}' END"
        for name, hit in rules if name != RESERVED and (name == first or name not in ONE_OF)
    )

    def identified(boundary: str) -> str:
        cut = boundary.replace(r"\s", r"[ \t\n\f\r\v]")
        plain = rf"regexp_replace(regexp_replace(apart, '{cut}', chr(1), 'g'), '[^\p{{L}}\p{{N}}\x01]+', ' ', 'g')"
        parts = f"[trim(s, ' ') for s in string_split({plain}, chr(1))]"
        return f"[known[s] for s in {parts} if list_contains(map_keys(known), s)]"

    return rf"""
WITH sentences AS (SELECT MAP {{{names}}} AS known, [{cuts}] AS cuts),
texts AS (
    SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '\n[^\p{{L}}\p{{N}}\n\x01]+\n', chr(10) || chr(10), 'g') AS t,
           regexp_extract_all(coalesce(text, ''), '{SPDX_EXPRESSION}', 1) AS spdx
    FROM documents
), aparts AS (
    SELECT doc_id, spdx, known, list_reduce(list_prepend(t, cuts), lambda a, c:
        CASE WHEN contains(a, split_part(c, '#', 1)) THEN regexp_replace(a, split_part(c, '#', 2),
            '\1' || chr(1) || split_part(c, '#', 3) || chr(1) || '\2', 'g') ELSE a END) AS apart
    FROM texts CROSS JOIN sentences
), found AS (
    SELECT doc_id, spdx, {identified(BY_SENTENCE)} AS a, {identified(BY_LINE)} AS b FROM aparts
), ids AS (
    SELECT doc_id, spdx, list_concat(a, list_sort([s for s in list_distinct(b) if NOT list_contains(a, s)])) AS ids
    FROM found
), joined AS (SELECT *, ',' || array_to_string(ids, ',') || ',' AS joined FROM ids
), matched AS (
    SELECT *, list_concat(list_concat(spdx, [s for s in [{matches}] if s IS NOT NULL]), list_concat(
        [substr(i, 4) for i in ids if starts_with(i, 'is:')],
        CASE WHEN contains(regexp_replace(joined, '^.*,{GRANTS},', ','), ',all_rights,')
             THEN ['{RESERVED}'] ELSE [] END)) AS m
    FROM joined
)
SELECT doc_id, (len(spdx) + len(ids))::BIGINT AS n_sentences,
       array_to_string(list_concat(['spdx:' || i for i in spdx], ids), ',') AS sentence_ids,
       array_to_string([m[i] for i in range(1, len(m) + 1) if list_position(m, m[i]) = i], ',')
           AS licenses,
       m[1] AS license
FROM matched
"""
