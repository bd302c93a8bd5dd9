"""Licences by sentence rules: known sentences get identifiers, identifier sequences match ordered rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sentence ends at a full stop before white space, at the end, or at an empty line.
BREAK = r"[.!?]+(?:[\x20\x09-\x0D]+|$)|\n[\x20\x09-\x0D]*\n"

# Identifier, and what the normalised sentence contains.
SENTENCES = (
    ("MITtitle", r"^(?:the )?mit licen[cs]e(?: mit)?$"),
    ("MITgrant", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MITnotice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("MITasis", r"the software is provided as is without warranty of any kind express or implied"),
    ("MITliable", r"in no event shall the authors or copyright holders be liable for any claim"),
    ("MITref", r"under (?:the )?(?:terms of the )?mit licen[cs]e"),
    ("ISCtitle", r"^(?:the )?isc licen[cs]e(?: isc)?$"),
    ("ISCgrant", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0BSDgrant", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted$"),
    ("ISCasis", r"the software is provided as is and the author disclaims all warranties"),
    ("ISCliable", r"in no event shall the author be liable for any special direct indirect or consequential damages"),
    ("ISCref", r"under (?:the )?(?:terms of the )?isc licen[cs]e"),
    ("Apache2title", r"^apache licen[cs]e version 2 0(?: january 2004)?(?: |$)"),
    ("Apache2ref", r"under (?:the )?(?:terms of the )?apache (?:software )?licen[cs]e (?:version |v|v )?2 0"),
    ("Apache2short", r"under (?:the )?(?:terms of the )?apache (?:version |v)?2 0 licen[cs]e"),
    ("ApacheUse", r"you may not use this file except in compliance with the licen[cs]e"),
    ("ApacheCopy", r"you may obtain a copy of the licen[cs]e at"),
    ("ApacheAsis", r"software distributed under the licen[cs]e is distributed on an as is basis"),
    ("ApacheSee", r"see the licen[cs]e for the specific language governing permissions"),
    ("GPL3later", r"gnu general public licen[cs]e (?:version |v)?3 (?:0 )?or (?:any )?later"),
    ("GPL3ref", r"under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v)3"),
    ("GPL2later", r"gnu general public licen[cs]e (?:version |v)?2 (?:0 )?or (?:any )?later"),
    ("GPL2ref", r"under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v)2"),
    ("GPLfree3", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e .*either version 3"),
    ("GPLfree2", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e .*either version 2"),
    ("GPLhope", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("GPLsee", r"see the gnu general public licen[cs]e for more details"),
    ("GPLcopy", r"you should have received a copy of the gnu general public licen[cs]e"),
    ("LGPL3later", r"gnu lesser general public licen[cs]e (?:version |v)?3 (?:0 )?or (?:any )?later"),
    ("LGPL3ref", r"under (?:the )?(?:terms of the )?gnu lesser general public licen[cs]e (?:version |v)3"),
    ("LGPL21later", r"gnu lesser general public licen[cs]e (?:version |v)?2 1 or (?:any )?later"),
    ("LGPL21ref", r"under (?:the )?(?:terms of the )?gnu lesser general public licen[cs]e (?:version |v)2 1"),
    ("LGPLfree3", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e .*either version 3"),
    ("LGPLfree21", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e .*either version 2 1"),
    ("LGPLhope", r"this library is distributed in the hope that it will be useful but without any warranty"),
    ("LGPLsee", r"see the gnu lesser general public licen[cs]e for more details"),
    ("LGPLcopy", r"you should have received a copy of the gnu lesser general public licen[cs]e"),
    ("AGPL3later", r"gnu affero general public licen[cs]e (?:version |v)?3 (?:0 )?or (?:any )?later"),
    ("AGPL3ref", r"under (?:the )?(?:terms of the )?gnu affero general public licen[cs]e (?:version |v)3"),
    ("AGPLfree3", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e .*either version 3"),
    ("AGPLsee", r"see the gnu affero general public licen[cs]e for more details"),
    ("AGPLcopy", r"you should have received a copy of the gnu affero general public licen[cs]e"),
    ("BSDpre", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSDsource", r"redistributions of source code must retain the above copyright notice"),
    ("BSDbinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSDendorse", r"may be used to endorse or promote products derived from this software"),
    ("BSDasis", r"this software is provided by the copyright holders and contributors as is"),
    ("BSDliable", r"in no event shall the copyright (?:holder|owner|holders) or contributors be liable"),
    ("BSD3ref", r"under (?:the |a )?(?:terms of the )?(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: |$)"),
    ("BSD2ref", r"under (?:the |a )?(?:terms of the )?(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: |$)"),
    ("MPL2ref", r"(?:subject to|under) (?:the )?(?:terms of the )?mozilla public licen[cs]e (?:version |v|v )?2 0"),
    ("EPL2ref", r"under (?:the )?(?:terms of the )?eclipse public licen[cs]e (?:version |v|v )?2 0"),
    ("EPL1ref", r"under (?:the )?(?:terms of the )?eclipse public licen[cs]e (?:version |v|v )?1 0"),
    ("BSL1ref", r"under (?:the )?(?:terms of the )?boost software licen[cs]e (?:version |v)?1 0"),
    ("CCBY4ref", r"under (?:a |the )?(?:cc by|creative commons attribution) 4 0"),
    ("CCBYSA4ref", r"under (?:a |the )?(?:cc by sa|creative commons attribution share ?alike) 4 0"),
    ("CCBYND4ref", r"under (?:a |the )?(?:cc by nd|creative commons attribution no ?derivatives|creative commons attribution no ?derivs) 4 0"),
    ("CCBYNC4ref", r"under (?:a |the )?(?:cc by nc|creative commons attribution non ?commercial) 4 0"),
    ("CCBYNCSA4ref", r"under (?:a |the )?(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0"),
    ("CCBYNCND4ref", r"under (?:a |the )?(?:cc by nc nd|creative commons attribution non ?commercial no ?derivatives) 4 0"),
    ("CC0ref", r"(?:cc0 1 0 universal|dedicated (?:the work |this work |this software )?to the public domain)"),
    ("UnlicenseFree", r"this is free and unencumbered software released into the public domain"),
    ("UnlicenseAnyone", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("PublicDomain", r"(?:released into|placed in|placed into) the public domain"),
    ("AllRights", r"all rights reserved"),
    ("CopyrightLine", r"(?:^| )copyright (?:c )?[0-9]{4}"),
)

# The licences known by their tags.
TAGGED = (
    "MIT", "MIT-0", "ISC", "0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense",
    "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later",
    "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-ND-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
)


def _spoken(tag: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", tag.lower())


# A tag is followed by a blank or the end; longer tags stand first, so a sequence begins with them.
SENTENCES += tuple(
    (f"Tag:{tag}", rf"spdx licen[cs]e identifier {_spoken(tag)}(?: |$)") for tag in sorted(TAGGED, key=lambda t: (-len(t), t))
)

#: What normalisation makes a blank of.
GAP = r"[^\p{L}\p{N}]+"
#: A version and all that follow it.
LATER = r"([0-9])\+"
_HINTS = ("licen[cs]e", "copyright", "rights reserved", "permission", "redistribut", "warrant", "public domain", "creative commons", "bsd", "cc by")


def branches(pattern: str) -> list[str]:
    """The alternatives of a pattern of ``SENTENCES`` without its groups, each set of characters as the first of them."""
    pattern = re.sub(r"\[(.)[^]]*\]", r"\1", pattern)
    group = re.search(r"\(\?:([^()]*)\)(\?)?", pattern)
    if not group:
        return [pattern]
    options = group[1].split("|") + ([""] if group[2] else [])
    return [b for o in options for b in branches(pattern[: group.start()] + o + pattern[group.end() :])]


def _hint() -> str:
    """The usual words, and every alternative of a known sentence that has none of them; so each known sentence has a hint."""
    usual = "|".join(_HINTS)
    others = [b for _, pattern in SENTENCES for b in branches(pattern) if not re.search(usual, b)]
    return "(?i)" + "|".join(h.replace(" ", GAP) for h in dict.fromkeys((*_HINTS, *others)))


#: Documents and sentences without any of these say nothing about a licence.
HINT = _hint()

# Licence, and the sequence of identifiers it takes; the first rule that matches takes its sentences.
RULES = (
    ("MIT", ("MITtitle", "MITgrant", "MITnotice", "MITasis", "MITliable")),
    ("MIT", ("MITgrant", "MITnotice", "MITasis", "MITliable")),
    ("MIT", ("MITgrant", "MITnotice", "MITasis")),
    ("ISC", ("ISCtitle", "ISCgrant", "ISCasis", "ISCliable")),
    ("ISC", ("ISCgrant", "ISCasis", "ISCliable")),
    ("0BSD", ("0BSDgrant", "ISCasis", "ISCliable")),
    ("Apache-2.0", ("Apache2ref", "ApacheUse", "ApacheCopy", "ApacheAsis", "ApacheSee")),
    ("AGPL-3.0-or-later", ("AGPLfree3", "GPLhope", "AGPLsee", "AGPLcopy")),
    ("LGPL-3.0-or-later", ("LGPLfree3", "LGPLhope", "LGPLsee", "LGPLcopy")),
    ("LGPL-3.0-or-later", ("LGPLfree3", "GPLhope", "LGPLsee", "LGPLcopy")),
    ("LGPL-2.1-or-later", ("LGPLfree21", "LGPLhope", "LGPLsee", "LGPLcopy")),
    ("LGPL-2.1-or-later", ("LGPLfree21", "GPLhope", "LGPLsee", "LGPLcopy")),
    ("GPL-3.0-or-later", ("GPLfree3", "GPLhope", "GPLsee", "GPLcopy")),
    ("GPL-2.0-or-later", ("GPLfree2", "GPLhope", "GPLsee", "GPLcopy")),
    ("BSD-3-Clause", ("BSDpre", "BSDsource", "BSDbinary", "BSDendorse", "BSDasis", "BSDliable")),
    ("BSD-2-Clause", ("BSDpre", "BSDsource", "BSDbinary", "BSDasis", "BSDliable")),
    ("Unlicense", ("UnlicenseFree", "PublicDomain", "UnlicenseAnyone")),
    ("Unlicense", ("UnlicenseFree", "PublicDomain")),
    ("Apache-2.0", ("Apache2title",)),
    ("Apache-2.0", ("Apache2ref",)),
    ("Apache-2.0", ("Apache2short",)),
    ("MIT", ("MITref",)),
    ("MIT", ("MITgrant",)),
    ("MIT", ("MITtitle",)),
    ("ISC", ("ISCref",)),
    ("ISC", ("ISCgrant",)),
    ("ISC", ("ISCtitle",)),
    ("0BSD", ("0BSDgrant",)),
    ("AGPL-3.0-or-later", ("AGPL3later", "AGPL3ref")),
    ("AGPL-3.0-or-later", ("AGPL3later",)),
    ("AGPL-3.0-only", ("AGPL3ref",)),
    ("AGPL-3.0-or-later", ("AGPLfree3",)),
    ("LGPL-3.0-or-later", ("LGPL3later", "LGPL3ref")),
    ("LGPL-3.0-or-later", ("LGPL3later",)),
    ("LGPL-3.0-only", ("LGPL3ref",)),
    ("LGPL-2.1-or-later", ("LGPL21later", "LGPL21ref")),
    ("LGPL-2.1-or-later", ("LGPL21later",)),
    ("LGPL-2.1-only", ("LGPL21ref",)),
    ("LGPL-3.0-or-later", ("LGPLfree3",)),
    ("LGPL-2.1-or-later", ("LGPLfree21",)),
    ("GPL-3.0-or-later", ("GPL3later", "GPL3ref")),
    ("GPL-3.0-or-later", ("GPL3later",)),
    ("GPL-3.0-only", ("GPL3ref",)),
    ("GPL-2.0-or-later", ("GPL2later", "GPL2ref")),
    ("GPL-2.0-or-later", ("GPL2later",)),
    ("GPL-2.0-only", ("GPL2ref",)),
    ("GPL-3.0-or-later", ("GPLfree3",)),
    ("GPL-2.0-or-later", ("GPLfree2",)),
    ("BSD-3-Clause", ("BSD3ref",)),
    ("BSD-2-Clause", ("BSD2ref",)),
    ("MPL-2.0", ("MPL2ref",)),
    ("EPL-2.0", ("EPL2ref",)),
    ("EPL-1.0", ("EPL1ref",)),
    ("BSL-1.0", ("BSL1ref",)),
    ("CC-BY-4.0", ("CCBY4ref",)),
    ("CC-BY-SA-4.0", ("CCBYSA4ref",)),
    ("CC-BY-ND-4.0", ("CCBYND4ref",)),
    ("CC-BY-NC-4.0", ("CCBYNC4ref",)),
    ("CC-BY-NC-SA-4.0", ("CCBYNCSA4ref",)),
    ("CC-BY-NC-ND-4.0", ("CCBYNCND4ref",)),
    ("CC0-1.0", ("CC0ref",)),
    ("Public-domain", ("PublicDomain",)),
)
# A tag without "only" or "or later" means the version alone. A sentence with a longer tag has the shorter one's identifier next to it.
_VERSION_ALONE = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
RULES += tuple(
    (f"{tag}-only" if tag in _VERSION_ALONE else tag, (f"Tag:{tag}", *(f"Tag:{t}" for t in TAGGED if tag.startswith(f"{t}-"))))
    for tag in sorted(TAGGED, key=lambda t: (-len(t), t))
)
RULES += (
    ("All-rights-reserved", ("CopyrightLine", "AllRights")),
    ("All-rights-reserved", ("AllRights",)),
)


def rule_text(identifiers: tuple[str, ...]) -> str:
    return "".join(f"[{i}]" for i in identifiers)


def _normalised(sentence: Column) -> Column:
    """Words between single blanks; a plus after a version is written out."""
    later = F.regexp_replace(F.lower(sentence), LATER, "$1 or later ")
    return F.trim(F.regexp_replace(later, GAP, " "))


def sentence_ids(text: Column) -> Column:
    """(n, ids): sentences that hint at a licence, and the identifiers found in them, in order."""

    def of(sentence: Column) -> Column:
        return F.array_compact(F.array(*[F.when(sentence.rlike(pattern), name) for name, pattern in SENTENCES]))

    hinting = F.filter(F.split(text, BREAK, -1), lambda s: s.rlike(HINT))
    ids = F.transform(F.transform(hinting, _normalised), of)
    none = F.expr("cast(array() as array<array<string>>)")
    return F.when(text.rlike(HINT), ids).otherwise(none)


def apply_rules(sequence: Column) -> Column:
    """(left, hits): each rule in turn takes its identifiers, leaving a bar; ``hits`` names those that found any."""
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(rule_text(ids)).alias("text")) for name, ids in RULES])

    def state(left: Column, hits: Column) -> Column:
        return F.struct(left.alias("left"), hits.alias("hits"))

    def step(s: Column, rule: Column) -> Column:
        taken = state(F.replace(s["left"], rule["text"], F.lit("|")), F.array_append(s["hits"], rule["name"]))
        return F.when(F.contains(s["left"], rule["text"]), taken).otherwise(s)

    start = state(sequence, F.expr("cast(array() as array<string>)"))
    return F.when(sequence == "", start).otherwise(F.aggregate(rules, start, step))


def find_licences(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, n_unknown, sentence_ids, licences, unmatched) per row of ``docs``; no shuffle.

    ``n_sentences`` hint at a licence, ``n_unknown`` of them match no known sentence. ``licences``
    lists each licence once, in the order of the rules; ``unmatched`` identifiers fit no rule. Null and empty
    texts have none, very long ones are read whole, in one row; repeated rows each get their line; other columns are ignored; an empty table gives no rows.
    """
    found = docs.select("doc_id", sentence_ids(F.coalesce("text", F.lit(""))).alias("s"))
    sequence = F.array_join(F.transform(F.flatten("s"), lambda i: F.concat(F.lit("["), i, F.lit("]"))), "")
    found = found.select("doc_id", "s", apply_rules(sequence).alias("m"))
    return found.select(
        "doc_id",
        F.size("s").cast("long").alias("n_sentences"),
        F.size(F.filter("s", lambda i: F.size(i) == 0)).cast("long").alias("n_unknown"),
        F.array_join(F.flatten("s"), ",").alias("sentence_ids"),
        F.array_join(F.array_distinct("m.hits"), ",").alias("licences"),
        F.replace("m.left", F.lit("|"), F.lit("")).alias("unmatched"),
    )
