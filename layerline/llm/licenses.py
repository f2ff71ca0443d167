"""Licences by sentences: known sentences become identifiers, identifier sequences become licences.

A text is cut into sentences, each is normalised (lower case, single blanks, letters and digits only)
and searched for the known licence sentences; it becomes the identifiers of those it contains, in order of
their places. Rules are sequences of identifiers in order. Rules that share identifiers are a family: in it the
longest rule that fits at a place wins, and identifiers of other families between its own are passed
over, so a notice in the midst of a licence does not break it. Licences come in the order in which they
begin. Everything happens within a row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sentence:
    """What a normalised sentence must contain (a regular expression) to be this one.

    ``piece`` is what is found, where the pattern also looks at what stands before it.
    """

    id: str
    pattern: str
    piece: str = ""


@dataclass(frozen=True)
class Rule:
    licence: str
    sentences: tuple[str, ...]


# Public licence texts, normalised, and the licences they state.
SENTENCES = (
    Sentence("ApacheGrant", "licensed under the apache license version 2 0"),
    Sentence("ApacheCondition", "you may not use this file except in compliance with the license"),
    Sentence("ApacheCopy", "you may obtain a copy of the license at"),
    Sentence("ApacheWarranty", "distributed on an as is basis without warranties or conditions of any kind"),
    Sentence("MitName", "(released|licensed|available|distributed) under the( terms of the)? mit license"),
    Sentence("MitGrant", "permission is hereby granted free of charge to any person obtaining a copy"),
    Sentence("MitNotice", "above copyright notice and this permission notice shall be included in all copies"),
    Sentence("MitWarranty", "the software is provided as is without warranty of any kind"),
    Sentence("BsdGrant", "redistribution and use in source and binary forms with or without modification are permitted"),
    Sentence("BsdSource", "redistributions of source code must retain the above copyright notice"),
    Sentence("BsdBinary", "redistributions in binary form must reproduce the above copyright notice"),
    Sentence("BsdEndorse", "may be used to endorse or promote products derived from this software without specific"),
    Sentence("BsdWarranty", "this software is provided by .* as is and any express or implied warranties"),
    Sentence("Gpl3", "licensed under the gnu general public license version 3"),
    Sentence("Gpl2", "licensed under the gnu general public license version 2"),
    Sentence("GplGrant", "redistribute it and or modify it under the terms of the gnu general public license"),
    Sentence("Lgpl3", "licensed under the gnu lesser general public license version 3"),
    Sentence("Lgpl21", "licensed under the gnu lesser general public license version 2 1"),
    Sentence("LgplGrant", "redistribute it and or modify it under the terms of the gnu lesser general public license"),
    Sentence("Agpl3", "licensed under the gnu affero general public license version 3"),
    Sentence("AgplGrant", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    Sentence("GplLater", "either version [23]( 1)? of the license or at your option any later version"),
    Sentence("GplWarranty", "hope that it will be useful but without any warranty"),
    Sentence("CcByNc4", "licensed under (a )?(cc by nc 4 0|creative commons attribution noncommercial 4 0)"),
    Sentence("CcBySa4", "licensed under (a )?(cc by sa 4 0|creative commons attribution sharealike 4 0)"),
    Sentence("CcByNd4", "licensed under (a )?(cc by nd 4 0|creative commons attribution noderiv(ative)?s 4 0)"),
    Sentence("CcByNcSa4", "licensed under (a )?(cc by nc sa 4 0|creative commons attribution noncommercial sharealike 4 0)"),
    Sentence("CcByNcNd4", "licensed under (a )?(cc by nc nd 4 0|creative commons attribution noncommercial noderiv(ative)?s 4 0)"),
    Sentence("CcBy4", "licensed under (a )?(cc by 4 0|creative commons attribution 4 0)"),
    Sentence("Cc0", "(dedicated to the public domain|released under cc0|cc0 1 0 universal)"),
    Sentence("Mpl2", "subject to the terms of the mozilla public license v 2 0"),
    Sentence("IscName", "(released|licensed|available|distributed) under the( terms of the)? isc license"),
    Sentence("IscGrant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Sentence("IscWarranty", "the author disclaims all warranties with regard to this software"),
    Sentence("Unlicense", "this is free and unencumbered software released into the public domain"),
    Sentence("Epl2", "under the terms of the eclipse public license (v |version )?2 0"),
    Sentence("Epl1", "under the terms of the eclipse public license (v |version )?1 0"),
    Sentence("Copyright", "^copyright( c)? [0-9]{4}|all rights reserved"),
)
#: Licences that a file may name by their short identifiers.
SPDX = (
    "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "MPL-2.0", "EPL-1.0", "EPL-2.0",
    "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
    "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
)
RULES = (
    Rule("Apache-2.0", ("ApacheGrant", "ApacheCondition", "ApacheCopy", "ApacheWarranty")),
    Rule("Apache-2.0", ("ApacheGrant",)),
    Rule("MIT", ("MitGrant", "MitNotice", "MitWarranty")),
    Rule("MIT", ("MitName",)),
    Rule("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse", "BsdWarranty")),
    Rule("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdWarranty")),
    Rule("GPL-3.0", ("Gpl3",)),
    Rule("GPL-2.0", ("Gpl2",)),
    Rule("GPL-or-later", ("GplGrant", "GplLater", "GplWarranty")),
    Rule("GPL", ("GplGrant", "GplWarranty")),
    Rule("CC-BY-NC-4.0", ("CcByNc4",)),
    Rule("CC-BY-SA-4.0", ("CcBySa4",)),
    Rule("CC-BY-4.0", ("CcBy4",)),
    Rule("CC0-1.0", ("Cc0",)),
    Rule("MPL-2.0", ("Mpl2",)),
    Rule("LGPL-3.0", ("Lgpl3",)),
    Rule("LGPL-2.1", ("Lgpl21",)),
    Rule("LGPL-or-later", ("LgplGrant", "GplLater", "GplWarranty")),
    Rule("LGPL", ("LgplGrant", "GplWarranty")),
    Rule("AGPL-3.0", ("Agpl3",)),
    Rule("AGPL-or-later", ("AgplGrant", "GplLater", "GplWarranty")),
    Rule("AGPL", ("AgplGrant", "GplWarranty")),
    Rule("CC-BY-ND-4.0", ("CcByNd4",)),
    Rule("CC-BY-NC-SA-4.0", ("CcByNcSa4",)),
    Rule("CC-BY-NC-ND-4.0", ("CcByNcNd4",)),
    Rule("ISC", ("IscGrant", "IscWarranty")),
    Rule("ISC", ("IscName",)),
    Rule("Unlicense", ("Unlicense",)),
    Rule("EPL-2.0", ("Epl2",)),
    Rule("EPL-1.0", ("Epl1",)),
)


def spdx_sentences(names: tuple[str, ...] = SPDX) -> tuple[tuple[Sentence, ...], tuple[Rule, ...]]:
    """A sentence and a rule for each short identifier: the longest name after the tag, or after another one's."""
    sentences, rules = [], []
    for name in sorted(names, key=len, reverse=True):
        piece = re.sub("[^a-z0-9]+", " ", name.lower())
        before = "(?<=spdx license identifier (?:[a-z0-9 ]{1,60} (?:or|and) )?)"
        sentences.append(Sentence(f"Spdx:{name}", f"{before}{piece}(?= or | and | with | |$)", piece))
        rules.append(Rule(name, (f"Spdx:{name}",)))
    return tuple(sentences), tuple(rules)


_SPDX_SENTENCES, _SPDX_RULES = spdx_sentences()
SENTENCES, RULES = SENTENCES + _SPDX_SENTENCES, RULES + _SPDX_RULES

#: A sentence without any of these words matches none of the above.
HINT = "licen[sc]e|permission|warrant|redistribut|copyright|rights reserved|endorse|later version|cc0|public domain"

#: Ends of sentences; a line end alone does not end one, as licence texts are wrapped.
SENTENCE_END = r"[.!?:;]+(?=\s|$)|\n\s*\n"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def sentence_ids(sentence: Column, sentences: tuple[Sentence, ...]) -> Column:
    """The identifiers of the known sentences that a normalised one contains, by their places.

    Of sentences that begin at one place the first one listed counts; they do not overlap.
    """
    every = "|".join(f"(?:{known.pattern})" for known in sentences)

    def named(piece: Column) -> Column:
        found = F.when(F.lit(False), F.lit(""))
        for known in sentences:
            whole = f"^(?:{known.piece or known.pattern})$"
            found = found.when(F.regexp_like(piece, F.lit(whole)), F.lit(known.id))
        return found

    return F.transform(F.regexp_extract_all(sentence, F.lit(every), F.lit(0)), named)


def families(rules: tuple[Rule, ...]) -> list[tuple[Rule, ...]]:
    """Rules that share identifiers, also by way of others, together."""
    found: list[tuple[set[str], list[Rule]]] = []
    for rule in rules:
        ids, members = set(rule.sentences), [rule]
        for other in [f for f in found if f[0] & ids]:
            found.remove(other)
            ids |= other[0]
            members = other[1] + members
        found.append((ids, members))
    return [tuple(members) for _, members in found]


def _family_matches(chain: Column, family: tuple[Rule, ...]) -> Column:
    """(place, licence) of the family's rules in a chain of ``<place:identifier>``."""
    own = "|".join(sorted({re.escape(s) for rule in family for s in rule.sentences}))
    foreign = f"(?:<[0-9]+ (?!(?:{own})>)[^>]*>)*"
    ordered = sorted(family, key=lambda rule: -len(rule.sentences))
    spelt = [foreign.join(f"<[0-9]+ {re.escape(s)}>" for s in rule.sentences) for rule in ordered]

    def named(piece: Column) -> Column:
        licence = F.when(F.lit(False), F.lit(""))
        for rule, pattern in zip(ordered, spelt):
            licence = licence.when(F.regexp_like(piece, F.lit(f"^{pattern}$")), F.lit(rule.licence))
        place = F.regexp_extract(piece, "^<([0-9]+)", 1).cast("int")
        return F.struct(place.alias("place"), licence.alias("licence"))

    return F.transform(F.regexp_extract_all(chain, F.lit("|".join(spelt)), F.lit(0)), named)


def scan(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    sentences: tuple[Sentence, ...] = SENTENCES,
    rules: tuple[Rule, ...] = RULES,
    hint: str = HINT,
) -> DataFrame:
    """key, sentence_ids, licences (arrays of string, in order of the text) of each row.

    A null or empty text has neither; a licence stated twice is listed twice. Null keys and equal
    rows stay; very long texts are read whole; an empty table gives no rows; other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # The tag's colon ends no sentence.
    joined = F.regexp_replace(body, "(?i)(spdx-license-identifier):", "$1 ")
    likely = F.filter(
        F.transform(F.split(joined, SENTENCE_END), normalised),
        lambda s: F.regexp_like(s, F.lit(hint)),
    )
    ids = F.flatten(F.transform(likely, lambda s: sentence_ids(s, sentences)))
    found = (
        documents.select(F.col(key).alias(key), F.when(F.regexp_like(F.lower(body), F.lit(hint)), ids).alias("_ids"))
        .select(key, F.coalesce("_ids", F.array().cast("array<string>")).alias("sentence_ids"))
    )
    # Each identifier with its place in brackets, so that a rule is a piece of the string.
    spelt = F.transform("sentence_ids", lambda i, at: F.concat(F.lit("<"), at.cast("string"), F.lit(" "), i, F.lit(">")))
    matches = F.flatten(F.array(*(_family_matches(F.col("_chain"), family) for family in families(rules))))
    nothing = F.array().cast("array<string>")
    licences = F.transform(F.array_sort(matches), lambda m: m["licence"])
    return (
        found.withColumn("_chain", F.array_join(spelt, ""))
        .withColumn("licences", F.when(F.col("_chain") != "", licences).otherwise(nothing))
        .drop("_chain")
    )
