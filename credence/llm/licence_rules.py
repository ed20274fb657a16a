"""Licence scan by sentence rules.

Texts are cut into sentences, sentences normalised and mapped to the identifiers of known licence
sentences; unknown sentences are skipped. A licence is recognised where the identifiers of one of
its rules follow each other. Rules are ordered: the first that matches names the document's main
licence.

A known sentence begins and ends at sentence punctuation, a semicolon or a line's edge, and may run
over single line breaks and semicolons inside: notices are wrapped, often in comments. What stands
before a line's first word (comment marks, list marks) does not count; blank lines end a sentence.
``SENTENCES`` are the short forms, ``NOTICES`` the sentences of the standard texts, as patterns of
words. The SQL twin knows the short forms on one line; on texts without wrapped or standard
sentences both agree.

Defined results: null and empty texts have no sentences and no licence; repeated rows are scanned
each; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.work import let, text_of

SENTENCES = {
    "mit-name": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of "
                 "this software and associated documentation files the software to deal in the "
                 "software without restriction",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all "
                  "copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied",
    "apache-2": "licensed under the apache license version 2 0",
    "apache-comply": "you may not use this file except in compliance with the license",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the "
                "terms of the gnu general public license as published by the free software "
                "foundation either version 3 of the license or at your option any later version",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "bsd-source": "redistributions of source code must retain the above copyright notice this "
                  "list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this "
                  "list of conditions and the following disclaimer in the documentation and or "
                  "other materials provided with the distribution",
}
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-2", "apache-comply")),
    ("GPL-3.0", ("gpl-free",)),
    ("GPL-3.0", ("gpl-3",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("Apache-2.0", ("apache-2",)),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-licensed",)),
)
#: Licences by the words that name them in a notice such as "distributed under the ...".
NAMES = {
    "MIT": "(the )?(mit|expat)( x11)? licen[sc]e",
    "Apache-2.0": "(the )?apache(?: software)? licen[sc]e(?: version| v)? ?2( 0)?( the license)?",
    "BSD-2-Clause": "(the |a )?(simplified bsd|bsd 2 clause|2 clause bsd|freebsd) licen[sc]e",
    "BSD-3-Clause": "(the |a )?(new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd) "
                    "licen[sc]e",
    "ISC": "(the )?isc licen[sc]e",
    "MPL-2.0": "(the )?mozilla public licen[sc]e(?: version| v)? ?2( 0)?",
    "EPL-2.0": "(the )?eclipse public licen[sc]e(?: version| v)? ?2( 0)?",
    "BSL-1.0": "(the )?boost software licen[sc]e(?: version)?( 1 0)?",
    "Unlicense": "(the )?unlicense",
    "LGPL-2.0": "(the )?gnu library general public licen[sc]e(?: version| v)? ?2( 0)?",
    "LGPL-2.1": "(the )?gnu lesser general public licen[sc]e(?: version| v)? ?2 1",
    "LGPL-3.0": "(the )?gnu lesser general public licen[sc]e(?: version| v)? ?3( 0)?",
    "AGPL-3.0": "(the )?gnu affero general public licen[sc]e(?: version| v)? ?3( 0)?",
    "GPL-2.0": "(the )?gnu general public licen[sc]e(?: version| v)? ?2( 0)?",
    "GPL-3.0": "(the )?gnu general public licen[sc]e(?: version| v)? ?3( 0)?",
    "CC-BY-NC-4.0": "(a |the )?(creative commons attribution non ?commercial 4 0 international|"
                    "cc by nc 4 0)( licen[sc]e)?",
    "CC-BY-SA-4.0": "(a |the )?(creative commons attribution share ?alike 4 0 international|"
                    "cc by sa 4 0)( licen[sc]e)?",
    "CC-BY-4.0": "(a |the )?(creative commons attribution 4 0 international|cc by 4 0)"
                 "( licen[sc]e)?",
    "CC0-1.0": "(a |the )?(creative commons zero v?1 0 universal|cc0 1 0( universal)?)"
               "( licen[sc]e)?",
}
_GNU = ("[a-z0-9 ]{{1,60}}?is free software you can redistribute it and or modify it under the "
        "terms of( version {0} of the gnu {1} as published by the free software foundation|"
        " the gnu {1} as published by the free software foundation( either)? version {0}"
        "( of the license)?)( or at your option any later version| only)?")
#: Sentences of the standard texts; single blanks part the words.
NOTICES = {
    "mit-grant": SENTENCES["mit-grant"] + " including without limitation the rights to use copy "
                 "modify merge publish distribute sublicense and or sell copies of the software "
                 "and to permit persons to whom the software is furnished to do so subject to the "
                 "following conditions",
    "mit-notice": "the above copyright notice and this permission notice( including the next "
                  "paragraph)? shall be included in all copies or substantial portions of the "
                  "software",
    "as-is": "the software is provided as is without warranty of any kind express or implied "
             "including but not limited to the warranties of merchantability fitness for a "
             "particular purpose( title)? and non ?infringement",
    "apache-2": "(licensed|the [a-z0-9 ]{1,80}?licenses this (file|work|software) to you) under "
                "the apache license version 2 0 the license",
    "apache-comply": "(you|and you) may not use this (file|work|software) except in compliance "
                     "with the license",
    "apache-text": "apache license version 2 0 january 2004",
    "bsd-use": "redistribution and use (in|of) [a-z0-9 ]{0,80}with or without modification are "
               "permitted( subject to the limitations in the disclaimer below)? provided that the "
               "following conditions are met( [0-9])?",
    "bsd-source": "redistributions of source code must retain the above copyright( notices?)?( s)? "
                  "this list of conditions and the following disclaimers?( and)?",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright( notices?)?( s)? "
                  "this list of conditions and the following disclaimers? in the "
                  "documentation and or other materials provided with the distribution( and)?",
    "bsd-name": "(neither the (name|names) of [a-z0-9 ]{1,200}?(nor|or)( the names of)? [a-z0-9 ]"
                "{1,120}?may be used to endorse or promote products derived from this software "
                "without( specific)? prior written permission|the names? of [a-z0-9 ]{1,200}?may "
                "not be used to endorse or promote products derived from this software without( "
                "specific)? prior written permission)",
    "bsd-advert": "all advertising materials mentioning features or use of this software must "
                  "display the following acknowledge?ment( this product includes software "
                  "developed by [a-z0-9 ]{1,200}?)?",
    "0bsd-grant": "permission to use copy modify and (or )?distribute this software for any "
                  "purpose with or without fee is hereby granted",
    "isc-grant": "permission to use copy modify and (or )?distribute this software for any purpose "
                 "with or without fee is hereby granted provided that the above copyright notice "
                 "and this permission notice appear in all copies",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license version "
             "2 0",
    "mpl-obtain": "if a copy of the mpl was not distributed with this file you can obtain one at "
                  "https? (www )?mozilla org mpl 2 0",
    "cc0-text": "(creative commons )?cc0 1 0 universal",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "bsl-use": "(distributed|use modification and distribution (is|are) subject to|distributed "
               "under) (under )?the boost software license version 1 0",
    "bsl-grant": "permission is hereby granted free of charge to any person or organization "
                 "obtaining a copy of the software and accompanying documentation covered by this "
                 "license the software to use reproduce display distribute execute and transmit "
                 "the software and to prepare derivative works of the software and to permit third "
                 "parties to whom the software is furnished to do so all subject to the following",
    "gpl-2-header": _GNU.format(2, "general public license"),
    "gpl-free": _GNU.format(3, "general public license"),
    "gpl-2-text": "gnu general public license version 2 june 1991",
    "gpl-3-text": "gnu general public license version 3 29 june 2007",
    "lgpl-2-header": _GNU.format(2, "library general public license"),
    "lgpl-21-header": _GNU.format("2 1", "lesser general public license"),
    "lgpl-3-header": _GNU.format(3, "lesser general public license"),
    "lgpl-21-text": "gnu lesser general public license version 2 1 february 1999",
    "lgpl-3-text": "gnu lesser general public license version 3 29 june 2007",
    "agpl-3-header": _GNU.format(3, "affero general public license"),
    "agpl-3-text": "gnu affero general public license version 3 19 november 2007",
} | {
    "under-" + name.lower(): "((this|the) [a-z0-9]+ (is|are) |it is |code is )?(dual )?(licensed|"
    "released|distributed|available|made available|provided) under (the terms of )?"
    f"{words}( only| or later| or at your option any later version)?( see (the )?(accompanying )?"
    "(file )?licen[sc]e( (md|txt))?( file)?( for( more)? (details|information))?)?"
    for name, words in NAMES.items()
} | {
    "spdx-" + name.lower(): "spdx license identifier "
    + name.lower().replace("-", " ").replace(".", " ") + "( only| or later)?"
    for name in NAMES
}
#: More rules, in front of the short forms' rules where these would name less.
NOTICE_RULES = (
    ("BSD-4-Clause", ("bsd-source", "bsd-binary", "bsd-advert")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-name")),
    ("0BSD", ("0bsd-grant",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-form", "mpl-obtain")),
    ("MPL-2.0", ("mpl-2",)),
    ("CC0-1.0", ("cc0-text",)),
    ("Unlicense", ("unlicense",)),
    ("BSL-1.0", ("bsl-grant",)),
    ("BSL-1.0", ("bsl-use",)),
    ("Apache-2.0", ("apache-text",)),
    ("AGPL-3.0", ("agpl-3-header",)),
    ("AGPL-3.0", ("agpl-3-text",)),
    ("LGPL-3.0", ("lgpl-3-header",)),
    ("LGPL-3.0", ("lgpl-3-text",)),
    ("LGPL-2.0", ("lgpl-2-header",)),
    ("LGPL-2.1", ("lgpl-21-header",)),
    ("LGPL-2.1", ("lgpl-21-text",)),
    ("GPL-2.0", ("gpl-2-header",)),
    ("GPL-2.0", ("gpl-2-text",)),
    ("GPL-3.0", ("gpl-3-text",)),
)
NAME_RULES = tuple((name, (kind + name.lower(),)) for name in NAMES
                   for kind in ("under-", "spdx-"))
#: Rules that do not hold where the sequence goes on like this: two clauses of three.
NOT_BEFORE = {("bsd-source", "bsd-binary"): "bsd-(name|advert)"}
#: Every known sentence holds one of these, so texts without any need no cutting.
HINT = r"(?i)licen[sc]e|released|permission|software|redistribution|creative|\bcc|mozilla"
_BLANK = r"[\x20\x09-\x0D]"


def _known(words: str) -> str:
    """A pattern of words in which any blank may be a line break or semicolon."""
    return words.replace("[a-z0-9 ]", "[a-z0-9\0]").replace(" ?", "\1").replace(
        " ", "[ N]").replace("\0", " N").replace("\1", "[ N]?")


#: Longer ones first: where two begin at one place, the one that covers more is meant.
_ANY = "|".join(_known(s) for s in sorted([*SENTENCES.values(), *NOTICES.values()],
                                          key=len, reverse=True))


def cut_words(text: Column) -> Column:
    """The text's words in lower case, ``N`` at soft edges (line breaks, semicolons), ``X`` at hard."""
    steps = (
        (r"(^|\n)[^a-z0-9\n]*(?:(?:dnl|rem)[\x20\x09]+[^a-z0-9\n]*)?"
         r"(?:[a-z0-9]{1,3}\)[\x20\x09]+)?", "$1"),
        (rf"(?<![.!?;]);++(?={_BLANK}|$)", "N"),
        (rf"(?<![.!?;])[.!?;]++(?={_BLANK}|$)", "X"), (r"\n", "N"),
        (r"[^a-z0-9NX]+", " "), (r" ?([NX]) ?", "$1"), (r"N*X[NX]*|NN+", "X"))
    words = F.lower(text)
    for k, (pattern, to) in enumerate(steps):
        words = F.regexp_replace(words, pattern, to)
        words = F.concat(F.lit("X"), words, F.lit("X")) if k == 3 else words
    return words


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    short = F.create_map(*[F.lit(x) for name, s in SENTENCES.items() for x in (s, name)])

    def name_of(sentence):
        other = F.coalesce(*[F.when(sentence.rlike(f"^(?:{s})$"), F.lit(name))
                             for name, s in NOTICES.items()])
        return F.coalesce(F.try_element_at(short, sentence), other)

    found = F.transform(
        F.regexp_extract_all(cut_words(text), F.lit(f"(?<=[NX])(?:{_ANY})(?=[NX])"), F.lit(0)),
        lambda x: name_of(F.translate(x, "N", " ")))
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def matched(ids: Column) -> Column:
    """Licences whose rules match, in rule order, each once."""
    sequence = F.concat(F.lit(","), F.regexp_replace(F.array_join(ids, ","), ",", ",,"), F.lit(","))

    def holds(rule):
        run = "," + ",,".join(rule) + ","
        if rule not in NOT_BEFORE:
            return F.contains(sequence, F.lit(run))
        return sequence.rlike(f"{run}(?!,{NOT_BEFORE[rule]},)")

    hits = F.array(*[F.when(holds(rule), F.lit(name))
                     for name, rule in (*NOTICE_RULES, *RULES, *NAME_RULES)])
    return F.array_distinct(F.filter(hits, lambda x: x.isNotNull()))


def scan_licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences known, their identifiers, the licences and the main one."""
    def result(ids):
        return let(matched(ids), lambda names: F.struct(
            F.size(ids).cast("long").alias("n_sentences"),
            F.array_join(ids, ",").alias("sentence_ids"),
            F.array_join(names, ",").alias("licences"), F.get(names, F.lit(0)).alias("main")))

    return (docs.select("doc_id", let(identifiers(text_of()), result).alias("r"))
            .select("doc_id", "r.*"))


_VALUES = ", ".join(f"('{s}', '{name}')" for name, s in SENTENCES.items())
_HITS = ", ".join(f"CASE WHEN contains(seq, ',{','.join(rule)},') THEN '{name}' END"
                  for name, rule in RULES)
ORACLE = rf"""
WITH known(sentence, id) AS (VALUES {_VALUES}),
d AS (SELECT row_number() OVER () AS r, doc_id,
             string_split_regex(regexp_replace(coalesce(text, ''),
               '[.!?;]+([\x20\x09-\x0D]|$)', chr(10) || '\1', 'g'), '\n') AS parts
      FROM documents),
s AS (SELECT r, i, trim(regexp_replace(lower(parts[i]), '[^a-z0-9]+', ' ', 'g')) AS sentence
      FROM (SELECT r, parts, unnest(range(1, len(parts) + 1)) AS i FROM d)),
g AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY i) AS ids
      FROM s JOIN known USING (sentence) GROUP BY r),
q AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids,
             ',' || coalesce(ids, '') || ',' AS seq FROM d LEFT JOIN g USING (r)),
h AS (SELECT *, list_filter([{_HITS}], lambda x: x IS NOT NULL) AS hits FROM q),
u AS (SELECT *, list_filter(hits, lambda x, i: list_position(hits, x) = i) AS names FROM h)
SELECT doc_id, n_sentences, sentence_ids, array_to_string(names, ',') AS licences,
       names[1] AS main
FROM u
"""
