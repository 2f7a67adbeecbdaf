"""Licence recognition by sentences.

Texts are cut into sentences, whose lines are joined, each is normalised and mapped to the identifier of a known
licence sentence, and the sequence of identifiers is matched against ordered rules. The
first rule that matches wins; the sentences it explains are taken out and the rules are
tried again, so a text can hold several licences. Known sentences that no rule explains
make the licence ``UNKNOWN``.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers of sentences that licence texts and notices are made of, each
# with the regular expression its normalised sentence has to match as a whole.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("ApacheNotice", r"(.* )?licensed under the apache license,? (version )?2(\.0)?( .*)?"),
    ("ApacheSee", r"you may not use this file except in compliance with the license"),
    ("MitNotice", r"(.* )?((released|licensed|distributed) under )(the )?(terms of the )?mit license( .*)?"),
    ("MitGrant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy .*"),
    ("MitCondition", r"the above copyright notice and this permission notice shall be included in .*"),
    ("GplThree", r"(.* )?(licensed|released|distributed) under (the )?(terms of the )?(gnu )?general public license,? (version|v) ?3(\.0)?( .*)?"),
    ("GplTwo", r"(.* )?(licensed|released|distributed) under (the )?(terms of the )?(gnu )?general public license,? (version|v) ?2(\.0)?( .*)?"),
    ("GplFree", r"this program is free software:? you can redistribute it and/or modify it under the terms of the gnu general public license .*"),
    ("GplVersionThree", r"either version 3 of the license.*"),
    ("GplVersionTwo", r"either version 2 of the license.*"),
    ("BsdRedistribution", r"redistribution and use in source and binary forms.*"),
    ("BsdEndorse", r"neither the name of .* nor the names of its contributors .*"),
    ("CcByNc", r"(.* )?(licensed|released) under (a |the )?(cc|creative commons) by-nc[ -]?4(\.0)?( .*)?"),
    ("CcBySa", r"(.* )?(licensed|released) under (a |the )?(cc|creative commons) by-sa[ -]?4(\.0)?( .*)?"),
    ("CcBy", r"(.* )?(licensed|released) under (a |the )?(cc|creative commons) by[ -]?4(\.0)?( .*)?"),
    ("AsIs", r"(the|this) software is provided .*as is.*"),
    ("AllRights", r"(.* )?all rights reserved"),
)
# Licences with the identifier sequences they are made of, in the order in
# which they are tried. Sequences are written as <A><B>; a part in (...)? may be missing.
RULES: tuple[tuple[str, str], ...] = (
    ("GPL-3.0", "<GplFree><GplVersionThree>"),
    ("GPL-2.0", "<GplFree><GplVersionTwo>"),
    ("MIT", "(<AllRights>)?<MitGrant>(<MitCondition>)?(<AsIs>)?"),
    ("BSD-3-Clause", "(<AllRights>)?<BsdRedistribution><BsdEndorse>(<AsIs>)?"),
    ("BSD-2-Clause", "(<AllRights>)?<BsdRedistribution>(<AsIs>)?"),
    ("Apache-2.0", "<ApacheNotice>(<ApacheSee>)?"),
    ("GPL-3.0", "<GplThree>"),
    ("GPL-2.0", "<GplTwo>"),
    ("MIT", "<MitNotice>(<AsIs>)?"),
    ("CC-BY-NC-4.0", "<CcByNc>"),
    ("CC-BY-SA-4.0", "<CcBySa>"),
    ("CC-BY-4.0", "<CcBy>"),
    ("Proprietary", "<AllRights>"),
)
# The GPL notices as they are written, tried before the others. Version 3 is one
# sentence; version 2 has semicolons after "free software" and "Foundation".
_GPL = r"(this program is free software[:,]? )?you can redistribute it and/or modify it under the terms of the gnu general public license"
NOTICES: tuple[tuple[str, str], ...] = (
    ("GplNoticeThree", _GPL + r"(,? version 3( .*)?|,? .*version 3 of the license.*)"),
    ("GplNoticeTwo", _GPL + r"(,? version 2( .*)?|,? .*version 2 of the license.*)"),
    ("GplFree", _GPL + r" .*"),
)
NOTICE_RULES: tuple[tuple[str, str], ...] = (
    ("GPL-3.0", "<GplNoticeThree>"),
    ("GPL-2.0", "<GplNoticeTwo>"),
)
# Pieces of which every known sentence holds one: other texts and sentences are not matched.
CLUES = ("licen", "permission", "redistribut", "contributors", "software", "rights reserved")
WORD_CLUES = ("licen", "permission", "redistribut", "contributors", "software", "reserved")
UNKNOWN = "UNKNOWN"
SENTENCE_END = r"[.!?;]+(?:[\x20\x09-\x0D]|\z)"
LINE_END = r"[\r\n]+"
BLANK_LINE = r"(?>\r\n?|\n)[^\p{L}\p{N}\r\n]*(?>\r\n?|\n)"
CUT = "\x00"
OTHER = r"[^\p{L}\p{N}.,:/-]+"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, OTHER, " "))


def sentences(text: str) -> Column:
    """Sentences of a text, each as its normalised lines.

    A text is cut at blank lines and after full stops, marks and semicolons that white space
    or the end follows. A line without letters and digits is blank. A-Z are lower-cased, and
    runs of anything but letters, digits and ``.,:/-`` become one blank.
    """
    lower = F.translate(text, string.ascii_uppercase + CUT, string.ascii_lowercase + " ")
    cut = F.regexp_replace(F.regexp_replace(lower, SENTENCE_END, CUT), BLANK_LINE, CUT)
    return F.transform(F.split(cut, CUT), lambda s: F.transform(F.split(s, LINE_END), _normal))


def _has_clue(column: Column, clues: tuple[str, ...] = CLUES) -> Column:
    return reduce(Column.__or__, (F.contains(column, F.lit(clue)) for clue in clues))


def _identifier(sentence: Column) -> Column:
    name = F.lit(None).cast("string")
    for identifier, pattern in reversed((*NOTICES, *SENTENCES)):
        name = F.when(sentence.rlike(f"^(?:{pattern})$"), identifier).otherwise(name)
    return F.when(_has_clue(sentence), name)


def _pieces(lines: Column) -> Column:
    """Lines known by themselves as ``<name>``, and what lies between them joined."""
    marked = F.transform(
        lines,
        lambda line: F.coalesce(
            F.concat(F.lit(CUT + "<"), _identifier(line), F.lit(">" + CUT)), line
        ),
    )
    return F.transform(F.split(F.array_join(marked, " "), CUT), _normal_or_name)


def _normal_or_name(piece: Column) -> Column:
    name = F.regexp_extract(piece, "^<(.*)>$", 1)
    return F.when(name != "", name).otherwise(_identifier(_normal(piece)))


def sentence_ids(text: str) -> Column:
    """Identifiers of a text's known sentences, in the order of the text.

    A line that is a known sentence counts by itself; other lines are joined up to the end of
    their sentence, as licence texts are wrapped at any word.
    """
    known = F.filter(
        sentences(text), lambda lines: _has_clue(F.array_join(lines, " "), WORD_CLUES)
    )
    named = F.filter(F.flatten(F.transform(known, _pieces)), lambda name: name.isNotNull())
    some = _has_clue(F.lower(text), WORD_CLUES)
    return F.when(some, named).otherwise(F.array().cast("array<string>"))


def licences_of(ids: str) -> Column:
    """Licences of a sequence of identifiers, sorted, each once."""
    marked = F.transform(ids, lambda name: F.concat(F.lit("<"), name, F.lit(">")))
    rest = F.array_join(marked, "")
    found = []
    for licence, rule in (*NOTICE_RULES, *RULES):
        found.append(F.when(rest.rlike(rule), F.lit(licence)))
        rest = F.regexp_replace(rest, rule, "")
    found.append(F.when(rest != "", F.lit(UNKNOWN)))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def with_licences(df: DataFrame, text: str) -> DataFrame:
    """Add ``sentence_ids`` and ``licences``; columns of these names are replaced.

    Null and empty texts, and texts without known sentences, have neither. Whole texts are
    read, one row at a time: there is no shuffle, and repeated rows each get their result.
    """
    rest = df.drop(*[name for name in ("sentence_ids", "licences") if name != text])
    return rest.withColumn("sentence_ids", sentence_ids(text)).withColumn(
        "licences", licences_of("sentence_ids")
    )
