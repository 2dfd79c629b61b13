"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, each sentence is normalised (lower case, only a-z and 0-9, single
blanks) and looked up among known licence sentences, which gives an identifier, or read as a
reference ("licensed under the ..."). The identifiers in text order, runs of unknown sentences
shortened to one "?", are a sequence; the rules are tried on it in order, and each takes what it
matches out of the sequence.

A text that holds none of ``GATE`` has no known sentence, so only the others are cut.

Defined results: an empty or null text has no sequence and no licences; an empty table gives no rows;
rows are judged one by one, so null and repeated ids and repeated rows don't matter; of the input only
id and text are read, texts of any length whole; of rules that could take the same identifiers the
earlier one does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Sentences of published licences, normalised
# ---------------------------------------------------------------------------

SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT-GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT-NOTICE",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT-WARRANTY",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MIT-LIABILITY",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD-GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD-SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD-BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD-ENDORSE",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "BSD-ADVERTISE",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSD-WARRANTY",
    "licensed under the apache license version 2 0 the license": "APACHE-HEAD",
    "you may not use this file except in compliance with the license": "APACHE-USE",
    "you may obtain a copy of the license at": "APACHE-COPY",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "APACHE-COPY",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "APACHE-WARRANTY",
    "see the license for the specific language governing permissions and limitations under the license": "APACHE-SEE",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3+-GRANT",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2+-GRANT",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "GPL2-GRANT",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL21+-GRANT",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3+-GRANT",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPL-WARRANTY",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPL-WARRANTY",
    "see the gnu general public license for more details": "GPL-SEE",
    "see the gnu lesser general public license for more details": "GPL-SEE",
    "see the gnu affero general public license for more details": "GPL-SEE",
    "you should have received a copy of the gnu general public license along with this program": "GPL-COPY",
    "if not see https www gnu org licenses": "GPL-URL",
    "if not see http www gnu org licenses": "GPL-URL",
    "this source code form is subject to the terms of the mozilla public license v": "MPL-HEAD",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL-HEAD",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "MPL-COPY",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC-GRANT",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISC-WARRANTY",
    "this is free and unencumbered software released into the public domain": "UNLICENSE-HEAD",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "CC0-WAIVER",
    "this work is in the public domain": "PUBLIC-DOMAIN",
    "all rights reserved": "RESERVED",
    "gnu general public license": "GPL-TITLE",
    "gnu lesser general public license": "LGPL-TITLE",
    "gnu affero general public license": "AGPL-TITLE",
    "version 2 june 1991": "GPL2-DATE",
    "version 3 29 june 2007": "GPL3-DATE",
    "version 3 19 november 2007": "AGPL3-DATE",
    "version 2 0 january 2004": "APACHE2-DATE",
    "apache license": "APACHE-TITLE",
}

# How references name licences, normalised, and their SPDX names.
NAMES = {
    "mit": "MIT", "mit license": "MIT", "expat": "MIT",
    "apache 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0", "apache license version 2 0": "Apache-2.0", "apache license": "Apache-2.0",
    "bsd 2 clause": "BSD-2-Clause", "simplified bsd": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause", "new bsd": "BSD-3-Clause", "bsd": "BSD-3-Clause",
    "gnu general public license version 2": "GPL-2.0", "gpl v2": "GPL-2.0", "gplv2": "GPL-2.0", "gpl 2 0": "GPL-2.0",
    "gnu general public license version 3": "GPL-3.0", "gnu general public license": "GPL-3.0", "gpl v3": "GPL-3.0", "gplv3": "GPL-3.0", "gpl 3 0": "GPL-3.0",
    "gnu lesser general public license version 2 1": "LGPL-2.1", "gnu lesser general public license version 3": "LGPL-3.0", "lgpl 3 0": "LGPL-3.0",
    "gnu affero general public license version 3": "AGPL-3.0", "agpl 3 0": "AGPL-3.0",
    "mozilla public license version 2 0": "MPL-2.0", "mpl 2 0": "MPL-2.0", "isc": "ISC", "boost software license version 1 0": "BSL-1.0",
    "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0", "cc by nc 4 0": "CC-BY-NC-4.0", "cc by nd 4 0": "CC-BY-ND-4.0",
    "cc by nc sa 4 0": "CC-BY-NC-SA-4.0", "cc by nc nd 4 0": "CC-BY-NC-ND-4.0", "cc by 3 0": "CC-BY-3.0", "cc by sa 3 0": "CC-BY-SA-3.0", "cc0 1 0": "CC0-1.0",
    "creative commons attribution 4 0 international": "CC-BY-4.0", "creative commons attribution sharealike 4 0 international": "CC-BY-SA-4.0",
    "creative commons attribution noncommercial 4 0 international": "CC-BY-NC-4.0", "unlicense": "Unlicense",
    "epl 2 0": "EPL-2.0", "eclipse public license 2 0": "EPL-2.0", "eclipse public license v 2 0": "EPL-2.0", "epl 1 0": "EPL-1.0", "zlib": "Zlib",
    "bsl 1 0": "BSL-1.0", "boost software": "BSL-1.0", "gpl 2 0 only": "GPL-2.0-only", "gpl 2 0 or later": "GPL-2.0-or-later",
    "gpl 3 0 only": "GPL-3.0-only", "gpl 3 0 or later": "GPL-3.0-or-later", "lgpl 2 1": "LGPL-2.1", "lgpl 2 1 or later": "LGPL-2.1-or-later",
    "lgpl 3 0 or later": "LGPL-3.0-or-later", "agpl 3 0 only": "AGPL-3.0-only", "agpl 3 0 or later": "AGPL-3.0-or-later", "artistic 2 0": "Artistic-2.0",
    "mit 0": "MIT-0", "0bsd": "0BSD", "wtfpl": "WTFPL", "mozilla public license 2 0": "MPL-2.0", "mozilla public": "MPL-2.0",
}

# The rules, tried in this order: a licence and the identifiers that, on end, name it.
RULES = (
    ("MIT", ("MIT-GRANT", "MIT-NOTICE", "MIT-WARRANTY", "MIT-LIABILITY")),
    ("MIT", ("MIT-GRANT", "MIT-NOTICE")),
    ("MIT", ("MIT-GRANT",)),
    ("BSD-4-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ADVERTISE")),
    ("BSD-3-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE")),
    ("BSD-2-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY")),
    ("Apache-2.0", ("APACHE-HEAD", "APACHE-USE", "APACHE-COPY")),
    ("Apache-2.0", ("APACHE-HEAD", "APACHE-USE")),
    ("Apache-2.0", ("APACHE-HEAD",)),
    ("GPL-3.0-or-later", ("GPL3+-GRANT", "GPL-WARRANTY", "GPL-SEE")),
    ("GPL-3.0-or-later", ("GPL3+-GRANT",)),
    ("GPL-2.0-or-later", ("GPL2+-GRANT", "GPL-WARRANTY", "GPL-SEE")),
    ("GPL-2.0-or-later", ("GPL2+-GRANT",)),
    ("GPL-2.0-only", ("GPL2-GRANT",)),
    ("LGPL-2.1-or-later", ("LGPL21+-GRANT",)),
    ("AGPL-3.0-or-later", ("AGPL3+-GRANT",)),
    ("MPL-2.0", ("MPL-HEAD", "MPL-COPY")),
    ("MPL-2.0", ("MPL-HEAD",)),
    ("ISC", ("ISC-GRANT",)),
    ("Unlicense", ("UNLICENSE-HEAD",)),
    ("CC0-1.0", ("CC0-WAIVER",)),
    ("GPL-2.0", ("GPL-TITLE", "GPL2-DATE")),
    ("GPL-3.0", ("GPL-TITLE", "GPL3-DATE")),
    ("LGPL-3.0", ("LGPL-TITLE", "GPL3-DATE")),
    ("AGPL-3.0", ("AGPL-TITLE", "AGPL3-DATE")),
    ("Apache-2.0", ("APACHE-TITLE", "APACHE2-DATE")),
    ("Public-Domain", ("PUBLIC-DOMAIN",)),
    *((licence, (f"REF-{licence}",)) for licence in dict.fromkeys(NAMES.values())),
    ("Proprietary", ("COPYRIGHT", "RESERVED")),
)

#: Every known sentence, reference and copyright line, once normalised, holds one of these.
MARKS = "licen|copyright|permission|warrant|liab|redistribut|mpl|gnu|gpl|public domain|rights|under|advertis|version [23] "
#: The same before normalisation: without blanks, which may be any other signs there.
GATE = MARKS.replace("public domain", "domain").replace("version [23] ", "version[^a-z0-9]+[23]")
#: What references look like, in words, as a tag ("SPDX-License-Identifier: ...") and as a title or an
#: attribute ("BSD 3-Clause License", "is MIT licensed"); the group is the licence's name.
REFERENCE = (r"^(?:.* )?(?:(?:licensed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the )?"
             r"|spdx license identifier )(.+?)(?: license)?$")
TITLE = r"^(?:.* is (?:an? |the )?|the )?(.+?) licen(?:sed|se|ce)$"
COPYRIGHT = r"^copyright( c)?( [0-9].*)?$|^copyright .* [0-9][0-9][0-9][0-9]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where a sentence ends: a full stop and blanks, a colon at a line's end, or an empty line.
END = r"([.!?])[ \t\r\n]+|(:)[ \t\r]*\n[ \t\r\n]*|\n[ \t\r]*\n[ \t\r\n]*"
CUT = "\x01"


# ---------------------------------------------------------------------------
# Expressions
# ---------------------------------------------------------------------------

def _table(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def _normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))


def _identifier(normalised: Column) -> Column:
    """A known sentence's identifier, "?" for an unknown one, "" for a bare number or letter."""
    named, titled = (_table(NAMES)[F.regexp_extract(normalised, rule, 1)] for rule in (REFERENCE, TITLE))
    return F.coalesce(_table(SENTENCES)[normalised], F.concat(F.lit("REF-"), named), F.concat(F.lit("REF-"), titled), F.when(normalised.rlike(COPYRIGHT), "COPYRIGHT"),
                      F.when(normalised.rlike("^[0-9]*$|^[a-z]$"), "").otherwise("?"))


def _identifiers(lowered: Column) -> Column:
    """Sentence by sentence; where a sentence of several lines is unknown, line by line."""
    sentences = F.split(F.regexp_replace(lowered, END, "$1$2" + CUT), CUT)

    def lines(s):
        return F.transform(F.transform(F.split(s, "\n"), _normalised), _identifier)

    return F.flatten(F.transform(sentences, lambda s: F.when(_identifier(_normalised(s)) != "?", F.array(_identifier(_normalised(s)))).otherwise(lines(s))))


def sequence(text: Column) -> Column:
    """The identifiers of a text in order, as "[A][?][B]"."""
    lowered = F.translate(text, UPPER, LOWER)
    parts = F.transform(F.filter(_identifiers(lowered), lambda x: x != ""), lambda x: F.concat(F.lit("["), x, F.lit("]")))
    joined = F.regexp_replace(F.array_join(parts, ""), r"(\[\?\])+", "[?]")
    return F.when(lowered.rlike(GATE) & joined.rlike(r"\[[^?]"), joined).otherwise("")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, sequence, licences (array in rule order of places), n_known and n_unmatched (identifiers
    that no rule took)."""
    rows = docs.select(F.col(id_col).alias("id"), sequence(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("sequence"))
    matched = F.col("sequence")
    for licence, ids in RULES:
        matched = F.replace(matched, F.lit("".join(f"[{i}]" for i in ids)), F.lit("{" + licence + "}"))
    rows = rows.withColumn("matched", F.when(F.col("sequence") != "", matched).otherwise(""))
    licences = F.regexp_extract_all("matched", F.lit(r"\{([^}]+)\}"), F.lit(1))
    return rows.select("id", "sequence", licences.alias("licences"), F.regexp_count("sequence", F.lit(r"\[[^?\]]")).cast("long").alias("n_known"),
                       F.regexp_count("matched", F.lit(r"\[[^?\]]")).cast("long").alias("n_unmatched"))
