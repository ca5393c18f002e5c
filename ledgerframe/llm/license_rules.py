"""Licence scans by sentence rules (operator 4).

A text is cut into sentences, each sentence is normalised (lower case, words and digits
only), and known licence sentences become identifiers. The text's sequence of
identifiers is then matched against ordered rules: at each place the first rule whose
whole sequence follows is taken, so longer and more specific rules come first. What no
rule takes is reported as an unmatched identifier.

Lines of a wrapped sentence are put together again: from each line or sentence on, pieces
are joined as long as they may be a known sentence, and the longest known one counts. Comment marks at the start of lines drop out in the normalisation.

Every known sentence holds one of ``TRIGGERS``, so a text without any has no licence
sentence and isn't cut up.

Defined cases: a null or empty text has no sentences and no licences; whole texts are
read; a rule that applies repeatedly names its licence once per document; repeated rows
are scanned separately; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Known licence sentences by identifier, normalised.
SENTENCES = {
    "apache_short": "licensed under the apache license version 2 0",
    "apache_grant": "licensed under the apache license version 2 0 the license",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_short": "released under the mit license",
    "mit_under": "licensed under the mit license",
    "mit_this": "this project is licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "gpl3_work": "this work is licensed under the gnu general public license version 3",
    "gpl3_under": "licensed under the gnu general public license version 3",
    "gpl2_under": "licensed under the gnu general public license version 2",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_see": "see the gnu general public license for more details",
    "gpl_received": "you should have received a copy of the gnu general public license along with this program",
    "lgpl_under": "licensed under the gnu lesser general public license version 3",
    "agpl_under": "licensed under the gnu affero general public license version 3",
    "bsd_redistribute": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_short": "licensed under the bsd license",
    "mpl_terms": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl_copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc_by_short": "licensed under cc by 4 0",
    "cc_by_sa_short": "licensed under cc by sa 4 0",
    "cc_by_nc_short": "licensed under cc by nc 4 0",
    "cc_by_nc_nd_short": "licensed under cc by nc nd 4 0",
    "cc_by_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc_by_sa_work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc_by_nc_work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "reserved": "all rights reserved",
    "proprietary": "unauthorized copying of this file via any medium is strictly prohibited",
}

#: Ordered rules; the first whose sequence of identifiers follows is taken.
RULES = (
    ("Apache-2.0", ("apache_grant", "apache_use", "apache_copy", "apache_basis", "apache_see")),
    ("Apache-2.0", ("apache_grant", "apache_use", "apache_basis", "apache_see")),
    ("Apache-2.0", ("apache_grant", "apache_use")),
    ("Apache-2.0", ("apache_grant",)),
    ("Apache-2.0", ("apache_short",)),
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is", "mit_liability")),
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is")),
    ("ISC", ("isc_grant",)),
    ("MIT", ("mit_short",)),
    ("MIT", ("mit_under",)),
    ("MIT", ("mit_this",)),
    ("GPL-3.0-or-later", ("gpl_free", "gpl_hope", "gpl_see", "gpl_received")),
    ("GPL-3.0-or-later", ("gpl_free",)),
    ("GPL-2.0-or-later", ("gpl2_free", "gpl_hope", "gpl_see", "gpl_received")),
    ("GPL-2.0-or-later", ("gpl2_free",)),
    ("GPL-3.0-only", ("gpl3_work",)),
    ("GPL-3.0-only", ("gpl3_under",)),
    ("GPL-2.0-only", ("gpl2_under",)),
    ("LGPL-3.0-only", ("lgpl_under",)),
    ("AGPL-3.0-only", ("agpl_under",)),
    ("BSD-3-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary")),
    ("BSD", ("bsd_short",)),
    ("MPL-2.0", ("mpl_terms", "mpl_copy")),
    ("MPL-2.0", ("mpl_terms",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-4.0", ("cc_by_short",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_short",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_short",)),
    ("CC-BY-NC-ND-4.0", ("cc_by_nc_nd_short",)),
    ("CC-BY-4.0", ("cc_by_work",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_work",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_work",)),
    ("CC0-1.0", ("cc0",)),
    ("proprietary", ("reserved", "proprietary")),
    ("proprietary", ("proprietary",)),
    ("all-rights-reserved", ("reserved",)),
)

#: Every known sentence holds one of these.
TRIGGERS = ("licens", "copyright", "permission", "warrant", "liable", "redistribut", "rights reserved",
            "public domain", "mpl was", "prior written", "unauthorized copying", "free software")

_BY_SENTENCE = {tuple(s.split()): k for k, s in SENTENCES.items()}
_MOST_WORDS = max(map(len, _BY_SENTENCE))
#: A known sentence stands on at most as many lines as it has words.
MAX_LINES = _MOST_WORDS
_STARTS = {s[:n] for s in _BY_SENTENCE for n in range(1, len(s) + 1)}
_WORD = re.compile(r"[^\W_]+")
_PIECE = re.compile(r"[^\n]+?(?:[.!?;:]+(?=\s|$)|(?=\n)|$)")
#: With white space folded, as a trigger may stand across a line break.
_TRIGGER = re.compile("|".join(re.escape(t).replace(r"\ ", r"[\W_]+") for t in TRIGGERS))


def normalised(piece: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(piece.lower()))


def sentence_ids(text: str | None) -> list[str]:
    """Identifiers of the known sentences of a text, in order."""
    if not text or not _TRIGGER.search(text.lower()):
        return []
    pieces = [p for p in map(normalised, _PIECE.findall(text)) if p]
    out, at = [], 0
    while at < len(pieces):
        joined, best, taken = (), None, 1
        for k in range(at, len(pieces)):  # ends where the words begin no known sentence
            joined += pieces[k]
            if joined not in _STARTS:
                break
            if joined in _BY_SENTENCE:
                best, taken = _BY_SENTENCE[joined], k - at + 1
        if best:
            out.append(best)
        at += taken
    return out


def apply_rules(ids: list[str]) -> tuple[list[str], list[str]]:
    """Licences named by the rules, in order of first appearance, and unmatched identifiers."""
    licences, unmatched, at = [], [], 0
    while at < len(ids):
        for licence, sequence in RULES:
            if tuple(ids[at:at + len(sequence)]) == sequence:
                if licence not in licences:
                    licences.append(licence)
                at += len(sequence)
                break
        else:
            unmatched.append(ids[at])
            at += 1
    return licences, unmatched


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, sentences, licences, unmatched)`` per input row; three arrays of names."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [sentence_ids(t) for t in batch["t"]]
            ruled = [apply_rules(x) for x in ids]
            yield pd.DataFrame({"i": batch["i"], "sentences": ids, "licences": [r[0] for r in ruled],
                                "unmatched": [r[1] for r in ruled]})

    return (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
            .mapInPandas(run, f"i {id_type}, sentences array<string>, licences array<string>, unmatched array<string>")
            .withColumnRenamed("i", id_col))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scan with its arrays joined by commas."""
    found = scan(docs, id_col, text_col)
    return found.select(id_col, F.array_join("licences", ",").alias("licences"),
                        F.size("sentences").cast("long").alias("n_sentences"),
                        F.array_join("sentences", ",").alias("sentences"),
                        F.array_join("unmatched", ",").alias("unmatched"))
