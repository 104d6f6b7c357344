"""Licence recognition by sentences, in DataFrame functions only.

A text is normalised, and known licence sentences in it become their identifiers. A
sentence lies between two ends, which are final punctuation, blank lines and the ends
of lines; line feeds within it are blanks, so a wrapped sentence is found as well as
one that a line holds alone. Texts are cut at all ends once, and the parts are looked up
among the beginnings of known sentences; only texts with such a part are searched for
whole sentences, so the cost hardly grows with their number. A licence is recognised
where its rule - an ordered sequence of identifiers - lies in the sequence of a text's
known sentences, those that no such rule names left out. Everything happens within
the row: no shuffle and no join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Licence sentences in normal form, numbered from 1 in this order. These are one-line forms.
SENTENCES = (
    "licensed under cc by nc 4 0",
    "this work is licensed under the gnu general public license version 3",
    "licensed under the apache license version 2 0",
    "released under the mit license",
    "permission is hereby granted free of charge to any person obtaining a copy",
    "the above copyright notice and this permission notice shall be included in all copies",
    "the software is provided as is without warranty of any kind",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at",
    "this program is free software you can redistribute it and or modify it",
    "this program is distributed in the hope that it will be useful",
    "redistribution and use in source and binary forms are permitted",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "all rights reserved",
)

# Licence rules as sequences of sentence numbers.
RULES = (
    ("cc-by-nc-4.0", (1,)),
    ("gpl-3.0", (2,)),
    ("gpl", (10, 11)),
    ("apache-2.0", (3,)),
    ("apache-2.0-notice", (3, 8, 9)),
    ("mit", (4,)),
    ("mit-text", (5, 6, 7)),
    ("bsd", (12,)),
    ("cc-by-4.0", (13,)),
    ("all-rights-reserved", (14,)),
)

# The licences of the Creative Commons 4.0 family: short code and long name.
_CC = (("by", "attribution"), ("by sa", "attribution sharealike"), ("by nd", "attribution noderivatives"),
       ("by nc", "attribution noncommercial"), ("by nc sa", "attribution noncommercial sharealike"),
       ("by nc nd", "attribution noncommercial noderivatives"))


def _cc_sentences(code, name):
    public = f"creative commons {name} 4 0 international public license"
    return (f"licensed under cc {code} 4 0", f"this work is licensed under cc {code} 4 0",
            f"this work is licensed under a creative commons {name} 4 0 international license",
            f"this work is licensed under the creative commons {name} 4 0 international license",
            f"this work is licensed under {name} 4 0 international", public,
            "by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions "
            f"of this {public} public license")


_FREE = "this program is free software"
_REDISTRIBUTE = "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
# Notices have semicolons or a colon after "free software", and semicolons or a comma after "foundation".
_VERSIONS = {f"gpl-{v}.0{later}": f"either version {v} of the license or at your option any later version" if later else f"version {v} of the license"
             for v in (2, 3) for later in ("", "-or-later")}
_GPL = {name: ((_FREE, _REDISTRIBUTE, v), (f"{_FREE} {_REDISTRIBUTE}", v), (_FREE, f"{_REDISTRIBUTE} {v}"), (f"{_FREE} {_REDISTRIBUTE} {v}",))
        for name, v in _VERSIONS.items()}


# The sentences of the licences' own texts and notices, by the names that the rules below use.
_TEXTS = {
    "apache": "licensed under the apache license version 2 0 the license",
    "apache title": "apache license version 2 0 january 2004",
    "apache as is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
                    "as is basis without warranties or conditions of any kind either express or implied",
    "apache see": "see the license for the specific language governing permissions and limitations under the license",
    "mit grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
                 "files the software to deal in the software without restriction including without limitation the rights to use copy "
                 "modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
                 "software is furnished to do so subject to the following conditions",
    "mit notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit as is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
                 "of merchantability fitness for a particular purpose and noninfringement",
    "bsd grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                 "following conditions are met",
    "bsd source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
                  "disclaimer in the documentation and or other materials provided with the distribution",
    "bsd names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                 "derived from this software without specific prior written permission",
    "bsd as is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including "
                 "but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "gpl title 2": "gnu general public license version 2 june 1991",
    "gpl title 3": "gnu general public license version 3 29 june 2007",
    "gpl useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl see": "see the gnu general public license for more details",
}

# Names that people give licences in one line, by the name of the rule.
_NAMES = {
    "mit": ("mit license",), "apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license"),
    "bsd-2-clause": ("bsd 2 clause license",), "bsd-3-clause": ("bsd 3 clause license",), "isc": ("isc license",),
    "mpl-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v 2 0"),
    "gpl-2.0": ("gnu general public license version 2", "gnu general public license v2 0"),
    "gpl-3.0": ("gnu general public license version 3", "gnu general public license v3 0"),
    "lgpl-2.1": ("gnu lesser general public license version 2 1", "gnu lesser general public license v2 1"),
    "lgpl-3.0": ("gnu lesser general public license version 3", "gnu lesser general public license v3 0"),
    "agpl-3.0": ("gnu affero general public license version 3", "gnu affero general public license v3 0"),
}
# Beginnings of such lines, and identifiers behind the public tag for them.
_PHRASES = ("", "licensed under the ", "released under the ", "distributed under the ", "this is licensed under the ", "this is released under the ",
            "this project is licensed under the ", "this software is licensed under the ", "this software is released under the ",
            "this work is licensed under the ", "this program is licensed under the ")
_TAG, _TAGGED = "spdx license identifier ", ("mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "mpl-2.0", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0", "cc0-1.0",
                                            *(f"{n}{k}" for n in ("gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0") for k in ("", "-only", "-or-later")))
# "MIT License" alone is the title of that licence's text, which has rules of its own.
_LINES = {**{phrase + name: rule for rule, names in _NAMES.items() for name in names for phrase in _PHRASES if phrase or rule != "mit"},
          **{_TAG + re.sub("[^a-z0-9]", " ", rule): rule for rule in _TAGGED}}

# Sentences of further licences' texts and notices.
_FURTHER = {
    "mpl": "this source code form is subject to the terms of the mozilla public license v",
    "mpl 2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
                 "the above copyright notice and this permission notice appear in all copies",
    "lgpl 2.1": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
                "published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl free": "this library is free software",
    "lgpl 2.1 terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free "
                      "software foundation",
    "lgpl 2.1 later": "either version 2 1 of the license or at your option any later version",
    "agpl 3": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as "
              "published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl 3": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
              "published by the free software foundation either version 3 of the license or at your option any later version",
}

#: All known sentences: the one-line forms keep their numbers, those of the texts follow.
ALL_SENTENCES = tuple(dict.fromkeys((
    *SENTENCES, *_TEXTS.values(), *(s for forms in _GPL.values() for form in forms for s in form), *(s for kind in _CC for s in _cc_sentences(*kind)),
    *_LINES, *_FURTHER.values())))


def _ids(*names):
    return tuple(ALL_SENTENCES.index((_TEXTS | _FURTHER).get(n, n)) + 1 for n in names)


#: All rules; a licence may have several.
ALL_RULES = (
    *RULES,
    ("apache-2.0", _ids("apache")),
    ("apache-2.0", _ids("apache title")),
    ("apache-2.0-notice", (*_ids("apache"), 8, 9, *_ids("apache as is", "apache see"))),
    ("mit-text", _ids("mit grant", "mit notice", "mit as is")),
    ("bsd", _ids("bsd grant")),
    ("bsd-2-clause", _ids("bsd grant", "bsd source", "bsd binary", "bsd as is")),
    ("bsd-3-clause", _ids("bsd grant", "bsd source", "bsd binary", "bsd names", "bsd as is")),
    *((rule, _ids(*form)) for name, forms in _GPL.items() for form in forms for rule in ("gpl", name)),
    ("gpl-2.0", _ids("gpl title 2")),
    ("gpl-3.0", _ids("gpl title 3")),
    *((f"cc-{code.replace(' ', '-')}-4.0", _ids(s)) for code, name in _CC for s in _cc_sentences(code, name)),
    *((rule, _ids(line)) for line, rule in _LINES.items()),
    ("mpl-2.0", _ids("mpl")),  # the notice's "v." ends a sentence
    ("mpl-2.0", _ids("mpl 2")),
    ("isc", _ids("isc grant")),
    ("lgpl-2.1-or-later", _ids("lgpl 2.1")),
    ("lgpl-2.1-or-later", _ids("lgpl free", "lgpl 2.1 terms", "lgpl 2.1 later")),
    ("lgpl-3.0-or-later", _ids("lgpl 3")),
    ("agpl-3.0-or-later", _ids("agpl 3")),
)

#: Punctuation that ends a sentence: before white space or the end of the text.
SENTENCE_END = r"[.!?;]+(?=[\x20\x09-\x0D]|$)"
# In lowered text the capitals are free: X is the end of a sentence. Line feeds stay, other runs are one blank.
_NOT_PLAIN = r"[^a-z0-9X\n]+"
# Between the words of a sentence: a blank or one line feed, and then the punctuation that leads a comment's line.
_BETWEEN, _LINE = r"(?: ?\n[ X]*| )", r" ?\n[ X]*"


def _words(sentences) -> list[list[str]]:
    return [s.split(" ") for s in sentences if re.fullmatch("[a-z0-9]+(?: [a-z0-9]+)*", s)]


def _pattern(words, between: str) -> str:
    """Known sentences, those of more words first."""
    return "|".join(between.join(w) for w in sorted(words, key=len, reverse=True))


def sentence_ids(text: Column, sentences=ALL_SENTENCES) -> Column:
    """Numbers of the known sentences of a text, in order; null texts have none.

    A sentence's normal form has its ASCII letters in lower case and one blank for
    every run of other characters; a line without ASCII letters and digits is blank.
    Of known sentences that begin at the same place the longest counts: a sentence
    over several lines comes before the one that its first line holds.
    """
    words = _words(sentences)
    if not words:
        return F.array().cast("array<int>")
    known = F.array(*[F.lit(s) for s in sentences])
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    normal = F.concat(F.lit("X"), F.regexp_replace(F.regexp_replace(lowered, SENTENCE_END, "X"), _NOT_PLAIN, " "), F.lit("X"))
    # The first line of a known sentence is one of these, which a hash set holds.
    beginnings = sorted({" ".join(w[:n]) for w in words for n in range(1, len(w) + 1)})

    def search(normal):
        found = F.regexp_extract_all(normal, F.lit(f"[X\\n] ?({_pattern(words, _BETWEEN)}) ?(?=[X\\n])"), F.lit(1))
        return F.transform(found, lambda s: F.array_position(known, F.regexp_replace(s, _LINE, " ")).cast("int"))

    def of_normal(normal):
        begins = F.exists(F.split(normal, r"[X\n]"), lambda part: F.trim(part).isin(beginnings))
        return F.when(begins, search(normal)).otherwise(F.array().cast("array<int>"))

    # Bound by the lambda, the normal form is made once.
    return F.element_at(F.transform(F.array(normal), of_normal), 1)


def _of_sequences(rules) -> list[int]:
    """Sentences that rules of several sentences name; all others may stand anywhere between these."""
    return sorted({i for _, seq in rules if len(seq) > 1 for i in seq})


def rule_hits(ids: Column, rules=ALL_RULES) -> Column:
    """Names of the rules whose sequence lies in ``ids``, each once, in the order of the rules.

    Between the sentences of a sequence may stand those that no sequence names, such as
    a line about rights. A rule of one sentence, as most are, is looked up.
    """
    own = F.filter(ids, lambda i: i.isin(_of_sequences(rules)))
    trail = F.concat(F.lit(" "), F.array_join(F.transform(own, lambda i: i.cast("string")), " "), F.lit(" "))
    found = []
    for name in dict.fromkeys(name for name, _ in rules):
        alone = [F.lit(seq[0]) for n, seq in rules if n == name and len(seq) == 1]
        ways = [F.arrays_overlap(ids, F.array(*alone))] if alone else []
        ways += [F.contains(trail, F.lit(" " + " ".join(map(str, seq)) + " ")) for n, seq in rules if n == name and len(seq) > 1]
        any_ = ways[0]
        for w in ways[1:]:
            any_ = any_ | w
        found.append(F.when(any_, F.lit(name)))
    none = F.array().cast("array<string>")
    return F.when(F.size(ids) > 0, F.array_compact(F.array(*found)) if found else none).otherwise(none)


def scan_licences(docs: DataFrame, text: str = "text", sentences=ALL_SENTENCES, rules=ALL_RULES) -> DataFrame:
    """Add ``sentence_ids`` (array<int>) and ``licences`` (array<string>).

    Columns so named before are replaced. Null, empty and plain texts get empty
    arrays; a sentence that occurs again is listed again; a licence is listed once.
    """
    found = docs.withColumn("sentence_ids", sentence_ids(F.col(text), sentences))
    return found.withColumn("licences", rule_hits(F.col("sentence_ids"), rules))


def licence_report(docs: DataFrame) -> DataFrame:
    """One row a document: its known sentences and licences as text."""
    found = scan_licences(docs.select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join(F.transform("sentence_ids", lambda i: i.cast("string")), " ").alias("sentence_ids"),
                        F.array_join("licences", " ").alias("licences"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# As ``_BETWEEN``, with the twin's marks.
_SQL_BETWEEN = r"(?: ?Z\n[ XZ]*| )"


def _rule_sql(name: str, rules) -> str:
    """Whether the rules of one name hold for the list ``ids`` and the text ``trail`` of its sequence sentences."""
    ways = [f"list_contains(ids, {seq[0]})" if len(seq) == 1 else f"contains(trail, ' {' '.join(map(str, seq))} ')" for n, seq in rules if n == name]
    return f"CASE WHEN {' OR '.join(ways)} THEN {_sql_text(name)} END"


# The regular expressions of the twin have no look-ahead: every end is led by a Z, which the search takes instead.
_ENDS_SQL = r"""regexp_replace('X' || regexp_replace(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.!?;]+([ \t-\r]|$)', 'X\1', 'g'), '[^a-z0-9X\n]+', ' ', 'g') || 'X', '([X\n])', 'Z\1', 'g')"""
LICENCE_SQL = f"""WITH marked AS (SELECT doc_id, {_ENDS_SQL} AS t FROM documents),
found AS (
  SELECT doc_id, list_transform(regexp_extract_all(t, '[X\\n] ?({_pattern(_words(ALL_SENTENCES), _SQL_BETWEEN)}) ?Z', 1),
    lambda s: list_position([{', '.join(map(_sql_text, ALL_SENTENCES))}], regexp_replace(s, ' ?Z\\n[ XZ]*', ' ', 'g'))) AS ids
  FROM marked),
trails AS (
  SELECT *, ' ' || array_to_string(list_filter(ids, lambda i: list_contains([{', '.join(map(str, _of_sequences(ALL_RULES)))}], i)), ' ') || ' ' AS trail FROM found)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ' ') AS sentence_ids,
  array_to_string(list_filter([{', '.join(_rule_sql(n, ALL_RULES) for n in dict.fromkeys(n for n, _ in ALL_RULES))}], lambda x: x IS NOT NULL), ' ') AS licences
FROM trails"""
