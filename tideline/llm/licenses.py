"""Licence notices: sentences become known identifiers, sequences of them meet ordered rules.

A text is cut into blocks at full stops before a blank or line end, at lines without letters and
digits, and at a colon before a numbered line. A block is brought to a normal form (lower case; every
run of other characters than letters and digits, line ends and comment marks among them, is one
blank) and looked up in a fixed table of licence sentences, so a notice is found however it is
wrapped. A block that is unknown is looked up again without its first one, two or three lines, as
headings have no full stop, and else line by line, each line a sentence. A line with a licence tag
is cut at `or`, `and` and `with`, and its names are looked up one by one. A sentence gives one
identifier, or several if it is usually written as several. The identifiers of a document, in order,
make one sequence in which an unknown sentence is a gap; rules are tried in order, longest first,
and a rule takes the sentences it matched out of the sequence. All of it stays in SQL functions, and
no row leaves its partition.

Null or empty texts and texts without a notice give no row. Repeated documents give their rows each
time. Of the other columns only `doc_id` is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences in normal form, as their notices state them.
SENTENCES = {
    "licensed under the apache license version 2 0": "A",
    "licensed under the apache license version 2 0 the license": "A",
    "you may not use this file except in compliance with the license": "B",
    "you may obtain a copy of the license at": "C",
    "http www apache org licenses license 2 0": "D",
    "released under the mit license": "E",
    "this project is licensed under the mit license": "E",
    "permission is hereby granted free of charge to any person obtaining a copy": "F",
    "the software is provided as is without warranty of any kind": "G",
    "this work is licensed under the gnu general public license version 3": "H",
    "this program is free software you can redistribute it and or modify it": "I",
    "see the gnu general public license for more details": "J",
    "licensed under cc by nc 4 0": "K",
    "licensed under cc by 4 0": "L",
    "licensed under cc by sa 4 0": "M",
    "redistribution and use in source and binary forms are permitted": "N",
    "all rights reserved": "O",
    "spdx license identifier mit": "P",
    "spdx license identifier apache 2 0": "Q",
    "spdx license identifier gpl 3 0 only": "R",
}

# Sentences of the public licence texts and notices.
SENTENCES |= {
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license": "AB",
    "unless required by applicable law or agreed to in writing software distributed under the license "
    "is distributed on an as is basis without warranties or conditions of any kind either express or "
    "implied": "a",
    "see the license for the specific language governing permissions and limitations under the "
    "license": "b",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
    "copies of the software and to permit persons to whom the software is furnished to do so subject to "
    "the following conditions": "F",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "c",
    "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and "
    "noninfringement": "G",
    "in no event shall the authors or copyright holders be liable for any claim damages or other "
    "liability whether in an action of contract tort or otherwise arising from out of or in connection "
    "with the software or the use or other dealings in the software": "d",
    "this program is distributed in the hope that it will be useful but without any warranty without "
    "even the implied warranty of merchantability or fitness for a particular purpose": "e",
    "this library is distributed in the hope that it will be useful but without any warranty without "
    "even the implied warranty of merchantability or fitness for a particular purpose": "e",
    "see the gnu lesser general public license for more details": "f",
    "see the gnu affero general public license for more details": "g",
    "this source code form is subject to the terms of the mozilla public license v": "h",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl "
    "2 0": "i",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org "
    "mpl 2 0": "i",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "j",
    "redistributions of source code must retain the above copyright notice this list of conditions and "
    "the following disclaimer": "k",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the "
    "distribution": "l",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission": "m",
    "nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission": "m",
    "this software is provided by the copyright holders and contributors as is and any express or "
    "implied warranties including but not limited to the implied warranties of merchantability and "
    "fitness for a particular purpose are disclaimed": "n",
    "permission to use copy modify and or distribute this software for any purpose with or without fee "
    "is hereby granted provided that the above copyright notice and this permission notice appear in "
    "all copies": "o",
    "permission to use copy modify and distribute this software for any purpose with or without fee "
    "is hereby granted provided that the above copyright notice and this permission notice appear in "
    "all copies": "o",
    "the software is provided as is and the author disclaims all warranties with regard to this software "
    "including all implied warranties of merchantability and fitness": "p",
    "permission to use copy modify and or distribute this software for any purpose with or without fee "
    "is hereby granted": "q",
    "this is free and unencumbered software released into the public domain": "r",
}

# Licences of the free software notices, by the words of their notice.
FREE = {
    "S": ("GPL-3.0-or-later", "gnu general public license", "either version 3 of the license or at your option any later version"),
    "T": ("GPL-2.0-or-later", "gnu general public license", "either version 2 of the license or at your option any later version"),
    "U": ("LGPL-2.1-or-later", "gnu lesser general public license", "either version 2 1 of the license or at your option any later version"),
    "V": ("LGPL-3.0-or-later", "gnu lesser general public license", "either version 3 of the license or at your option any later version"),
    "W": ("AGPL-3.0-or-later", "gnu affero general public license", "either version 3 of the license or at your option any later version"),
    "X": ("GPL-2.0-only", "gnu general public license", "version 2 of the license"),
    "Y": ("GPL-3.0-only", "gnu general public license", "version 3 of the license"),
}
for name in ("program", "library", "software", "file"):
    SENTENCES[f"this {name} is licensed under the apache license version 2 0"] = "A"
    SENTENCES[f"this {name} is licensed under the apache license version 2 0 the license"] = "A"
    SENTENCES[f"this {name} is licensed under the mit license"] = "E"
    for mark, (_, text, version) in FREE.items():
        SENTENCES[
            f"this {name} is free software you can redistribute it and or modify it under the terms of the "
            f"{text} as published by the free software foundation {version}"
        ] = mark

# Names of the licence list that a tag may give, besides those above.
TAGGED = (
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0",
    "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "Unlicense", "CC0-1.0", "CC-BY-4.0",
)
TAG = "spdx license identifier "


def tag_key(name: str) -> str:
    """A name of the licence list as a part of a tag's line in normal form."""
    return name.lower().replace("-", " ").replace(".", " ").replace(" or later", LATER)


LATER = " orlater"
TAGS = {chr(0x3B1 + i): name for i, name in enumerate(TAGGED)}
SENTENCES |= {TAG + tag_key(name): mark for mark, name in TAGS.items()}


@dataclass(frozen=True)
class Rule:
    """`sentences` in this order, with at most `gap` unknown sentences between two of them."""

    name: str
    license: str
    sentences: str
    gap: int = 2

    def pattern(self) -> str:
        return f"\\.{{0,{self.gap}}}".join(self.sentences)


RULES = (
    Rule("apache-full-notice", "Apache-2.0", "ABCDab"),
    Rule("bsd-3-text", "BSD-3-Clause", "jklmn", gap=4),
    Rule("bsd-2-text", "BSD-2-Clause", "jkln", gap=4),
    Rule("mit-full-text", "MIT", "FcGd"),
    Rule("bsd-3-conditions", "BSD-3-Clause", "jklm", gap=4),
    *[Rule(f"{FREE[m][0].lower()}-notice", FREE[m][0], m + "e" + see) for m, see in zip("STUVWXY", "JJffgJJ", strict=True)],
    Rule("bsd-2-conditions", "BSD-2-Clause", "jkl", gap=4),
    Rule("apache-notice", "Apache-2.0", "ABCD"),
    Rule("apache-short-notice", "Apache-2.0", "AB"),
    Rule("mit-text", "MIT", "FG", gap=12),
    Rule("mit-named-text", "MIT", "EF"),
    Rule("gpl-notice", "GPL-3.0", "IJ", gap=6),
    Rule("mpl-notice", "MPL-2.0", "hi"),
    Rule("isc-text", "ISC", "op"),
    Rule("0bsd-text", "0BSD", "qp"),
    Rule("apache-line", "Apache-2.0", "A"),
    Rule("apache-tag", "Apache-2.0", "Q"),
    Rule("mit-line", "MIT", "E"),
    Rule("mit-tag", "MIT", "P"),
    Rule("gpl-line", "GPL-3.0", "H"),
    Rule("gpl-tag", "GPL-3.0", "R"),
    Rule("cc-by-nc-line", "CC-BY-NC-4.0", "K"),
    Rule("cc-by-line", "CC-BY-4.0", "L"),
    Rule("cc-by-sa-line", "CC-BY-SA-4.0", "M"),
    Rule("bsd-line", "BSD", "N"),
    Rule("reserved-line", "proprietary", "O"),
    *[Rule(f"{name.lower()}-line", name, mark) for mark, (name, _, _) in FREE.items()],
    Rule("mpl-line", "MPL-2.0", "i"),
    Rule("bsd-any-conditions", "BSD", "j"),
    Rule("isc-line", "ISC", "o"),
    Rule("unlicense-line", "Unlicense", "r"),
    *[Rule(f"{name.lower()}-tag", name, mark) for mark, name in TAGS.items()],
)

#: A text without any of these has no licence sentence. They are parts of single words, as what
#: stands between words may be anything.
CUES = "(?i)licen|reserved|permission|software|redistribution|mozilla|merchantability"
BREAK = (
    "\\.[ \\t\\r\\n]+|\\n[^\\p{L}\\p{N}\\n]*\\n|:[ \\t\\r]*\\n[^\\p{L}\\p{N}\\n]*\\p{N}+\\."
)
JOINED = " (or|and|with) "
HEAD = 3
MARK = "-"


def blocks(text: Column) -> Column:
    """The lines of every block in normal form; those without a letter or digit are left out."""
    lowered = F.lower(F.coalesce(text, F.lit("")))

    def lines(block: Column) -> Column:
        normal = F.transform(
            F.split(block, "\n"), lambda x: F.trim(F.regexp_replace(x, "[^\\p{L}\\p{N}]+", " "))
        )
        return F.array_remove(normal, "")

    return F.transform(F.split(lowered, BREAK), lines)


def sequence(text: Column) -> Column:
    """The identifiers of the sentences, a full stop for an unknown one."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])

    def alone(line: Column) -> Column:
        names = F.split(F.replace(F.substr(line, F.lit(len(TAG) + 1)), F.lit(" or later"), F.lit(LATER)), JOINED)
        tagged = F.transform(
            names, lambda x: F.coalesce(F.try_element_at(known, F.concat(F.lit(TAG), x)), F.lit("."))
        )
        return F.when(line.startswith(TAG), F.array_join(tagged, "")).otherwise(
            F.coalesce(F.try_element_at(known, line), F.lit("."))
        )

    def each(lines: Column) -> Column:
        return F.array_join(F.transform(lines, alone), "")

    def rest(lines: Column, n: int) -> Column:
        """The lines after the first `n` as one sentence, those before it each as one."""
        whole = F.try_element_at(known, F.array_join(F.slice(lines, n + 1, F.size(lines)), " "))
        return F.concat(each(F.slice(lines, 1, n)), whole) if n else whole

    def block(lines: Column) -> Column:
        wrapped = F.coalesce(*[rest(lines, n) for n in range(HEAD + 1)], each(lines))
        return F.when(F.size(lines) > 1, wrapped).otherwise(each(lines))

    return F.array_join(F.transform(blocks(text), block), "")


def marked(seq: Column, pattern: str) -> Column:
    """The sequence with every span of a rule blotted out at its full length."""
    parts = F.split(F.regexp_replace(seq, f"({pattern})", "\n$1\n"), "\n")
    blotted = F.transform(
        parts,
        lambda s: F.when(s.rlike(f"^{pattern}$"), F.repeat(F.lit(MARK), F.length(s))).otherwise(s),
    )
    return F.array_join(blotted, "")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, rule, license, n_matches, n_sentences (of the rule's matches), n_known, first_sentence.

    One row per document and rule that matched. `first_sentence` counts from 1. A sentence counts
    for the first rule that takes it; rules of several sentences come before those of one, which
    can't take each other's.
    """
    found = docs.where(F.col("text").rlike(CUES)).select("doc_id", sequence(F.col("text")).alias("seq"))
    found = found.where(F.col("seq").rlike("[^.]"))
    hits = []

    def hit(rule: Rule, n: Column, first: Column) -> Column:
        return F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.license).alias("license"),
            n.cast("long").alias("n_matches"),
            (n * len(rule.sentences)).cast("long").alias("n_sentences"),
            first.cast("long").alias("first_sentence"),
        )

    seq = F.col("seq")
    found, left = found.withColumn("left", seq), F.col("left")
    for i, rule in enumerate(r for r in rules if len(r.sentences) > 1):
        spans = F.regexp_extract_all(left, F.lit(f"({rule.pattern()})"), F.lit(1))
        found = found.withColumn(
            f"hit{i}", hit(rule, F.size(spans), F.regexp_instr(left, F.lit(rule.pattern())))
        )
        hits.append(F.col(f"hit{i}"))
        # every span keeps its length, so that positions stay right
        found = found.withColumn("left", marked(left, rule.pattern()))
    for rule in rules:
        if len(rule.sentences) == 1:
            n = F.length(left) - F.length(F.translate(left, rule.sentences, ""))
            hits.append(hit(rule, n, F.instr(left, rule.sentences)))
    listed = found.select(
        "doc_id",
        F.length(F.translate("seq", ".", "")).cast("long").alias("n_known"),
        F.explode(F.filter(F.array(*hits), lambda h: h["n_matches"] > 0)).alias("hit"),
    )
    return listed.select("doc_id", "hit.*", "n_known")
