"""License scans by recognising sentences, without Python in tasks.

A text is cut at stops and line ends, the pieces are normalised, and the sentences of known
licenses are looked up among them, each as one piece or wrapped over consecutive lines, with or without comment
marks. The identifiers found, in the order of the text, are matched against ordered rules. All of
it stays within the row: there is no join and no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import text_or_empty

#: End of a sentence: stops before a blank or the end of the text. A new line may end one, a blank line does.
SENTENCE_END = r"[.!?]+([\x20\x09-\x0D]|\z)"
_NOT_PLAIN = "[^a-z0-9]+"
#: Comment marks made of letters, as they stand at the start of a line; others are no part of a normalised line.
_MARK = "(?:(?:dnl|rem) )?"


@dataclass(frozen=True)
class Rule:
    """A license and the sentences that declare it, in order and next to each other.

    Sentences that no rule knows may stand between them.
    """

    license: str
    sentences: tuple[str, ...]


# Sentences as the licenses' own texts and usual notices word them.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:"
)
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software"
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met:"
)
_APACHE_USE = "you may not use this file except in compliance with the License"
_GPL_FREE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version"
)
_UNLICENSE = "This is free and unencumbered software released into the public domain"
RULES = (
    Rule("MIT", ("Released under the MIT License",)),
    Rule("MIT", ("Licensed under the MIT License",)),
    Rule("MIT", ("This project is licensed under the MIT License",)),
    Rule("MIT", (_MIT_GRANT, _MIT_NOTICE)),
    Rule("Apache-2.0", ("Licensed under the Apache License, Version 2.0",)),
    Rule("Apache-2.0", ('Licensed under the Apache License, Version 2.0 (the "License"); ' + _APACHE_USE,)),
    Rule("GPL-3.0", ("This work is licensed under the GNU General Public License, version 3",)),
    Rule("GPL-3.0", ("Licensed under the GNU General Public License, version 3",)),
    Rule("GPL-3.0-or-later", (_GPL_FREE,)),
    Rule("GPL-2.0", ("Licensed under the GNU General Public License, version 2",)),
    Rule("CC-BY-NC-4.0", ("Licensed under CC BY-NC 4.0",)),
    Rule("CC-BY-4.0", ("Licensed under CC BY 4.0",)),
    Rule("CC-BY-SA-4.0", ("Licensed under CC BY-SA 4.0",)),
    Rule("ISC", (_ISC_GRANT,)),
    Rule("BSD", (_BSD_GRANT,)),
    Rule("MPL-2.0", ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",)),
    Rule("Unlicense", (_UNLICENSE,)),
)


def normal_sentence(sentence: str) -> str:
    """The form in which sentences are compared: lower-case letters and digits, single blanks."""
    plain = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(plain.split())


def sentence_ids(rules: Sequence[Rule] = RULES) -> dict[str, int]:
    """Identifiers of the rules' sentences, from 1, in the order in which they first appear.

    A rule's sentence with a stop inside is cut like any text.
    """
    known: dict[str, int] = {}
    for rule in rules:
        for part in rule_sentences(rule):
            known.setdefault(part, len(known) + 1)
    return known


def rule_sentences(rule: Rule) -> list[str]:
    texts = [re.split(r"[.!?]+(?:[\x20\x09-\x0D]|\Z)|\n", s) for s in rule.sentences]
    return [n for parts in texts for p in parts if (n := normal_sentence(p))]


def pieces(text: Column) -> Column:
    """Normalised pieces between stops and line ends; one that is empty stands at every stop and blank line."""
    cut = F.split(F.regexp_replace(text, SENTENCE_END, "\n\n"), "\n")
    return F.transform(cut, lambda s: F.trim(F.regexp_replace(F.lower(s), _NOT_PLAIN, " ")))


def known_sentences(lines: Column, known: Sequence[str]) -> Column:
    """The known sentences among pieces joined by new lines, in order; the longest where several start.

    Any blank of a sentence may be a line end, but not a stop or a blank line, which are two.
    """
    wrapped = [s.replace(" ", f"(?: |\n{_MARK})") for s in sorted(known, key=len, reverse=True)]
    found = F.regexp_extract_all(lines, F.lit(rf"(?<![^\n]){_MARK}({'|'.join(wrapped)})(?![^\n])"), F.lit(1))
    return F.transform(found, lambda s: F.regexp_replace(s, f"\n{_MARK}", " "))


def scan(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences, sentence_ids, n_matches, licenses.

    ``n_sentences`` counts the pieces between stops and line ends. ``sentence_ids`` are the
    known sentences in the order of the text, repeats included, whether or not they are wrapped;
    ``n_matches`` counts the rules that match, and ``licenses`` are their distinct names in alphabetical order.

    Null and empty texts have no sentences and no licenses. Repeated rows are
    scanned each for itself; other columns are ignored.
    """
    known = sentence_ids(rules)
    numbers = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = known_sentences(F.array_join("_pieces", "\n"), list(known))
    rows = (
        docs.select(F.col(id_col).alias("doc_id"), pieces(text_or_empty(text_col)).alias("_pieces"))
        .select(
            "doc_id",
            F.size(F.filter("_pieces", lambda s: s != "")).cast("long").alias("n_sentences"),
            F.transform(found, lambda s: F.element_at(numbers, s)).alias("sentence_ids"),
        )
        .withColumn("_line", F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ","), F.lit(",")))
    )
    hits = [
        F.when(F.col("_line").contains("," + ",".join(str(known[p]) for p in rule_sentences(rule)) + ","), F.lit(rule.license))
        for rule in rules
    ]
    none = F.array().cast("array<string>")
    matched = F.when(F.size("sentence_ids") == 0, none).otherwise(F.array_compact(F.array(*hits)))
    return rows.withColumn("_hits", matched).select(
        "doc_id",
        "n_sentences",
        "sentence_ids",
        F.size("_hits").cast("long").alias("n_matches"),
        F.array_sort(F.array_distinct("_hits")).alias("licenses"),
    )
