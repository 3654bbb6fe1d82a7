"""Short licence notices in whole texts, with a bounded number of typing errors.

A notice of length m may be matched with k = m * RATE edits (one character
inserted, deleted or replaced each). Cut into k + 1 parts, at least one part
must then stand verbatim in the text (the pigeonhole principle), so an automaton
of all parts finds every place worth a look in one pass over the words. Round
such a seed, the window that a match can reach is searched with the ``regex``
library's bounded-error pattern, which confirms the edits and gives the span.
A notice's key, the words that tell its licence from others, must stand in its
place verbatim, as whole words, and the edits are those before and after it: no
number of allowed edits turns ``mpl`` into ``mit`` or version 2 into version 3.

Rows are read one by one in tasks and nothing is shuffled; a task holds one
batch of texts and one normalised text at a time.

Defined cases: a null or empty text has no words and no hits; rows that repeat
an id are judged each on its own; a match begins and ends between words; where
matches of one notice overlap, the one with the fewest edits counts, then the
longest, then the first; different notices may overlap. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each character of a notice.
RATE = 0.1
#: Everything in ASCII that is neither a digit nor a letter becomes a blank, A-Z small.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in range(256))
#: Most bytes of one character in UTF-8.
_WIDEST = 4


class Notice(NamedTuple):
    """A notice in normalised words; ``key`` (its first place counts) is matched verbatim."""

    label: str
    text: str
    key: str
    base: bool = False


# The notices of the contract, then those added here.
NOTICES = [
    Notice("mit", "under the mit license", "mit", base=True),
    Notice("apache-2", "apache license version 2", "2", base=True),
    Notice("cc-by-nc", "cc by nc", "cc by nc", base=True),
    Notice("agpl-3", "gnu affero general public license version 3", "3"),
    Notice("apache-2", "apache license 2 0", "2 0"),
    Notice("apache-2", "licensed under apache 2 0", "apache 2 0"),
    Notice("apache-2", "www apache org licenses license 2 0", "2 0"),
    Notice("bsd", "licensed under the bsd license", "bsd"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution"),
    Notice("cc-by", "licensed under cc by 4 0", "cc by 4"),
    Notice("cc-by", "creative commons attribution 4 0 international license", "attribution 4"),
    Notice("cc-by-nc", "creative commons attribution noncommercial", "noncommercial"),
    Notice("cc-by-nc", "creative commons attribution non commercial", "non commercial"),
    Notice("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Notice("cc-by-sa", "creative commons attribution sharealike", "sharealike"),
    Notice("cc-by-sa", "creative commons attribution share alike", "share alike"),
    Notice("cc0", "cc0 1 0 universal", "cc0"),
    Notice("gpl-2", "gnu general public license version 2", "2"),
    Notice("gpl-3", "gnu general public license version 3", "3"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", "purpose"),
    Notice("isc", "under the isc license", "isc"),
    Notice("lgpl-2", "gnu lesser general public license version 2", "2"),
    Notice("lgpl-3", "gnu lesser general public license version 3", "3"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", "granted"),
    Notice("mit", "the mit license mit", "mit"),
    Notice("mpl-2", "mozilla public license version 2", "2"),
    Notice("mpl-2", "mozilla public license v 2", "2"),
    Notice("public-domain", "released into the public domain", "public domain"),
    Notice("reserved", "all rights reserved", "rights"),
    Notice("unlicense", "this is free and unencumbered software", "unencumbered"),
]

HIT = "struct<label:string,notice:string,base:boolean,first_word:long,n_words:int,begin:long,end:long,found:string,edits:int>"


def edits_allowed(text: str, rate: float = RATE) -> int:
    return int(len(text) * rate)


def seeds(text: str, parts: int) -> list[tuple[int, str]]:
    """``text`` cut into ``parts`` pieces of nearly equal length, with their places."""
    cuts = [len(text) * i // parts for i in range(parts + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def pattern(notice: Notice, edits: int) -> regex.Pattern:
    """What stands before and after the key with up to ``edits`` edits each, as few as can be."""
    before, _, after = notice.text.partition(notice.key)
    near = [f"(?:{regex.escape(part)}){{e<={edits}}}" if part else "" for part in (before, after)]
    return regex.compile(f"(?e)(?<![^ ]){near[0]}(?<![^ ]){regex.escape(notice.key)}(?![^ ]){near[1]}(?![^ ])")


class Finder:
    """The notices as one automaton of seeds and a bounded-error pattern each."""

    def __init__(self, notices: list[Notice], rate: float = RATE):
        self.notices = notices
        self.allowed = [edits_allowed(n.text, rate) for n in notices]
        self.patterns = [pattern(n, k) for n, k in zip(notices, self.allowed)]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for at, piece in seeds(notice.text, self.allowed[i] + 1):
                places.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def windows(self, line: str) -> dict[int, list[list[int]]]:
        """Merged ranges of ``line`` (one character a byte) that may hold each notice."""
        found: dict[int, list[list[int]]] = {}
        if not len(self.automaton):
            return found
        for last, (size, where) in self.automaton.iter(line):
            for i, at in where:
                notice, slack = self.notices[i], _WIDEST * self.allowed[i]
                begin = max(0, last + 1 - size - at - slack)
                end = min(len(line), last + 1 - size - at + len(notice.text) + slack)
                ranges = found.setdefault(i, [])
                if ranges and begin <= ranges[-1][1]:
                    ranges[-1][0], ranges[-1][1] = min(begin, ranges[-1][0]), max(end, ranges[-1][1])
                elif line.find(notice.key, begin, end) >= 0:
                    ranges.append([begin, end])
        return found

    def matches(self, line: str) -> list[tuple[int, int, int, int]]:
        """(begin, end, notice, edits) of each match, in order; places count bytes."""
        out = []
        for i, ranges in self.windows(line).items():
            chosen: list[tuple[int, int, int]] = []
            for begin, end in ranges:
                while begin and line[begin - 1] != " ":
                    begin -= 1
                while end < len(line) and line[end] != " ":
                    end += 1
                text = line[begin:end].encode("latin-1").decode("utf-8", "surrogatepass")
                for m in self.patterns[i].finditer(text, overlapped=True):
                    if sum(m.fuzzy_counts) <= self.allowed[i]:
                        at = begin + len(text[: m.start()].encode("utf-8", "surrogatepass"))
                        size = len(m[0].encode("utf-8", "surrogatepass"))
                        chosen.append((sum(m.fuzzy_counts), -size, at))
            taken: list[tuple[int, int]] = []
            for edits, size, at in sorted(set(chosen)):
                if all(at - size <= a or b <= at for a, b in taken):
                    taken.append((at, at - size))
                    out.append((at, at - size, i, edits))
        return sorted(out)

    def hits(self, text: str | None) -> tuple[int, list[dict]]:
        """The number of words of a text and its matches as rows of ``HIT``."""
        if not isinstance(text, str):
            return 0, []
        normal = text.encode("utf-8", "surrogatepass").translate(_NORMAL)
        words = normal.split()
        line = b" ".join(words).decode("latin-1")
        found = self.matches(line)
        if not found:
            return len(words), []
        # Word numbers in the line, and where each word stands in the text itself.
        spots = [m.span() for m in regex.finditer(rb"[^ ]+", normal)]
        out, at, word = [], 0, 0
        for begin, end, i, edits in found:
            word += line.count(" ", at, begin)
            at = begin
            n = line.count(" ", begin, end) + 1
            first, last = spots[word][0], spots[word + n - 1][1]
            before = text.encode("utf-8", "surrogatepass")
            start = len(before[:first].decode("utf-8", "surrogatepass"))
            whole = before[first:last].decode("utf-8", "surrogatepass")
            notice = self.notices[i]
            out.append({
                "label": notice.label, "notice": notice.text, "base": notice.base, "first_word": word, "n_words": n,
                "begin": start, "end": start + len(whole), "found": whole, "edits": edits,
            })
        return len(words), out


def find_notices(documents: DataFrame, notices: list[Notice] = NOTICES, rate: float = RATE) -> DataFrame:
    """(doc_id, n_words, hits), one row per document row.

    A hit has the notice and its label, the first word and number of words, the
    range [begin, end) of the text in code points, the text there, and the edits.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(notices, rate)
        for batch in batches:
            found = [finder.hits(text) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": [n for n, _ in found], "hits": [h for _, h in found]})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_words long, hits array<{HIT}>")


def verbatim(hits: Column) -> Column:
    """Hits of the contract's notices without an edit."""
    return F.filter(hits, lambda h: h["base"] & (h["edits"] == 0))


def labels_of(hits: Column) -> Column:
    """Distinct labels, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts, places, labels and the likeness of the best match (1: verbatim, 0: none), per row."""
    places = F.transform(verbatim(F.col("hits")), lambda h: h["first_word"])
    likeness = F.transform("hits", lambda h: 1.0 - h["edits"] / F.length(h["notice"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels_of(verbatim(F.col("hits"))).alias("base_labels"),
        labels_of(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(likeness), F.lit(0.0)).alias("score"),
    )
