"""Short licence notices in running text: exact phrases, and known notices with a bounded number of edits.

A notice with at most ``k`` edits, cut into ``k + 1`` pieces, keeps one piece unchanged. All pieces of all notices are
found in one pass by an Aho-Corasick automaton; only around a found piece does the bounded-error matcher look for
the notice. It works on the words joined by single spaces, so line breaks and punctuation cost no edits. The words that tell a
licence from its neighbours take no edits, and of matches that overlap the one stays that explains the most text.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame

from docstrata.llm.common import documents, with_result

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrase and label.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notice, label, and the words in it that must stand unchanged. Words as the word pattern above leaves them.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache", "2 0"),
    ("licensed under the apache license version 1 1", "apache-1.1", "1 1"),
    ("released under the mit license", "mit", "mit"),
    ("licensed under the mit license", "mit", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", ""),
    ("redistribution and use in source and binary forms with or without modification", "bsd", ""),
    ("distributed under the bsd 3 clause license", "bsd", "bsd"),
    ("licensed under the bsd license", "bsd", "bsd"),
    ("this work is licensed under the gnu general public license", "gpl", "gnu general"),
    ("under the terms of the gnu general public license", "gpl", "gnu general"),
    ("under the terms of the gnu lesser general public license", "lgpl", "lesser"),
    ("under the terms of the gnu affero general public license", "agpl", "affero"),
    ("licensed under the gnu gpl", "gpl", "gpl"),
    ("subject to the terms of the mozilla public license", "mpl", "mozilla"),
    ("permission to use copy modify and or distribute this software", "isc", ""),
    ("licensed under the creative commons attribution", "cc-by", ""),
    ("licensed under the creative commons attribution sharealike", "cc-by-sa", "attribution sharealike"),
    ("licensed under the creative commons attribution noderivatives", "cc-by-nd", "attribution noderivatives"),
    ("licensed under the creative commons attribution noncommercial", "cc-by-nc", "noncommercial"),
    ("licensed under the creative commons attribution noncommercial sharealike", "cc-by-nc-sa", "noncommercial sharealike"),
    ("licensed under the creative commons attribution noncommercial noderivatives", "cc-by-nc-nd", "noncommercial noderivatives"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "by nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "by sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "by nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", "by nc sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", "by nc nd"),
    ("free and unencumbered software released into the public domain", "public-domain", ""),
    ("no part of this publication may be reproduced", "reserved", ""),
)
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12
#: Where matches overlap, an edit weighs against so many characters of a longer notice.
EDIT_WEIGHT = 4


def lower_ascii(text: str) -> str:
    return text.encode().lower().decode()  # bytes know ASCII letters only


class Match(NamedTuple):
    label: str
    start: int
    end: int
    edits: int
    allowed: int


@lru_cache(maxsize=4)
def _machine(notices: tuple[tuple[str, str, str], ...], chars_per_edit: int):
    seeds: dict[str, list[tuple[int, int]]] = {}
    matchers = []
    for k, (notice, label, firm) in enumerate(notices):
        edits = len(notice) // chars_per_edit
        matchers.append((regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={edits}}}"), len(notice), edits, label, firm))
        cuts = [i * len(notice) // (edits + 1) for i in range(edits + 2)]
        for start, end in zip(cuts, cuts[1:]):
            seeds.setdefault(notice[start:end], []).append((k, start))
    automaton = ahocorasick.Automaton()
    for seed, places in seeds.items():
        automaton.add_word(seed, (len(seed), places))
    automaton.make_automaton()
    return automaton, matchers


def _apart(found: list[tuple[Match, int]]) -> list[Match]:
    """Of matches with different labels that overlap, the one of the longest notice, edits counted against it; then the first."""
    kept: list[Match] = []
    cluster: list[tuple[Match, int]] = []
    end = 0

    def settle_cluster() -> None:
        taken: list[Match] = []
        for m, _ in sorted(cluster, key=lambda p: (EDIT_WEIGHT * p[0].edits - p[1], p[0])):
            if all(m.label == other.label or m.end <= other.start or other.end <= m.start for other in taken):
                taken.append(m)
        kept.extend(taken)
        cluster.clear()

    for m, length in sorted(found, key=lambda p: p[0].start):
        if m.start >= end:  # nothing that follows overlaps what came before
            settle_cluster()
        cluster.append((m, length))
        end = max(end, m.end)
    settle_cluster()
    return sorted(kept, key=lambda m: (m.start, m.end, m.label))


def fuzzy_matches(line: str, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> list[Match]:
    """Notices in normalised text with at most their edits, by place in ``line``; no two of one notice, or of different labels, overlap."""
    automaton, matchers = _machine(notices, chars_per_edit)
    found: list[tuple[Match, int]] = []
    reached = [0] * len(matchers)
    tried = [(0, 0)] * len(matchers)
    for last, (size, places) in automaton.iter(line):
        for k, offset in places:
            matcher, length, edits, label, firm = matchers[k]
            begin = last + 1 - size - offset
            low, high = max(reached[k], begin - edits), begin + length + edits
            if high - low < length - edits or (tried[k][0] <= low and high <= tried[k][1]) or line.find(firm, low, high) < 0:
                continue
            hit = matcher.search(line, low, high)
            if hit and (not firm or f" {firm} " in f" {hit.group()} "):
                found.append((Match(label, hit.start(), hit.end(), sum(hit.fuzzy_counts), edits), length))
                reached[k] = hit.end()
            else:
                tried[k] = low, high  # most seeds of a place ask for the same stretch
    return _apart(found)


def scan_text(text: str | None) -> dict:
    """Counts, labels and spans of one text. Spans are in code points of the text; words count from 0."""
    words = WORDS.findall(lower_ascii(text or ""))
    line = " ".join(words)
    framed = f" {line} "
    places, base_labels = [], set()
    for phrase, label in BASE:
        probe, word, seen = f" {phrase} ", 0, 0
        at = framed.find(probe)
        while at >= 0:
            word += framed.count(" ", seen, at)
            seen = at
            places.append(word)
            base_labels.add(label)
            at = framed.find(probe, at + 1)
    matches = fuzzy_matches(line)
    spans = []
    if matches:
        bounds = [m.span() for m in WORDS.finditer(lower_ascii(text))]
        word = seen = 0
        for m in matches:
            word += line.count(" ", seen, m.start)
            seen = m.start
            last = word + line.count(" ", m.start, max(m.start, m.end - 1))
            spans.append((m.label, bounds[word][0], bounds[last][1], m.edits))
    score = 1.0 if places else max((1 - m.edits / (m.allowed + 1) for m in matches), default=0.0)
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {m.label for m in matches})),
        "score": score,
        "spans": [dict(zip(("label", "start", "end", "edits"), span)) for span in spans],
    }


FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
SPANS = "spans array<struct<label:string,start:long,end:long,edits:int>>"


def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = pd.DataFrame([scan_text(t) for t in texts], columns=[*(f.split()[0] for f in FIELDS.split(", ")), "spans"])
    return rows.astype({"first_word": "Int64", "last_word": "Int64"})


def scan_licenses(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of counts, labels, score and spans; also returns that struct's name.

    Null and empty texts give no words, empty labels, null first and last words and score 0. Each row is looked at
    by itself, so repeated rows and other columns don't matter, and no data moves.
    """
    return with_result(docs, text, _scan, f"{FIELDS}, {SPANS}", "licenses")


def op3_license_notices(spark, sf_dir: str) -> DataFrame:
    found, name = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", f"{name}.*")
